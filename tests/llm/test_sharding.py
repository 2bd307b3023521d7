import zlib
from collections import Counter

from linkloom.llm import sharding
from linkloom.llm.queries import SHARDS, op4_feistel_shards


def test_permutation_is_a_bijection_and_its_inverse_agrees():
    for n in (1, 2, 3, 5, 17, 100, 1009):
        places = [sharding.locate(i, n, 7, 5) for i in range(n)]
        assert sorted(slot * 7 + shard for shard, slot in places) == list(range(n))
        assert [sharding.row_at(*p, n, 7, 5) for p in places] == list(range(n))


def test_layout_matches_locate_and_is_balanced(spark):
    rows = spark.createDataFrame([(i % 50 or None, "x" * (i % 3)) for i in range(500)], "id long, note string")
    out = sharding.shard_rows(rows.repartition(5), ["id", "note"], 6, seed=9).collect()
    assert sorted(r.row_no for r in out) == list(range(500))
    assert all((r.shard, r.slot) == sharding.locate(r.row_no, 500, 6, 9) for r in out)
    sizes = Counter(r.shard for r in out)
    assert len(sizes) == 6 and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in out if r.shard == s) == list(range(n))
    assert Counter((r.id, r.note) for r in out) == Counter((r.id, r.note) for r in rows.collect())
    again = sharding.shard_rows(rows.coalesce(1), ["id", "note"], 6, seed=9).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_one_row_repeated_and_empty_table(spark):
    same = spark.range(300).selectExpr("1L as id", "'clash' as row_no2")
    out = sharding.shard_rows(same, ["id"], 4).collect()
    assert sorted(r.row_no for r in out) == list(range(300))
    assert sharding.shard_rows(same.where("false"), ["id"], 4).count() == 0


def test_query_over_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = op4_feistel_shards(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = Counter((d.doc_id, len((d.text or "").encode()) + 8, zlib.crc32((d.text or "").encode())) for d in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(SHARDS)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in sizes.items())
