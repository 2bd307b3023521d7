import hashlib
import json
import re

from pyspark.sql import functions as F


def digest(d):
    return hashlib.sha1(json.dumps(d, sort_keys=True, separators=(",", ":")).encode()).hexdigest()

from linkloom import basic_merge, clean, deduplicate, one_per_uri


def test_empty_base_is_identity(spark, docs, collect_docs):
    src = docs(spark, ['u\t{"r": "x", "s": [{"uri": "y"}]}', 'v\t{"r": {"uri": "x"}}'])
    empty = src.where(F.lit(False))
    assert collect_docs(basic_merge(src, "r", empty)) == collect_docs(src)


def test_clean_and_dedup_idempotent(spark, docs, collect_docs):
    src = docs(spark, ['u\t{"loc": {"uri": "b", "old": 1}}', 'v\t{"loc": [{"uri": "b"}, "b", {"uri": "c"}]}'])
    base = docs(spark, ['b\t{"uri": "b", "new": 2}', 'c\t{}'])
    once = clean(src, "loc", base)
    assert collect_docs(clean(once, "loc", base)) == collect_docs(once)
    out = collect_docs(once)
    assert out["u"]["loc"] == {"uri": "b", "old": 1, "new": 2}
    assert out["v"]["loc"] == [{"uri": "b", "new": 2}, {"uri": "b", "new": 2}, {"uri": "c"}]  # {} base is skipped
    d1 = deduplicate(once, "loc")
    assert collect_docs(deduplicate(d1, "loc")) == collect_docs(d1)


def test_row_count_and_duplicate_uris(spark, docs, collect_docs):
    rows = [f'u{i % 7}\t{{"n": {i}, "r": "b"}}' for i in range(50)]
    src = docs(spark, rows)
    base = docs(spark, ['b\t{"uri": "b"}', 'b\t{"uri": "b", "z": 1}'])
    out = basic_merge(src, "r", base)
    assert out.count() == 7
    got = collect_docs(out)
    # the kept document per uri is the one with the largest digest of its JSON text
    for u in got:
        cands = [json.loads(r.split("\t", 1)[1]) for r in rows if r.startswith(u + "\t")]
        assert got[u]["n"] == max(cands, key=digest)["n"]
        # duplicate base uris: the same rule
        assert got[u]["r"] == max([{"uri": "b"}, {"uri": "b", "z": 1}], key=digest)
    again = collect_docs(one_per_uri(src))
    assert again == collect_docs(one_per_uri(src.repartition(5)))


def test_max_refs_keeps_equal_later_refs(spark, docs, collect_docs):
    src = docs(spark, ['d\t{"r": ["r1", "r2", "r3", "r1"]}'])
    base = docs(spark, ['r1\t{"n": 1}', 'r2\t{"n": 2}', 'r3\t{"n": 3}'])
    out = collect_docs(basic_merge(src, "r", base, max_refs=2))
    assert out["d"]["r"] == [{"n": 1}, {"n": 2}, "r3", {"n": 1}]
    none = collect_docs(basic_merge(src, "r", base, max_refs=0))
    assert none["d"]["r"] == ["r1", "r2", "r3", "r1"]


def test_hot_reference_and_hot_key(spark, docs, collect_docs):
    # a third of all rows share one document key, and every document names one base
    rows = [f'hot\t{{"i": {i}, "r": "b"}}' for i in range(300)] + [f'u{i}\t{{"r": "b"}}' for i in range(600)]
    out = collect_docs(basic_merge(docs(spark, rows), "r", docs(spark, ['b\t{"uri": "b", "x": 1}'])))
    assert len(out) == 601
    assert all(d["r"] == {"uri": "b", "x": 1} for d in out.values())
    assert out["hot"]["i"] == max(range(300), key=lambda i: digest({"i": i, "r": "b"}))


def test_hot_keys_join_exact(spark, docs, collect_docs):
    from linkloom import link_merge
    from linkloom.operators.skew import SkewSettings, hot_keys, salted_join

    rows = [f'd{i}\t{{"r": ["hot", "c{i % 10}"]}}' for i in range(400)] + ['x\t{"r": "cold-only"}']
    src = docs(spark, rows)
    base = docs(spark, ['hot\t{"uri": "hot", "h": 1}'] + [f'c{i}\t{{"uri": "c{i}", "n": {i}}}' for i in range(10)])
    plain = collect_docs(basic_merge(src, "r", base))
    spark.conf.set("linkloom.skew.hotKeyThreshold", "50")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the salted (shuffled) path
    try:
        split = collect_docs(basic_merge(src, "r", base))
        links = docs(spark, ['{"uri": "alias", "matches": [{"uri": "hot"}]}'])
        aliased = collect_docs(link_merge(docs(spark, [f'a{i}\t{{"r": "alias"}}' for i in range(200)]), "r", base, links))
    finally:
        spark.conf.unset("linkloom.skew.hotKeyThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert split == plain
    assert split["d7"]["r"] == [{"uri": "hot", "h": 1}, {"uri": "c7", "n": 7}]
    assert len(aliased) == 200 and all(d["r"] == {"uri": "hot", "h": 1} for d in aliased.values())

    pairs = spark.createDataFrame([("hot", f"u{i}") for i in range(100)] + [("cold", "u0")], "k string, uri string")
    assert [(r.k, r._buckets) for r in hot_keys(pairs, ["k"], 30).collect()] == [("hot", 4)]
    right = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(pairs, right, ["k"], "uri", SkewSettings(True, 30))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan
        assert joined.count() == 101
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.where("k = 'hot'").select("uri").distinct().count() == 100


def test_every_key_hot_and_none_left_out(spark):
    from linkloom.operators.skew import SkewSettings, hot_keys, salted_join

    pairs = spark.range(60 * 90).selectExpr("concat('k', id % 60) as k", "concat('u', id) as uri")
    right = spark.range(60).selectExpr("concat('k', id) as k", "id as v")
    assert hot_keys(pairs, ["k"], 10).count() == 60
    joined = salted_join(pairs, right, ["k"], "uri", SkewSettings(True, 10))
    assert joined.count() == 60 * 90 and joined.select("uri").distinct().count() == 60 * 90
    # no salt value of a key gets much more than the threshold
    buckets = pairs.join(hot_keys(pairs, ["k"], 10), "k").selectExpr("k", "pmod(xxhash64(uri), _buckets) as s")
    assert buckets.groupBy("k", "s").count().agg(F.max("count")).first()[0] <= 30


def test_merge_many_equals_sequential(spark, docs, collect_docs):
    import pytest

    from linkloom.operators import basic_merge_many

    src = docs(spark, ['d\t{"a": "x", "b": ["y", {"uri": "x"}], "c": {"d": "y"}}'])
    xs = docs(spark, ['x\t{"uri": "x", "kind": "X"}'])
    ys = docs(spark, ['y\t{"uri": "y", "kind": "Y"}'])
    many = collect_docs(basic_merge_many(src, [("a", xs), ("b", ys), ("c.d", ys)]))
    seq = collect_docs(basic_merge(basic_merge(basic_merge(src, "a", xs), "b", ys), "c.d", ys))
    assert many == seq
    assert many["d"]["b"] == [{"uri": "y", "kind": "Y"}, {"uri": "x"}]
    with pytest.raises(ValueError):
        basic_merge_many(src, [("c", xs), ("c.d", ys)])


def test_document_with_many_references(spark, collect_docs):
    """One document naming thousands of references (a binary-searched match
    table): every hit is replaced, every miss kept, order preserved."""
    n = 6000
    refs = [f"b{i}" if i % 3 else f"miss{i}" for i in range(n)]
    doc = json.dumps({"uri": "big", "r": refs + refs[:50]})
    src = spark.createDataFrame([("big", doc)], "uri string, j string").select("uri", F.parse_json("j").alias("doc"))
    base = spark.range(n).select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("uri")).select(
        "uri", F.to_variant_object(F.struct(F.col("uri"), F.col("uri").alias("copy"))).alias("doc"))
    out = collect_docs(basic_merge(src, "r", base))["big"]["r"]
    assert len(out) == n + 50
    for r, got in zip(refs + refs[:50], out):
        assert got == (r if r.startswith("miss") else {"uri": r, "copy": r})


def test_num_partitions_hint(spark, docs, collect_docs):
    """The partitioning hint (the original jobs' numPartitions) changes the
    document shuffle's partition count, never the result."""
    rows = [f'd{i}\t{{"r": ["b{i % 4}", "x"]}}' for i in range(40)]
    src = docs(spark, rows)
    base = docs(spark, [f'b{i}\t{{"uri": "b{i}", "n": {i}}}' for i in range(4)])
    plain = collect_docs(basic_merge(src, "r", base))
    hinted_df = basic_merge(src, "r", base, num_partitions=3)
    assert collect_docs(hinted_df) == plain
    plan = hinted_df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(uri" in plan and ", 3)" in plan


def test_documents_without_a_key_pass_however_many(spark, docs, collect_docs):
    """A third of all documents has no key, many of them are copies of each other, and one
    has a key that looks like the one that such documents get."""
    base = docs(spark, ['b\t{"uri": "b", "x": 1}'])
    keyed = docs(spark, [f'd{i}\t{{"r": "b", "i": {i}}}' for i in range(60)])
    bare = docs(spark, ['n\t{"r": "b"}'] * 20 + [f'n{i}\t{{"r": "b", "i": {i}}}' for i in range(20)])
    bare = bare.withColumn("uri", F.lit(None).cast("string"))
    own = bare.select(F.concat(F.lit("\0"), F.xxhash64(F.to_json("doc")).cast("string")).alias("uri"), "doc").limit(1)
    for unique in (True, False):
        out = basic_merge(keyed.unionByName(bare).unionByName(own), "r", base, unique_uris=unique)
        rows = [(r.uri, json.loads(r.doc.toJson())["r"]) for r in out.collect()]
        assert len(rows) == 101 and sum(u is None for u, _ in rows) == 40
        assert all((r == "b") == (u is None) for u, r in rows)


def test_a_key_repeated_very_often_is_combined_first(spark, docs, collect_docs):
    from linkloom.functions import fingerprint
    from linkloom.operators.keys import few_repeats, one_per_uri

    many = docs(spark, [f'hot\t{{"i": {i}}}' for i in range(300)] + [f'k{i % 40}\t{{"i": {i}}}' for i in range(80)] + ['one\t{"i": 0}'])
    many = many.unionByName(many.where("uri = 'one'").withColumn("uri", F.lit(None).cast("string")))
    best = many.where("uri is not null").groupBy("uri").agg(F.max_by("doc", fingerprint(F.col("doc"))).alias("doc"))
    need = {r.uri: r.doc.toJson() for r in best.collect()}
    spark.conf.set("linkloom.skew.hotKeyThreshold", "50")
    try:
        few = few_repeats(many)
        assert few.where("uri = 'hot'").count() == 1 and few.count() == 1 + 80 + 2
        got = one_per_uri(many).collect()
    finally:
        spark.conf.unset("linkloom.skew.hotKeyThreshold")
    assert len(got) == 43 and {r.uri: r.doc.toJson() for r in got if r.uri} == need


def test_num_partitions_is_multiplied_for_large_sets(spark, docs, collect_docs, monkeypatch):
    """A task's share of the documents is bounded, whatever number of partitions is asked for."""
    from linkloom.operators import merge

    src = docs(spark, [f'd{i}\t{{"r": ["b{i % 4}", "x"]}}' for i in range(40)])
    base = docs(spark, [f'b{i}\t{{"uri": "b{i}", "n": {i}}}' for i in range(4)])
    plain = collect_docs(basic_merge(src, "r", base))
    monkeypatch.setattr(merge, "estimated_bytes", lambda _df: 10 * merge.PARTITION_BYTES)
    assert merge.partitions_for(src, 3) == 12 and merge.partitions_for(src, None) is None
    out = basic_merge(src, "r", base, num_partitions=3)
    assert collect_docs(out) == plain
    assert re.search(r"hashpartitioning\(_key#?\d*, 12\)", out._jdf.queryExecution().executedPlan().toString())
