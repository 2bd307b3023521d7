import hashlib
import re

from linkloom.llm import warc_store


def archive(spark, rows, **kw):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as digest", "1 as rows", "2 as copy")
    path = warc_store.archive_path(spark)
    warc_store.write_archive(df, path, **kw)
    return path, warc_store.read_archive(spark, path).collect()


def test_records_round_trip(spark):
    long = "é" * 60
    rows = [(5, "http://a/", long), (3, "http://b/\r\nX: y", long), (3, "http://a/", long), (9, None, "short"), (8, "http://c/", "short"),
            (1, "http://n/", None), (2, "http://e/", ""), (None, "http://z/", long), (4, "u", "x" * 300), (4, "u", "x" * 300)]
    path, got = archive(spark, rows)
    assert len(got) == len(rows)
    for r in got:
        head, rest = bytes(r.record).split(b"\r\n\r\n", 1)
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert len(rest) == length + 4 and rest.endswith(b"\r\n\r\n")
        assert bytes(r.record).startswith(bytes(r.head))
        assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes
        http, body = rest[:-4].split(b"\r\n\r\n", 1)
        assert f"Content-Length: {r.payload_bytes}".encode() in http
        assert body == (b"" if r.record_type == "revisit" else bytes(r.payload))
        assert (r.refers_to is None) == (r.record_type == "response")
    kind = sorted((r.record_id, r.record_type, r.refers_to) for r in got if r.payload_bytes == 120)
    assert kind == [("<urn:x-page:3:0>", "response", None), ("<urn:x-page:3:0>", "revisit", "<urn:x-page:3:0>"),
                    ("<urn:x-page:5:0>", "revisit", "<urn:x-page:3:0>"), ("<urn:x-page::0>", "revisit", "<urn:x-page:3:0>")]
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 100)
    assert sorted(r.record_type for r in got if r.payload_bytes == 300) == ["response", "revisit"]
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == 4  # each payload once: the long one, 'short', '' and x * 300


def test_hot_payload_and_empty_table(spark):
    _, got = archive(spark, [(i, "u", "y" * 200) for i in range(500, 0, -1)])
    assert [r.record_id for r in got if r.record_type == "response"] == ["<urn:x-page:1:0>"] and len(got) == 500
    assert archive(spark, [])[1] == []


def test_damaged_payload_is_noticed(spark):
    import pytest

    path, _ = archive(spark, [(1, "u", "z" * 200)])
    bad = spark.read.parquet(f"{path}/payloads").selectExpr("digest", "cast('other' as binary) as payload").collect()
    spark.createDataFrame(bad, "digest string, payload binary").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="does not have its digest"):
        warc_store.read_archive(spark, path).collect()
