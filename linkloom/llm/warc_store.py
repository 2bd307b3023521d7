"""WARC: a content-addressed archive.

``write_archive`` lays an archive out as two tables in a folder:

* ``payloads``: digest, payload - each distinct payload once, under its SHA-256.
  Rows that share a digest are compared byte by byte when they are stored;
* ``records``: key, digest, head - for each record the exact bytes that stand
  before its payload (WARC header and HTTP header block).

``read_archive`` checks every stored payload against its digest and rebuilds the
original records by a join: head + payload (none for a revisit) + two line ends.

The first of the records with one payload (by id, then url) is the ``response``
and the others are ``revisit`` records that name it; payloads under ``min_bytes``
are always written as responses, though their bytes too are stored once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, scratch_path, stage

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A record's id ends with its page's id (empty for null) and the number of the copy among equal rows.
ID_PREFIX = "urn:x-page:"
CRLF = "\r\n"


def _escaped(text: Column) -> Column:
    """Line ends inside a header value would end it: percent-encoded."""
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(page_id: Column, copy: Column) -> Column:
    return F.concat(F.lit(ID_PREFIX), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), copy.cast("string"))


def _head(date: str) -> Column:
    """The bytes before the payload of a row of (page_id, url, copy, digest, length, revisit, first_id)."""

    def line(name: str, value: Column, where: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
        return text if where is None else F.when(where, text).otherwise(F.lit(""))

    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("length").cast("string"),
        F.lit(CRLF + CRLF),
    )
    revisit = F.col("revisit")
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("length"))
    warc = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<"), _record_id(F.col("page_id"), F.col("copy")), F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.coalesce(_escaped(F.col("url")), F.lit("")), F.col("url").isNotNull()),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Refers-To", F.concat(F.lit("<"), _record_id(F.col("first_id"), F.lit(0)), F.lit(">")), revisit),
        line("WARC-Profile", F.lit(PROFILE), revisit),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block.cast("string")),
        F.lit(CRLF),
    )
    return F.encode(F.concat(warc, http), "UTF-8")


def write_archive(
    pages: DataFrame,
    path: str,
    min_bytes: int = 100,
    date: str = "1970-01-01T00:00:00Z",
    page_id: str = "page_id",
    url: str = "url",
    body: str = "html",
) -> None:
    """Write one record per row of ``pages`` to the folder ``path``.

    A null body is an empty payload, a null url leaves the target out, null ids
    come last among records of one payload. Rows equal in all three columns are
    separate records: the first copy can be a response, the others revisit it.
    Columns of other names are not read. An empty table gives an empty archive."""
    payload = F.encode(F.coalesce(F.col(body), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "length": F.octet_length("payload")})
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.coalesce("url", F.lit("")).alias("url"), F.col("url").isNull().alias("no_url"))
    seen = stage(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"), F.min(order).alias("first")), "payload-digests")
    total = seen.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    known = attach(rows, seen.where(F.col("rows") > 1), ["digest"], "rows", total, ["page_id", "url"])

    once = known.where(F.col("_found").isNull()).select("digest", "payload")
    repeated = known.where(F.col("_found").isNotNull()).groupBy("digest").agg(F.min("payload").alias("payload"), F.max("payload").alias("_max"))
    same = F.when(F.col("payload") == F.col("_max"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("two payloads share the digest "), F.col("digest"))).cast("binary")
    )
    payloads = once.unionByName(repeated.select("digest", same.alias("payload")))
    payloads.write.option("compression", "zstd").parquet(f"{path}/payloads")

    narrow = ["page_id", "url", "digest", "length", "_found"]
    alone = known.where(F.col("_found").isNull()).select(*narrow, F.lit(0).cast("long").alias("copy"))
    shared = known.where(F.col("_found").isNotNull()).groupBy(*narrow).agg(F.count(F.lit(1)).alias("_copies"))
    shared = shared.select(*narrow, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("copy"))
    first = F.col("page_id").eqNullSafe(F.col("_found.first.page_id")) & F.col("url").eqNullSafe(
        F.when(~F.col("_found.first.no_url"), F.col("_found.first.url"))
    ) & (F.col("copy") == 0)
    records = alone.unionByName(shared).withColumns({
        "revisit": F.col("_found").isNotNull() & (F.col("length") >= min_bytes) & ~first,
        "first_id": F.col("_found.first.page_id"),
    })
    records = records.select(_record_id(F.col("page_id"), F.col("copy")).alias("key"), "digest", _head(date).alias("head"))
    records.write.option("compression", "zstd").parquet(f"{path}/records")


def header(head: Column, name: str) -> Column:
    """The value of a WARC header field in the head of a record, null if absent."""
    value = F.regexp_extract(F.decode(head, "UTF-8"), rf"(?s)^WARC/1\.1\r\n(?:(?!\r\n\r\n).)*?(?<=\n){name}: ([^\r\n]*)\r\n", 1)
    return F.nullif(value, F.lit(""))


def page_id_of(record_id: Column) -> Column:
    """The page id in a record id, null if it was null."""
    return F.nullif(F.regexp_extract(record_id, rf"^<{ID_PREFIX}(.*):\d+>$", 1), F.lit(""))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``key, head, payload`` (the full payload, also of a
    revisit), ``payload_digest`` and ``payload_bytes`` (both taken from the stored
    bytes), ``record`` (the original record's bytes) and the parsed fields
    ``record_id, record_type, refers_to, target_uri``.

    Fails if a stored payload does not have its digest or a record lacks its
    payload. Both sides of the join are plain scans, so Spark splits a payload
    that very many records share."""
    store = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    records = spark.read.schema("key string, digest string, head binary").parquet(f"{path}/records")
    found = F.sha2("payload", 256)
    store = store.select(
        "digest",
        "payload",
        F.when(found == F.col("digest"), found).otherwise(F.raise_error(F.lit("a stored payload does not have its digest"))).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    rows = records.join(store, "digest", "left")
    stored = F.when(F.col("payload_bytes").isNotNull(), F.col("payload_bytes")).otherwise(
        F.raise_error(F.lit("a record's payload is missing")).cast("long")
    )
    kind = header(F.col("head"), "WARC-Type")
    body = F.when(kind == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return rows.select(
        "key",
        "head",
        "payload",
        "payload_digest",
        stored.alias("payload_bytes"),
        F.concat("head", body, F.lit(b"\r\n\r\n")).alias("record"),
        header(F.col("head"), "WARC-Record-ID").alias("record_id"),
        kind.alias("record_type"),
        header(F.col("head"), "WARC-Refers-To").alias("refers_to"),
        header(F.col("head"), "WARC-Target-URI").alias("target_uri"),
    )


def archive_path(spark: SparkSession) -> str:
    """A new archive folder under the shared checkpoint folder."""
    return scratch_path(spark, "warc")
