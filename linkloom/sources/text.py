"""Keyed JSON lines (``key<sep>json``) and delimited base tables.

Parsing works on a DataFrame of lines (column ``value``), so the same code
serves ``spark.read.text`` input and lines that Spark derives from tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.variant import to_variant, uri_of


def _literal_regex(sep: str) -> str:
    return "\\Q" + sep + "\\E" if "\\E" not in sep else re.escape(sep)


def allow_repeated_keys(spark: SparkSession) -> None:
    """JSON objects with a repeated key keep the last value, as Python's parser does,
    in whatever session the reader is used."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _split_lines(lines: DataFrame, sep: str, value_col: str) -> DataFrame:
    """``(line, key, text)`` of lines that are not blank."""
    line = F.regexp_replace(F.col(value_col), r"^\s+|\s+$", "")
    parts = F.split(F.col("line"), _literal_regex(sep), 2)
    keyed = F.size(parts) > 1
    return lines.select(line.alias("line")).where(F.length("line") > 0).select(
        "line", F.when(keyed, parts[0]).alias("key"), F.when(keyed, parts[1]).otherwise(parts[0]).alias("text")
    )


def split_keyed_lines(lines: DataFrame, sep: str = "\t", value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(documents, rejected)``: lines ``key<sep>json`` as ``(uri, doc)``, and the
    lines that are no document as ``(value, reason)`` - malformed JSON, or neither a
    key nor a ``uri`` / ``@id`` in the document. Every line that is not blank is in one
    of the two."""
    allow_repeated_keys(lines.sparkSession)
    parsed = _split_lines(lines, sep, value_col).withColumn("doc", F.try_parse_json("text"))
    parsed = parsed.withColumn("uri", F.coalesce("key", uri_of(F.col("doc"))))
    reason = F.when(F.col("doc").isNull(), F.lit("malformed JSON")).when(F.col("uri").isNull(), F.lit("no key"))
    parsed = parsed.withColumn("reason", reason)
    good = parsed.where(F.col("reason").isNull()).select("uri", "doc")
    return good, parsed.where(F.col("reason").isNotNull()).select(F.col("line").alias("value"), "reason")


def parse_keyed_lines(lines: DataFrame, sep: str = "\t", value_col: str = "value") -> DataFrame:
    """Lines ``key<sep>json`` → ``(uri, doc)``.

    The line is stripped of surrounding white space; blank lines are skipped.
    The line is split at the first separator only, so the JSON part may hold
    the separator. A line without separator is all JSON; its key is the
    document's own ``uri`` / ``@id``. Malformed JSON and a document without any key
    are errors; ``split_keyed_lines`` hands such lines back instead."""
    allow_repeated_keys(lines.sparkSession)
    parsed = _split_lines(lines, sep, value_col).withColumn("doc", F.parse_json("text"))
    failed = F.raise_error(F.concat(F.lit("document without a key: "), F.substring("line", 1, 200))).cast("string")
    return parsed.select(F.coalesce("key", uri_of(F.col("doc")), failed).alias("uri"), "doc")


def read_keyed_json(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    return parse_keyed_lines(spark.read.text(path), sep=sep)


def read_keyed_json_split(spark: SparkSession, path: str, sep: str = "\t") -> tuple[DataFrame, DataFrame]:
    return split_keyed_lines(spark.read.text(path), sep=sep)


def format_keyed_lines(docs: DataFrame, sep: str = "\t") -> DataFrame:
    """``(uri, doc)`` → lines ``uri<sep>json`` in column ``value``. A document without
    a key cannot be written and is an error; so is a key that contains the separator or a line
    end, because its line could not be read back."""
    broken = F.contains("uri", F.lit(sep)) | F.contains("uri", F.lit("\n")) | F.contains("uri", F.lit("\r"))
    message = F.concat(F.lit("key with a separator or line end: "), F.to_json(F.array("uri")))
    key = F.when(F.col("uri").isNull(), F.raise_error(F.lit("document without a key")).cast("string"))
    key = key.when(broken, F.raise_error(message).cast("string")).otherwise(F.col("uri"))
    return docs.select(F.concat(key, F.lit(sep), F.to_json("doc")).alias("value"))


def write_keyed_json(docs: DataFrame, path: str, sep: str = "\t", mode: str = "errorifexists") -> None:
    format_keyed_lines(docs, sep).write.mode(mode).text(path)


def parse_delimited_base(lines: DataFrame, sep: str = "\t", value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Delimited ``uri<sep>name[<sep>...]`` rows → base documents
    ``{"uri", "name"}`` keyed by uri; extra columns are ignored. Rows with fewer
    than two fields are returned as the second DataFrame (column ``value``)."""
    parts = F.split(F.col(value_col), _literal_regex(sep))
    good = F.size(parts) >= 2
    docs = lines.where(good).select(
        parts[0].alias("uri"),
        to_variant(F.struct(parts[0].alias("uri"), parts[1].alias("name"))).alias("doc"),
    )
    rejected = lines.where(~good).select(F.col(value_col).alias("value"))
    return docs, rejected


def read_delimited_base(spark: SparkSession, path: str, sep: str = "\t") -> tuple[DataFrame, DataFrame]:
    return parse_delimited_base(spark.read.text(path), sep=sep)
