"""Documents stored in any Spark table as a key column and a JSON column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import allow_repeated_keys


def unescaped(value: Column) -> Column:
    """Text with one level of backslash escapes undone: ``\\xNN`` (one character),
    ``\\uXXXX``, ``\\n`` and the like, ``\\"``, ``\\'`` and ``\\\\``. The text may be
    wrapped in quotes of its own; bare quotes inside it stay."""
    wrapped = (F.length(value) > 1) & F.startswith(value, F.lit('"')) & F.endswith(value, F.lit('"'))
    text = F.when(wrapped, value.substr(F.lit(2), F.length(value) - 2)).otherwise(value)
    # an escape starts at an odd backslash: after none, and pairs that stand for themselves
    odd = r"(?<!\\)((?:\\\\)*)"
    text = F.regexp_replace(text, odd + r"\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    text = F.regexp_replace(text, odd + r"\\'", "$1'")
    text = F.regexp_replace(text, odd + '"', r'$1\\"')
    for raw, name in (("\n", "n"), ("\r", "r"), ("\t", "t")):
        text = F.replace(text, F.lit(raw), F.lit("\\" + name))
    return F.try_variant_get(F.parse_json(F.concat(F.lit('"'), text, F.lit('"'))), "$", "string")


def load_table_documents(
    spark: SparkSession,
    source: str | DataFrame,
    key_col: str,
    value_col: str,
    *,
    is_json: bool = True,
    escaped: bool = False,
    fmt: str | None = None,
) -> DataFrame:
    """``(uri, doc)`` from a table name, a path (with ``fmt``) or a DataFrame.

    ``is_json`` parses the value (``\\uXXXX`` escapes are decoded by the
    parser); ``escaped`` first undoes one level of escapes of the stored text
    (``unescaped``). With ``is_json=False`` the value is kept as a VARIANT
    string."""
    allow_repeated_keys(spark)
    if isinstance(source, DataFrame):
        df = source
    elif fmt is not None:
        df = spark.read.format(fmt).load(source)
    else:
        df = spark.table(source)
    value = F.col(value_col).cast("string")
    if is_json:
        if escaped:
            value = unescaped(value)
        doc = F.parse_json(value)
    else:
        doc = value.cast("variant")
    return df.select(F.col(key_col).cast("string").alias("uri"), doc.alias("doc"))
