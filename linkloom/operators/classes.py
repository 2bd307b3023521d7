"""Class filters, class splits, explicit projection and list expansion."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identity import has_class
from ..functions.variant import as_array, as_object, let
from ..session import shared_path


def filter_by_class(docs: DataFrame, short_name: str, long_name: str | None = None) -> DataFrame:
    """Documents whose ``a`` (else ``@type``) names the class, as a string or
    inside a list; the short or the long class name both match."""
    return docs.where(has_class(F.col("doc"), short_name, long_name))


def split_by_classes(docs: DataFrame, classes: Iterable[Mapping[str, str]], path: str | None = None) -> dict[str, DataFrame]:
    """``{name: documents of that class}`` for descriptors ``{"name", "uri"}``.
    A document of several listed classes appears under each.

    The input is read once: its classes are computed in one pass, the documents are
    written by class (to ``path``, else to the shared checkpoint folder) and each
    entry reads its own folder only."""
    classes = list(classes)
    if not classes:
        return {}
    spark = docs.sparkSession
    path = path or shared_path(spark, "classes")
    tests = [F.when(has_class(F.col("doc"), c["name"], c.get("uri")), F.lit(i)) for i, c in enumerate(classes)]
    rows = docs.select("uri", "doc", F.explode(F.array_compact(F.array(*tests))).alias("class"))
    rows.write.partitionBy("class").parquet(path)
    schema = "uri string, doc variant, class int"
    split = spark.read.schema(schema).option("basePath", path)
    return {c["name"]: split.parquet(path).where(F.col("class") == i).select("uri", "doc") for i, c in enumerate(classes)}


def project_keys(docs: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keep only the listed top-level keys of each object document."""
    keys = sorted(set(keys))
    doc = F.col("doc")
    projected = let(
        as_object(doc),
        lambda o: F.when(o.isNull(), doc).otherwise(
            F.to_variant_object(F.map_filter(o, lambda k, _v: k.isin(keys)))
        ),
    )
    return docs.select("uri", projected.alias("doc"))


def expand_lists(docs: DataFrame) -> DataFrame:
    """A document that is an array becomes one row per element under the same
    key (an empty array gives no row); other documents pass through."""
    doc = F.col("doc")
    return docs.select("uri", F.explode(F.coalesce(as_array(doc), F.array(doc))).alias("doc"))


def union_documents(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0].select("uri", "doc")
    for p in parts[1:]:
        out = out.unionByName(p.select("uri", "doc"))
    return out
