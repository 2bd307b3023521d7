"""Entity-linking results as a DataFrame of ``(source_uri, base_uri)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.variant import as_string, string_field


def split_link_documents(link_docs: DataFrame, keep_identity: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(links, rejected)``: link documents ``{"uri": source, "matches": [{"uri":
    base, ...}, ...]}`` as ``(source_uri, base_uri)``, and the documents that lack
    either end as they came. Only the first match is used (``score`` is not read).
    Identity links (source equals base) are left out of ``links`` unless
    ``keep_identity``."""
    ends = _ends(link_docs)
    complete = F.col("source_uri").isNotNull() & F.col("base_uri").isNotNull()
    links = ends.where(complete).select("source_uri", "base_uri")
    if not keep_identity:
        links = links.where(F.col("source_uri") != F.col("base_uri"))
    return links, ends.where(~complete).select(*link_docs.columns)


def links_from_documents(link_docs: DataFrame, keep_identity: bool = False) -> DataFrame:
    """``(source_uri, base_uri)`` of link documents (see ``split_link_documents``); a
    document that lacks either end is an error."""
    complete = F.col("source_uri").isNotNull() & F.col("base_uri").isNotNull()
    failed = F.raise_error(F.concat(F.lit("link document without both ends: "), F.coalesce(F.to_json("doc"), F.lit("null"))))
    out = _ends(link_docs).select(F.when(complete, F.struct("source_uri", "base_uri")).otherwise(failed).alias("link")).select("link.*")
    if not keep_identity:
        out = out.where(F.col("source_uri") != F.col("base_uri"))
    return out


def _ends(link_docs: DataFrame) -> DataFrame:
    doc = F.col("doc")
    return link_docs.withColumns({
        "source_uri": string_field(doc, "uri"),
        "base_uri": as_string(F.try_variant_get(doc, "$.matches[0].uri", "variant")),
    })
