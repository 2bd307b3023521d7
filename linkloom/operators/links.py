"""Link merge, link resolution and self links."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identity import link_document
from ..sources.links import links_from_documents
from .keys import few_repeats
from .merge import _one_base_per_key, merge_matches, one_link_per_source
from .skew import salted_join


def resolve_links(links: DataFrame, base: DataFrame, unique_base: bool = False) -> DataFrame:
    """Base documents re-keyed by the source uris that link to them, one row
    ``(uri = source_uri, doc = base document)`` for every link to an existing
    base document (a source can have several). A base uri that very many sources
    link to is salted."""
    base = base.select("uri", "doc").where(F.col("uri").isNotNull())
    base = (base if unique_base else few_repeats(base)).select(F.col("uri").alias("base_uri"), F.col("doc").alias("base"))
    pairs = links.select("source_uri", "base_uri").distinct()
    joined = salted_join(pairs, base, ["base_uri"], "source_uri", None, None if unique_base else _one_base_per_key)
    return joined.select(F.col("source_uri").alias("uri"), F.col("base").alias("doc"))


def link_merge(
    docs: DataFrame,
    path: str | Sequence[str],
    base: DataFrame,
    links: DataFrame,
    remove: Iterable[str] = (),
    *,
    unique_uris: bool = False,
    unique_base: bool = False,
    num_partitions: int | None = None,
) -> DataFrame:
    """Merge like ``basic_merge``, but a reference names a *source* uri that
    the linking results map to a base uri. ``links`` is either
    ``(source_uri, base_uri)`` or link documents ``(uri, doc)``. Attributes in
    ``remove`` are dropped from an object reference before it is overlaid.

    The reference pairs are translated through the (narrow, string-only)
    links before the base is joined, so base documents are not re-keyed. Links to
    base uris that do not exist are set aside first; of several others of one
    source the smallest base uri is taken."""
    if "source_uri" not in links.columns:
        links = links_from_documents(links)
    return merge_matches(
        docs, path, base, links=links, remove=remove,
        unique_uris=unique_uris, unique_base=unique_base, num_partitions=num_partitions,
    )


def self_links(docs: DataFrame) -> DataFrame:
    """A link document ``{"uri": u, "matches": [{"uri": u}]}`` per document
    key, as ``(uri, doc)``. Such identity links are dropped by
    ``links_from_documents`` unless ``keep_identity=True``."""
    return docs.select("uri", link_document(F.col("uri"), F.col("uri")).alias("doc"))
