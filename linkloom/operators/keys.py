"""One document per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import fingerprint
from .skew import SkewSettings, fits_broadcast, hot_hashes


def mark_unique(docs: DataFrame) -> DataFrame:
    """``docs``, remembered as one document per uri by the operators that ask ``is_unique``; a
    DataFrame made from it no longer is."""
    docs._one_per_uri = True
    return docs


def is_unique(docs: DataFrame) -> bool:
    return getattr(docs, "_one_per_uri", False) is True


def with_own_key(docs: DataFrame) -> DataFrame:
    """``uri, doc, _key``: the uri, or for a document without one a text made of its content,
    which spreads such documents. No uri is to be compared with it where ``uri`` is null."""
    own = F.concat(F.lit("\0"), F.xxhash64(F.to_json("doc")).cast("string"))
    return docs.select("uri", "doc", F.coalesce("uri", own, F.lit("\0")).alias("_key"))


def few_repeats(docs: DataFrame, settings: SkewSettings | None = None) -> DataFrame:
    """``docs`` with every uri that has more documents than the hot-key threshold collapsed to
    one document, so that no key's documents are too many for one task.

    Such uris come from a top-k sketch (of the uris only; at most ``skew.TOP``, so their
    broadcast has a bound), and only their documents go through an aggregation, which
    combines them before it shuffles. Where there are none, adaptive execution drops it."""
    settings = settings or SkewSettings.of(docs.sparkSession)
    if fits_broadcast(docs):  # a few megabytes in all
        return docs.select("uri", "doc")
    # a hash that is never null: the join adds no filter to the second read of ``docs``, which
    # would keep it from sharing the shuffles of the first; no uri at all is never hot
    hashed = docs.select("uri", "doc", F.xxhash64("uri").alias("_hash"))
    of_none = F.xxhash64(F.lit(None).cast("string"))
    hot = hot_hashes(docs.where(F.col("uri").isNotNull()), ["uri"], settings)
    hot = F.broadcast(hot.select(F.when(F.col("_hash") != of_none, F.col("_hash")).alias("_hash")))
    best = hashed.join(hot, "_hash", "left_semi").groupBy("uri").agg(F.max_by("doc", fingerprint(F.col("doc"))).alias("doc"))
    return hashed.join(hot, "_hash", "left_anti").select("uri", "doc").unionByName(best)


def one_of_each(rows: DataFrame, keys: Sequence[str], doc: str = "doc", uri: str = "uri") -> DataFrame:
    """Of the rows with equal ``keys`` the one whose document has the largest fingerprint; all
    rows without a ``uri``. It needs the rows together by ``keys`` and sorted, as a join on
    ``keys`` does: both share one shuffle and its sort. Only documents that share their keys
    with another one are digested."""
    group = Window.partitionBy(*keys)
    counted = rows.withColumn("_n", F.count(F.lit(1)).over(group))
    digest = F.when((F.col("_n") > 1) & F.col(uri).isNotNull(), fingerprint(F.col(doc)))
    ranked = counted.withColumn("_rank", F.row_number().over(group.orderBy(F.desc(digest))))
    return ranked.where((F.col("_rank") == 1) | F.col(uri).isNull()).select(rows.columns)


def one_per_uri(docs: DataFrame) -> DataFrame:
    """Collapse documents sharing a ``uri`` to one, deterministically: the one with
    the largest fingerprint. Documents without a key are all kept.

    Documents are shuffled once and digested only where their uri is repeated; a uri repeated
    very many times is combined before the shuffle. Callers whose keys are unique say so
    (``unique_uris``, ``unique_base``, ``"unique": true`` in a catalogue) and skip it."""
    if is_unique(docs):
        return docs
    return mark_unique(one_of_each(with_own_key(few_repeats(docs)), ["_key"]).select("uri", "doc"))
