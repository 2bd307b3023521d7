"""Merging base documents into references at one or more paths.

All merge-style jobs (basic merge, link merge, clean, frames) share one plan:

1. ``docs``: one document per uri, chosen in the shuffle of step 6; skipped when the caller
   declares them unique. The base is made one per uri the same way in the shuffle of step
   4. Only documents whose uri is repeated are digested (``keys.py``);
2. ``pairs``: the distinct reference uris of each document per merge slot
   (a slot is one ``(path, base)``; narrow), shuffled once by ``uri``;
3. optionally translate each reference through links (``ref → base_uri``);
4. join the pairs with the base on the base uri (AQE broadcasts a small base
   from its measured size; a base uri named by very many documents is salted,
   see ``skew.py``);
5. group the matches per document into one match table: the (slot)
   references sorted, with their base documents in the same order, looked up
   by binary search;
6. left-join back on ``uri`` and rewrite every slot's path in one expression.

The input is read twice, for the pairs and for the documents, whatever the number of slots;
documents are shuffled once per merge (step 6) and base documents travel only through steps
4-5. A document without a key takes part under a key of its own, made of its content, that
nothing matches; so it needs no read of its own and does not gather in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.edit import edit_at, match_table, replace_refs
from ..functions.extract import refs_at
from ..functions.paths import parse_path
from ..functions.variant import let
from .keys import few_repeats, is_unique, mark_unique, one_of_each, with_own_key
from .skew import SkewSettings, estimated_bytes, salted_join

#: Documents of one task where the caller gives a number of partitions, by Spark's estimate
#: (which counts 2 KB for a document).
PARTITION_BYTES = 64 << 20
#: No table is so large; the size of rows that are in no file is taken for more.
UNKNOWN_BYTES = 1 << 50


@dataclass
class Slot:
    """One merge target: references at ``path`` resolved against ``base``."""

    path: str | Sequence[str]
    base: DataFrame
    max_refs: int | None = None
    unique_base: bool = False

    @property
    def unique(self) -> bool:
        return self.unique_base or is_unique(self.base)


def _one_base_per_key(df: DataFrame, group_keys: list[str]) -> DataFrame:
    """One base document per join key, chosen like ``one_per_uri``, in the join's own shuffle."""
    return one_of_each(df, group_keys, "base", group_keys[-2] if group_keys[-1] == "_salt" else group_keys[-1])


def partitions_for(docs: DataFrame, num_partitions: int | None) -> int | None:
    """The partitions that ``docs`` are dealt into where ``num_partitions`` are asked for: the
    smallest multiple of it that leaves a task ``PARTITION_BYTES`` by Spark's estimate, so
    that a task's sorts do not grow with the input. Where Spark has no estimate (it then
    says exabytes) the number stays as it is."""
    if num_partitions is None or num_partitions <= 0:
        return None
    size = estimated_bytes(docs)
    return num_partitions * (max(1, -(-size // (num_partitions * PARTITION_BYTES))) if size < UNKNOWN_BYTES else 1)


def _prepare(docs: DataFrame, unique_uris: bool, num_partitions: int | None) -> DataFrame:
    """``uri, doc, _key``: one document per key, and all that have none. With
    ``num_partitions`` they are hash-partitioned by it, so that neither the choice among
    repeated keys nor the join back needs a shuffle of its own."""
    docs = with_own_key(docs if unique_uris else few_repeats(docs))
    if num_partitions is not None:
        docs = docs.repartition(num_partitions, "_key")
    return docs if unique_uris else one_of_each(docs, ["_key"])


def _bases(slot: Slot) -> DataFrame:
    """The slot's base documents; those without a uri match nothing."""
    base = slot.base.select("uri", "doc").where(F.col("uri").isNotNull())
    return base if slot.unique else few_repeats(base)


def _capped(refs: Column, max_refs: int | None) -> Column:
    if max_refs is None:
        return refs
    if max_refs < 0:
        raise ValueError("max_refs must be >= 0")
    return F.slice(refs, 1, max_refs) if max_refs > 0 else F.filter(refs, lambda _u: F.lit(False))


def reference_pairs(docs: DataFrame, path: str | Sequence[str], max_refs: int | None = None) -> DataFrame:
    """``(uri, ref)``: the distinct references of each document at ``path``;
    with ``max_refs`` only the first ``max_refs`` found (duplicates counted). No ref is null;
    the filter that a join on it would add is there from the start, so that the hot-key
    sketch and the join share one shuffle."""
    refs = _capped(refs_at(F.col("doc"), path), max_refs)
    return docs.select("uri", F.explode(F.array_distinct(refs)).alias("ref")).where(F.col("ref").isNotNull())


def _tag(i: int):
    # one-argument lambdas only: Spark's transform reads a second one as the index
    return lambda r: F.concat(F.lit(f"{i}:"), r)


def _then_edit(steps: list[str], leaf):
    return lambda d: edit_at(d, steps, leaf)


def links_to_existing(links: DataFrame, base: DataFrame) -> DataFrame:
    """The links whose base uri names a base document, each once."""
    return links.select("source_uri", "base_uri").distinct().join(
        base.select(F.col("uri").alias("base_uri")).distinct(), "base_uri", "left_semi"
    ).select("source_uri", "base_uri")


def one_link_per_source(links: DataFrame) -> DataFrame:
    """A source linked to several bases keeps the smallest base uri
    (a partial ``min`` aggregate over two strings)."""
    return links.groupBy("source_uri").agg(F.min("base_uri").alias("base_uri"))


def merge_slots(
    docs: DataFrame,
    slots: Sequence[Slot],
    *,
    links: DataFrame | None = None,
    remove: Iterable[str] = (),
    unique_uris: bool = False,
    num_partitions: int | None = None,
    skew: SkewSettings | None = None,
) -> DataFrame:
    """Shared merge plan; see the module docstring. Slot paths must not be
    prefixes of one another. ``links`` (single slot only) has columns
    ``(source_uri, base_uri)``; a source linked to several existing base documents
    takes the one with the smallest uri. Documents too many for ``num_partitions`` tasks are
    dealt into a multiple of it."""
    skew = skew or SkewSettings.of(docs.sparkSession)
    if not slots:
        raise ValueError("no merge slot")
    if links is not None and len(slots) != 1:
        raise ValueError("links apply to a single slot")
    steps = [parse_path(s.path) for s in slots]
    for i, a in enumerate(steps):
        for b in steps[i + 1:]:
            n = min(len(a), len(b))
            if a[:n] == b[:n]:
                raise ValueError(f"merge paths overlap: {a} and {b}")
    multi = len(slots) > 1
    num_partitions = partitions_for(docs.select("uri", "doc"), num_partitions)
    docs = _prepare(docs.select("uri", "doc"), unique_uris or is_unique(docs), num_partitions)
    remove = list(remove)
    keyed = docs.where(F.col("uri").isNotNull())
    # as many partitions as the documents have, so that the join back shuffles neither
    dealt = [num_partitions, "uri"] if num_partitions is not None else ["uri"]

    if not multi:
        pairs = reference_pairs(keyed, steps[0], slots[0].max_refs).repartition(*dealt)
        if links is None:
            pairs = pairs.withColumn("base_uri", F.col("ref"))
        else:
            links = one_link_per_source(links_to_existing(links, slots[0].base))
            pairs = salted_join(pairs, links.select(F.col("source_uri").alias("ref"), "base_uri"), ["ref"], "uri", skew)
        base = _bases(slots[0]).select(F.col("uri").alias("base_uri"), F.col("doc").alias("base"))
        reduce = None if slots[0].unique else _one_base_per_key
        matched = salted_join(pairs, base, ["base_uri"], "uri", skew, reduce).select("uri", "ref", "base")
    else:
        # a slot's references carry its number: a column of its own would have few values, and
        # the filter that a join infers from them keeps the sketch from sharing the shuffle
        per_slot = [
            F.transform(F.array_distinct(_capped(refs_at(F.col("doc"), st), s.max_refs)), _tag(i))
            for i, (s, st) in enumerate(zip(slots, steps))
        ]
        pairs = keyed.select("uri", F.explode(F.concat(*per_slot)).alias("ref")).where(F.col("ref").isNotNull()).repartition(*dealt)
        bases = None
        for i, s in enumerate(slots):
            b = _bases(s).select(_tag(i)(F.col("uri")).alias("ref"), F.col("doc").alias("base"))
            bases = b if bases is None else bases.unionByName(b)
        reduce = None if all(s.unique for s in slots) else _one_base_per_key
        matched = salted_join(pairs, bases, ["ref"], "uri", skew, reduce).select("uri", "ref", "base")

    matches = matched.groupBy("uri").agg(match_table(F.col("ref"), F.col("base")).alias("matches")).withColumnRenamed("uri", "_key")
    merged = F.col("doc")
    for i, st in enumerate(steps):
        prefix = f"{i}:" if multi else None
        leaf = replace_refs(F.col("matches"), remove, key_prefix=prefix)
        merged = edit_at(merged, st, leaf) if i == 0 else let(merged, _then_edit(st, leaf))
    found = F.col("matches").isNotNull() & F.col("uri").isNotNull()
    return mark_unique(docs.join(matches, "_key", "left").select("uri", F.when(found, merged).otherwise(F.col("doc")).alias("doc")))


def merge_matches(
    docs: DataFrame,
    path: str | Sequence[str],
    base: DataFrame,
    *,
    links: DataFrame | None = None,
    max_refs: int | None = None,
    remove: Iterable[str] = (),
    unique_uris: bool = False,
    unique_base: bool = False,
    num_partitions: int | None = None,
) -> DataFrame:
    return merge_slots(
        docs, [Slot(path, base, max_refs, unique_base)], links=links, remove=remove,
        unique_uris=unique_uris, num_partitions=num_partitions,
    )


def basic_merge(
    docs: DataFrame,
    path: str | Sequence[str],
    base: DataFrame,
    *,
    max_refs: int | None = None,
    remove: Iterable[str] = (),
    unique_uris: bool = False,
    unique_base: bool = False,
    num_partitions: int | None = None,
) -> DataFrame:
    """Replace every reference at ``path`` by the base document whose uri it
    names: a string reference becomes the base document, an object reference
    is overlaid with the base document's attributes. Unmatched references and
    documents without the path are unchanged; every input uri is kept once."""
    return merge_matches(
        docs, path, base, max_refs=max_refs, remove=remove, unique_uris=unique_uris,
        unique_base=unique_base, num_partitions=num_partitions,
    )


def basic_merge_many(
    docs: DataFrame,
    targets: Sequence[tuple[str | Sequence[str], DataFrame]],
    *,
    max_refs: int | None = None,
    unique_uris: bool = False,
    num_partitions: int | None = None,
) -> DataFrame:
    """``basic_merge`` at several paths (none a prefix of another) in one pass:
    equal to applying them one after the other, with one shuffle of docs."""
    return merge_slots(
        docs, [Slot(p, b, max_refs) for p, b in targets], unique_uris=unique_uris, num_partitions=num_partitions,
    )
