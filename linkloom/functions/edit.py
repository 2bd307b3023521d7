"""Rewriting values at a document path (edit side of the engine).

``edit_at(doc, steps, leaf)`` returns the document with ``leaf`` applied to the
value stored under the last key of ``steps``, in every object reached by the
earlier steps. Inner steps descend into an object value or into each object of
an array value; other values and nested arrays are left alone. Only objects on
the path are rebuilt; a document without the path is returned as it is.

The generated expression has one copy of each level (values are bound with
``let``), so its size grows linearly with the path length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .identity import canonical_json
from .paths import parse_path
from .variant import as_array, as_object, let, overlay, uri_of

Leaf = Callable[[Column], Column]

#: A match table of so many references is searched one by one, in one native loop.
FEW = 32


def each_element(x: Column, fn: Leaf) -> Column:
    """Apply ``fn`` to every element if ``x`` is an array, else to ``x``."""

    def with_array(a: Column) -> Column:
        return let(
            F.transform(F.coalesce(a, F.array(x)), fn),
            lambda r: F.when(a.isNull(), r[0]).otherwise(F.to_variant_object(r)),
        )

    return let(as_array(x), with_array)


def edit_at(v: Column, path: str | Sequence[str], leaf: Leaf) -> Column:
    steps = parse_path(path)
    key, rest = steps[0], steps[1:]

    def on_object(o: Column) -> Column:
        def change(k: Column, x: Column) -> Column:
            new = each_element(x, lambda e: edit_at(e, rest, leaf)) if rest else leaf(x)
            return F.when(k == F.lit(key), new).otherwise(x)

        return F.when(F.element_at(o, F.lit(key)).isNull(), v).otherwise(
            F.to_variant_object(F.transform_values(o, change))
        )

    return let(as_object(v), on_object)


def match_table(refs: Column, bases: Column) -> Column:
    """Aggregate expression building one document's match table: the distinct
    references sorted, and their base documents in the same order
    (``struct<keys: array<string>, vals: array<variant>>``). ``lookup``
    binary-searches it, so a document naming n references is rewritten in
    O(n log n). (A SQL MAP or a VARIANT object would be searched key by key,
    quadratic for documents with very many references.) The table holds what the
    merged document will hold, the base document of each reference once."""
    entries = F.collect_list(F.struct(refs.alias("k"), bases.alias("v")))
    # sort_array compares structs natively, array_sort through a lambda; no entry is null
    order = F.sort_array(F.transform(entries, lambda e, i: F.struct(e["k"].alias("k"), i.alias("i"))))
    return F.struct(
        F.transform(order, lambda o: o["k"]).alias("keys"),
        F.transform(order, lambda o: entries[o["i"]]["v"]).alias("vals"),
    )


def lookup(table: Column, ref: Column) -> Column:
    """Base document for ``ref`` in a ``match_table``; NULL when absent. A table of up to
    ``FEW`` references is searched from its start, a larger one by binary search:
    ``ceil(log2(n + 1))`` halving steps (``aggregate`` over a short ``sequence``)."""
    keys, vals = table["keys"], table["vals"]
    n = F.size(keys)
    among_few = F.get(vals, (F.array_position(keys, ref) - 1).cast("int"))

    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.log2(n + 1)).cast("int")))
    start = F.struct(F.lit(0).alias("lo"), n.alias("hi"))

    def halve(s: Column, _step: Column) -> Column:
        mid = ((s["lo"] + s["hi"]) / 2).cast("int")
        narrowed = F.when(keys[mid] < ref, F.struct((mid + 1).alias("lo"), s["hi"].alias("hi"))).otherwise(
            F.struct(s["lo"].alias("lo"), mid.alias("hi")))
        return F.when(s["lo"] < s["hi"], narrowed).otherwise(s)

    found = F.aggregate(steps, start, halve)
    among_many = let(found["lo"], lambda lo: F.when((lo < n) & (keys[lo] == ref), vals[lo]))
    return F.when(n <= FEW, among_few).otherwise(among_many)


def replace_refs(matches: Column, remove: Iterable[str] = (), key_prefix: str | None = None) -> Leaf:
    """Leaf rewrite for merges. ``matches`` is a per-row ``match_table`` from
    reference uri to base document. A string reference becomes the base
    document; an object reference is overlaid with it (after dropping the
    ``remove`` keys). Arrays are handled element by element; values without a
    match are kept. With ``key_prefix`` the table keys are ``prefix + uri``."""
    remove = list(remove)

    def one(e: Column) -> Column:
        def with_base(b: Column) -> Column:
            def with_obj(o: Column) -> Column:
                return F.when(o.isNull(), b).otherwise(
                    let(as_object(b), lambda bo: F.when(bo.isNull(), e).otherwise(overlay(o, bo, remove)))
                )

            return F.when(b.isNull(), e).otherwise(let(as_object(e), with_obj))

        ref = uri_of(e) if key_prefix is None else F.concat(F.lit(key_prefix), uri_of(e))
        return let(lookup(matches, ref), with_base)

    return lambda x: each_element(x, one)


def distinct_elements(x: Column) -> Column:
    """Leaf rewrite for deduplication: an array keeps the first of each group of
    JSON-equal elements, in order and as they are stored; the canonical text only
    serves as the key. Any other value, and an array without duplicates, is unchanged."""

    def on_array(a: Column) -> Column:
        def firsts(keys: Column) -> Column:
            keyed = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
            return F.when(F.size(F.array_distinct(keys)) == F.size(a), x).otherwise(let(keyed, shorter))

        def shorter(s: Column) -> Column:
            # the first of equal keys in key order has the smallest place
            heads = F.filter(s, lambda e, i: (i == 0) | ~e["k"].eqNullSafe(F.get(s, i - 1)["k"]))
            places = F.sort_array(F.transform(heads, lambda e: e["i"]))
            return F.to_variant_object(F.transform(places, lambda i: a[i]))

        return F.when(a.isNull(), x).otherwise(let(F.transform(a, lambda e: canonical_json(e)), firsts))

    return let(as_array(x), on_array)
