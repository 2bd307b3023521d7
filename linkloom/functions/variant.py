"""Column builders over the VARIANT document representation.

Documents are ``VARIANT`` values. While a document is edited, an object is
viewed as ``MAP<STRING, VARIANT>`` and an array as ``ARRAY<VARIANT>`` (both by
``try_cast``, NULL for any other kind) and rebuilt with ``to_variant_object``.
Everything here returns a Catalyst expression; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .paths import variant_path

OBJECT = T.MapType(T.StringType(), T.VariantType())
ARRAY = T.ArrayType(T.VariantType())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable so ``body`` can use it more than
    once without repeating (and re-evaluating) the expression."""
    return F.transform(F.array(value), body)[0]


def as_object(v: Column) -> Column:
    return v.try_cast(OBJECT)


def as_array(v: Column) -> Column:
    return v.try_cast(ARRAY)


def field(v: Column, key: str) -> Column:
    """Value under ``key`` when ``v`` is an object holding it, else NULL.
    A JSON null value comes back as a variant null (not SQL NULL)."""
    path = variant_path(key)
    if path is None:
        return F.element_at(as_object(v), F.lit(key))
    return F.try_variant_get(v, path, "variant")


def string_field(v: Column, key: str) -> Column:
    """Text under ``key`` when it is a JSON string; NULL for every other kind."""
    path = variant_path(key)
    if path is None:
        return as_string(field(v, key))
    return F.when(F.schema_of_variant(field(v, key)) == "STRING", F.try_variant_get(v, path, "string"))


def as_string(v: Column) -> Column:
    """The text of a JSON string value; NULL for every other kind."""
    return F.when(F.schema_of_variant(v) == "STRING", v.try_cast("string"))


def uri_of(v: Column) -> Column:
    """Identity of a reference: a string is itself, an object names itself by
    ``uri`` or else ``@id``; anything else has none."""
    return F.coalesce(string_field(v, "uri"), string_field(v, "@id"), as_string(v))


def overlay(obj: Column, base: Column, remove: Iterable[str] = ()) -> Column:
    """Shallow overlay of two objects given as maps: drop the ``remove`` keys
    from ``obj``, then every key of ``base`` replaces or adds to it.
    ``map_zip_with`` pairs the keys of both maps through a hash table, so this
    is linear in the two objects' sizes."""
    remove = list(remove)
    kept = F.map_filter(obj, lambda k, _v: ~k.isin(remove)) if remove else obj
    return F.to_variant_object(F.map_zip_with(kept, base, lambda _k, mine, theirs: F.coalesce(theirs, mine)))


def to_variant(c: Column, kind: T.DataType | None = None) -> Column:
    """Turn a typed column (struct / array / map / scalar) into a VARIANT.

    With its type ``kind`` given, floating-point numbers that a decimal holds
    exactly become decimals, as the JSON parser reads them: a typed document and
    the same one parsed from text are then equal and have one fingerprint."""
    return F.to_variant_object(c if kind is None else _parsed_alike(c, kind))


def _parsed_alike(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        exact = c.cast("string").try_cast("decimal(38,18)")
        return F.when(exact.cast(kind) == c, exact.cast("variant")).otherwise(c.cast("variant"))
    if isinstance(kind, T.StructType):
        inner = F.struct(*[_parsed_alike(c[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda e: _parsed_alike(e, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _k, v: _parsed_alike(v, kind.valueType))
    return c


def with_variant(df: DataFrame, struct: Column, name: str = "doc") -> DataFrame:
    """``df`` with the typed ``struct`` as a VARIANT document in column ``name``."""
    kind = df.select(struct.alias("_typed")).schema["_typed"].dataType
    return df.withColumn(name, to_variant(struct, kind))
