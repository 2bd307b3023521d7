"""Key encoding, document fingerprints, class tests and link documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .variant import as_array, as_string, field, let, to_variant


def key_hex(uri: Column) -> Column:
    """Lower-case hex of the UTF-8 bytes of a key."""
    return F.lower(F.hex(F.encode(uri, "UTF-8")))


def key_unhex(h: Column) -> Column:
    return F.decode(F.unhex(h), "UTF-8")


#: ``.0`` of a whole number; the first alternative steps over JSON strings.
_WHOLE = r'("(?:[^"\\]|\\.)*+")|(?<=\d)\.0(?![\dE])'


def canonical_json(doc: Column) -> Column:
    """JSON text with sorted keys and no spaces (as VARIANT writes it) in which a
    whole number looks the same whether it is stored as an integer, a decimal or a
    floating-point number."""
    return let(F.to_json(doc), lambda j: F.when(F.contains(j, F.lit(".0")), F.regexp_replace(j, _WHOLE, "$1")).otherwise(j))


def fingerprint(doc: Column) -> Column:
    """Upper-case SHA-1 of the canonical JSON text: equal documents hash equal.
    (A typed document must have been made by ``with_variant`` for numbers that
    floating point writes with an exponent.)"""
    return F.upper(F.sha1(canonical_json(doc)))


def has_class(doc: Column, short_name: str, long_name: str | None = None) -> Column:
    """True when the document's class (``a``, else ``@type``; a string or a
    list of strings) is ``short_name`` or ``long_name``."""
    names = [n for n in (short_name, long_name) if n is not None]
    cls = F.coalesce(field(doc, "a"), field(doc, "@type"))
    listed = F.transform(as_array(cls), as_string)
    in_list = F.exists(listed, lambda s: s.isin(names))
    return F.coalesce(F.when(listed.isNotNull(), in_list).otherwise(as_string(cls).isin(names)), F.lit(False))


def link_document(source_uri: Column, base_uri: Column) -> Column:
    """``{"uri": source, "matches": [{"uri": base}]}`` as a VARIANT."""
    return to_variant(
        F.struct(
            source_uri.alias("uri"),
            F.array(F.struct(base_uri.alias("uri"))).alias("matches"),
        )
    )
