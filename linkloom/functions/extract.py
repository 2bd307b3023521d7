"""Reading values at a document path (extraction side of the engine).

``objects_at(doc, steps)`` starts from the document (or its elements, if the
document is an array) and, for each key step, collects the value under that
key of every object reached; an array value contributes its elements (one
level), anything else itself. ``refs_at`` maps those values to reference uris
(string → itself, object → ``uri`` / ``@id``) and drops the rest; duplicates
and document order are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .paths import parse_path
from .variant import as_array, field, let, uri_of


def _values_under(key: str):
    # a one-argument lambda: Spark's transform treats a second one as the index
    return lambda e: let(field(e, key), lambda x: F.coalesce(as_array(x), F.filter(F.array(x), lambda y: y.isNotNull())))


def objects_at(doc: Column, path: str | Sequence[str]) -> Column:
    """ARRAY<VARIANT> of all values found at ``path``."""
    current = F.coalesce(as_array(doc), F.array(doc))
    for key in parse_path(path):
        current = F.flatten(F.transform(current, _values_under(key)))
    return current


def refs_at(doc: Column, path: str | Sequence[str]) -> Column:
    """ARRAY<STRING> of reference uris found at ``path``, in document order."""
    return F.filter(F.transform(objects_at(doc, path), uri_of), lambda u: u.isNotNull())
