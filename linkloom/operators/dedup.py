"""Removing duplicate array elements at a path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.edit import distinct_elements, each_element, edit_at
from .keys import is_unique, mark_unique


def deduplicate(docs: DataFrame, path: str | Sequence[str]) -> DataFrame:
    """Where the value at ``path`` is an array, keep the first of each group of
    JSON-equal elements (object key order and ``1`` vs ``1.0`` do not matter). In
    a document that is an array, each of its elements is treated so. A narrow projection: no shuffle, keys and row count unchanged."""
    def on_elements(x):
        return each_element(x, lambda e: edit_at(e, path, distinct_elements))

    out = docs.select("uri", on_elements(F.col("doc")).alias("doc"))
    return mark_unique(out) if is_unique(docs) else out
