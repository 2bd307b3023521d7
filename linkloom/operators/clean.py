"""Refreshing embedded entities from a cleaner version of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.variant import as_object
from .keys import is_unique
from .merge import merge_matches


def clean(
    docs: DataFrame,
    path: str | Sequence[str],
    base: DataFrame,
    *,
    unique_uris: bool = False,
    unique_base: bool = False,
    num_partitions: int | None = None,
) -> DataFrame:
    """Overlay each entity at ``path`` with the base document of the same uri.
    Base documents that are not non-empty objects replace nothing."""
    usable = base.select("uri", "doc").where(F.size(as_object(F.col("doc"))) > 0)
    unique_base = unique_base or is_unique(base)
    return merge_matches(
        docs, path, usable, unique_uris=unique_uris, unique_base=unique_base,
        num_partitions=num_partitions,
    )
