"""DataFrame → DataFrame document jobs. A document set is a DataFrame with
columns ``uri STRING`` and ``doc VARIANT``."""

from .classes import expand_lists, filter_by_class, project_keys, split_by_classes, union_documents
from .clean import clean
from .dedup import deduplicate
from .keys import one_per_uri
from .links import link_merge, resolve_links, self_links
from .merge import (
    Slot, basic_merge, basic_merge_many, links_to_existing, merge_matches, merge_slots, one_link_per_source, reference_pairs,
)

__all__ = [
    "Slot", "basic_merge", "basic_merge_many", "clean", "merge_slots", "deduplicate", "expand_lists", "filter_by_class", "link_merge",
    "links_to_existing",    "merge_matches", "one_link_per_source", "one_per_uri", "project_keys", "reference_pairs",
    "resolve_links", "self_links", "split_by_classes", "union_documents",
]
