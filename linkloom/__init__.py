"""linkloom: entity document merge, clean, dedup and framing on Spark.

A document set is a DataFrame ``(uri STRING, doc VARIANT)``. Jobs are plain
DataFrame → DataFrame functions built from joins, aggregations and generated
column expressions, so Catalyst and adaptive execution plan them.
"""

from .operators import (
    basic_merge, clean, deduplicate, expand_lists, filter_by_class, link_merge, one_per_uri,
    project_keys, resolve_links, self_links, split_by_classes,
)
from .plans import compute_frames_increment, frame_documents, increment_plan
from .sources import (
    links_from_documents, load_catalogue, load_table_documents, parse_delimited_base, parse_keyed_lines,
    read_keyed_json, write_keyed_json,
)

__all__ = [
    "basic_merge", "clean", "compute_frames_increment", "deduplicate", "expand_lists", "filter_by_class",
    "frame_documents", "increment_plan", "link_merge", "links_from_documents", "load_catalogue",
    "load_table_documents", "one_per_uri", "parse_delimited_base", "parse_keyed_lines", "project_keys",
    "read_keyed_json", "resolve_links", "self_links", "split_by_classes", "write_keyed_json",
]
