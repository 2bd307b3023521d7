"""Readers and writers for document sets."""

from .catalogue import load_catalogue, read_json_config, unique_types
from .links import links_from_documents, split_link_documents
from .sequence import (
    read_documents, read_sequence_documents, text_to_sequence, write_documents, write_sequence_documents,
)
from .tables import load_table_documents, unescaped
from .text import (
    format_keyed_lines, parse_delimited_base, parse_keyed_lines, read_delimited_base, read_keyed_json,
    read_keyed_json_split, split_keyed_lines, write_keyed_json,
)

__all__ = [
    "format_keyed_lines", "links_from_documents", "load_catalogue", "load_table_documents",
    "parse_delimited_base", "parse_keyed_lines", "read_delimited_base", "read_documents",
    "read_json_config", "read_keyed_json", "read_keyed_json_split", "read_sequence_documents",
    "split_keyed_lines", "split_link_documents", "text_to_sequence", "unescaped", "unique_types",
    "write_documents", "write_keyed_json", "write_sequence_documents",
]
