"""Column-level building blocks (paths, VARIANT helpers, extraction, edits)."""

from .edit import distinct_elements, each_element, edit_at, lookup, match_table, replace_refs
from .extract import objects_at, refs_at
from .identity import canonical_json, fingerprint, has_class, key_hex, key_unhex, link_document
from .paths import parse_path
from .variant import as_array, as_object, as_string, field, let, overlay, string_field, to_variant, uri_of, with_variant

__all__ = [
    "as_array", "as_object", "as_string", "canonical_json", "distinct_elements", "each_element", "edit_at", "field",
    "fingerprint", "has_class", "key_hex", "key_unhex", "let", "link_document", "lookup", "match_table", "objects_at",
    "overlay", "parse_path", "refs_at", "replace_refs", "string_field", "to_variant", "uri_of",
    "with_variant",
]
