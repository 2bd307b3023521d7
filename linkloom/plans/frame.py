"""Assembling nested documents from typed sets, guided by a JSON-LD frame.

A frame node names a document set by ``@type``. With ``@explicit: true`` the
node's documents keep only the keys named in the node (before children are
merged). Every other key whose value is an object with ``@type`` is a child:
the child frame is built first (post-order) and merged into the parent at that
key with ``basic_merge``. ``{}`` (no ``@type``) only marks a key for inclusion,
``@embed: false`` leaves the reference as it is, keys starting with ``@`` are
keywords. A frame key is a single path step.

All embedded properties of one node are merged in a single pass
(``merge_slots``), so a node's documents are shuffled once however many
properties it frames, and a child's result (one document per uri) is used as
a base without another de-duplication. Everything is lineage built on the
driver; identical sub-frames are built once per call.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from ..operators.classes import project_keys
from ..operators.merge import Slot, merge_slots
from ..session import shared_path


def frame_documents(
    frame: Mapping,
    catalogue: Mapping[str, DataFrame],
    *,
    max_refs: int | None = None,
    unique_uris: bool = False,
    unique_types: Iterable[str] = (),
    num_partitions: int | None = None,
    checkpoint_children: bool = False,
) -> DataFrame:
    """Build the framed documents. ``unique_types`` names document sets whose uris are
    known to be unique, ``unique_uris`` says so of all sets; they are not
    de-duplicated. ``checkpoint_children`` writes every merged
    child result to the cluster's shared checkpoint folder
    (``spark.checkpoint.dir``) before its parent uses it, which cuts the
    lineage of deep frames (planning time, recovery after executor loss); a
    ``session.scratch_scope`` around it deletes them when the result is written."""
    built: dict[str, tuple[DataFrame, bool]] = {}
    declared = set(unique_types)

    def build(node: Mapping) -> tuple[DataFrame, bool]:
        """(documents of the node, whether they are already one per uri)"""
        if not isinstance(node, Mapping):
            raise ValueError(f"frame node must be an object, got {node!r}")
        if "@type" not in node:
            raise ValueError("frame node without @type")
        memo = json.dumps(node, sort_keys=True)
        if memo in built:
            return built[memo]
        type_name = node["@type"]
        if type_name not in catalogue:
            raise KeyError(f"no document set for type {type_name!r}")
        out = catalogue[type_name].select("uri", "doc")
        unique = known = unique_uris or type_name in declared
        if len(node) > 1:
            if node.get("@explicit") is True:
                out = project_keys(out, node.keys())
            slots = []
            for key, child in node.items():
                if key.startswith("@"):
                    continue
                if isinstance(child, Mapping) and ("@type" not in child or child.get("@embed") is False):
                    continue
                child_docs, child_unique = build(child)
                if checkpoint_children and len(child) > 1:
                    path = shared_path(child_docs.sparkSession, "frame")
                    child_docs.write.parquet(path)
                    child_docs = child_docs.sparkSession.read.schema(child_docs.schema).parquet(path)
                slots.append(Slot([key], child_docs, max_refs, child_unique))
            if slots:
                out = merge_slots(out, slots, unique_uris=known, num_partitions=num_partitions)
                unique = True
        built[memo] = (out, unique)
        return out, unique

    return build(frame)[0]
