"""Merging a stream of documents against a static base."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame

from ..operators.merge import basic_merge


def start_merge_stream(
    docs_stream: DataFrame,
    path: str | Sequence[str],
    base: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint_location: str,
    *,
    max_refs: int | None = None,
    remove: Iterable[str] = (),
    trigger: dict | None = None,
):
    """Start a query that merges every micro-batch of ``(uri, doc)`` documents
    with ``base`` (the batch ``basic_merge`` plan, one batch at a time) and
    hands the merged documents to ``sink(df, batch_id)``. A replayed batch is
    merged again from the same input, so an idempotent sink sees the same
    result."""
    remove = list(remove)

    def run(batch: DataFrame, batch_id: int) -> None:
        sink(basic_merge(batch.select("uri", "doc"), path, base, max_refs=max_refs, remove=remove), batch_id)

    writer = docs_stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
