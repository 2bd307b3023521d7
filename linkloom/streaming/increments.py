"""Incremental frames over a stream of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..plans.incremental import compute_frames_increment


def start_increment_stream(
    frames_stream: DataFrame,
    state_root: str,
    sink: Callable[[DataFrame, int], None],
    checkpoint_location: str,
    trigger: dict | None = None,
):
    """Start a query that, for every micro-batch of ``(uri, doc)`` frames, runs
    one incremental round against ``state_root`` and hands the new/changed
    documents to ``sink(increment_df, batch_id)``.

    A batch is stored under the query's id, which lives in its checkpoint, and its
    batch id. A batch replayed after a failure gets the same stored increment (the
    usual ``foreachBatch`` contract: the sink is idempotent per batch id). A query
    with a new checkpoint has a new id: it goes on from the state as it is and never
    sees an older query's batches."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("not called by a streaming query")
        increment = compute_frames_increment(spark, batch.select("uri", "doc"), state_root, run_id=query_id, batch_id=batch_id)
        sink(increment, batch_id)

    writer = frames_stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
