"""Helpers of the corpus operators: shared scratch tables and a hot-key safe join."""

from __future__ import annotations

import ctypes
import functools
import gc
import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, delete_path, shared_path

#: A key with at least 1/HOT_SLICES of all rows is hot, so there are at most HOT_SLICES hot keys.
HOT_SLICES = 1024


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder (``session.scratch_scope`` owns it)."""
    return shared_path(spark, name)


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def stage(df: DataFrame, name: str, batch_rows: int | None = None, batch_bytes: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, and
    lost executors re-read files instead of recomputing the job. ``batch_rows`` are the
    rows that a worker is sent at once meanwhile, for rows that are large; ``batch_bytes``
    the bytes, unless the session has set its own."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_BATCH_ROWS)
    limited = batch_bytes is not None and spark.conf.get(_BATCH_BYTES, None) is None
    if batch_rows is not None:
        spark.conf.set(_BATCH_ROWS, str(min(batch_rows, int(before)) if int(before) > 0 else batch_rows))
    if limited:
        spark.conf.set(_BATCH_BYTES, str(batch_bytes))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_BATCH_ROWS, before)
        if limited:
            spark.conf.unset(_BATCH_BYTES)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(*staged: DataFrame) -> None:
    """Deletes tables that ``stage`` wrote; nothing that is still to run may read them."""
    for df in staged:
        delete_path(df.sparkSession, df._staged_at)


def share_file(spark: SparkSession, name: str, data: bytes) -> str:
    """Writes a small file to the shared checkpoint folder; returns its full path, from
    where executors can fetch it (``addFile``, ``addPyFile``)."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/{name}")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path)
    out.write(data)
    out.close()
    return str(fs.makeQualified(path).toString())


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hands this package to the workers, which may not have it on their path; once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    sc.addPyFile(share_file(spark, f"linkloom-{uuid.uuid4().hex}.zip", data.getvalue()))
    _shipped.add(sc.applicationId)


def shipped(df: DataFrame) -> DataFrame:
    """``df``, once the workers have this package: for a function that they are to run over it."""
    ship_package(df.sparkSession)
    return df


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """For functions over Arrow batches: a worker lives on after its task, so at the end
    of a task it returns the memory that it has freed to the system."""

    @functools.wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, if it has it
            if trim is not None:
                trim(0)

    return tidied


def release_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a finished job once its driver has collected
    the job's objects; asking for that between the jobs of one operator bounds the disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def attach(left: DataFrame, right: DataFrame, keys: list[str], rows: str, total: int, spread: list[str | Column]) -> DataFrame:
    """Left join of ``left`` with ``right`` (one row per ``keys``) that stays even
    when a key holds a large share of ``left``.

    ``rows`` is the column of ``right`` that counts the key's rows in ``left`` and
    ``total`` the rows of ``left``. Keys with at least ``total / HOT_SLICES`` rows
    are at most ``HOT_SLICES`` many by construction, so they are broadcast. All
    other keys join by shuffle. Rows already served by the broadcast, and rows
    with a null key, have no partner in that shuffle and are spread over it by a
    hash of ``spread``. The values of ``right`` come as one struct ``_found``
    (null when there is none)."""
    values = F.struct(*[c for c in right.columns if c not in keys])
    hot = F.col(rows) * F.lit(HOT_SLICES) >= F.lit(total)
    head = right.where(hot).select(*keys, values.alias("_head"))
    tail = right.where(~hot).select(*keys, values.alias("_tail"), F.lit(0).cast("long").alias("_spread"))
    no_key = F.greatest(F.lit(False), *[F.col(k).isNull() for k in keys])
    served = F.col("_head").isNotNull() | no_key
    joined = left.join(F.broadcast(head), keys, "left").withColumn(
        "_spread", F.when(served, F.pmod(F.xxhash64(*spread), F.lit(HOT_SLICES)) + 1).otherwise(F.lit(0)).cast("long")
    )
    joined = joined.join(tail, [*keys, "_spread"], "left")
    return joined.select(*left.columns, F.coalesce("_head", "_tail").alias("_found"))
