"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings the plans rely on: AQE re-plans joins from run-time sizes (a small
# base is broadcast only when its measured size is under the threshold), splits
# skewed join partitions and coalesces small shuffle partitions.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # JSON objects with a repeated key keep the last value (as Python's parser does)
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "linkloom") -> SparkSession:
    """A local session for tests and benchmarks (no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LINKLOOM_DRIVER_MEMORY", "8g"))
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local session may do without: driver and executors are one process
    there, so a scratch folder is set. Anywhere else a missing setting is an error,
    because executors could not see each other's files."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="linkloom-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_scope: ContextVar[list[str] | None] = ContextVar("linkloom_scratch", default=None)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder. Inside ``scratch_scope`` the
    scope owns the folder, otherwise nobody does and it stays."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/linkloom-{name}-{uuid.uuid4().hex}"
    owned = _scope.get()
    if owned is not None:
        owned.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch_paths() -> Iterator[list[str]]:
    """The intermediate folders written inside the block, as a list: whoever asked deletes
    them when nothing reads them any more."""
    owned: list[str] = []
    token = _scope.set(owned)
    try:
        yield owned
    finally:
        _scope.reset(token)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, all intermediate folders that the library has written inside it
    (class splits, stages of the corpus operators): build a result and write it in one scope.
    DataFrames that leave the scope unwritten can no longer be read. Scopes nest; an inner
    one deletes what is its own."""
    owned: list[str] = []
    try:
        with scratch_paths() as owned:
            yield
    finally:
        for path in owned:
            delete_path(spark, path)
