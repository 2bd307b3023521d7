"""Parquet folders that are hash-partitioned on disk.

A folder written by ``write_bucketed`` has its rows in ``buckets`` files by the hash of one
column, each sorted by it. Read through ``bucketed_reader``, which declares that to Spark,
its side of an equi-join on the column needs no shuffle. The declaration is a catalogue
entry that lasts as long as the reader's ``with`` block; the folder is not owned by it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def _name() -> str:
    return f"linkloom_{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, path: str, column: str, buckets: int) -> None:
    name = _name()
    try:
        df.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, column).sortBy(column).saveAsTable(name)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: the files stay


@contextmanager
def bucketed_reader(spark: SparkSession, column: str) -> Iterator[Callable[[str, str, int], DataFrame]]:
    """Gives ``read(path, schema, buckets)``; its DataFrames are valid inside the block only."""
    names: list[str] = []

    def read(path: str, schema: str, buckets: int) -> DataFrame:
        name = _name()
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({column}) SORTED BY ({column}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        names.append(name)
        return spark.table(name)

    try:
        yield read
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
