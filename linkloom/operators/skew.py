"""Equi-joins that stay balanced when one key holds a large share of rows.

``salted_join(left, right, keys)`` is an exact inner join for a ``right`` side
with one row per key (a base document per uri), or one made so by
``right_reduce`` inside the join's own shuffle. A key that ``left`` names more than
``threshold`` times is *hot*:

* hot keys come from a top-k sketch of the keys' hashes, one partial aggregate of fixed
  size that needs no shuffle of the rows or of the distinct keys. It lists at most
  ``TOP`` hashes, so its broadcast has a bound. The sketch overstates a count by less
  than 3.5 / ``tracked`` of all rows (0.02 % by default): a key that small may be taken for
  hot or not, which changes the balance only, never the result. What skew a key under the
  threshold or under that share makes is left to adaptive execution, which splits it;
* a hot key's ``left`` rows are spread over ``ceil(count / threshold)`` salt
  values by a hash of ``spread`` (deterministic, so recomputed tasks agree), and
  its single ``right`` row is replicated once per salt value: no salt value gets
  much more than ``threshold`` rows, whatever the key;
* every other key joins with salt 0, exactly as a plain join would.

A ``right`` side that Spark will broadcast by its own size estimate needs none of this and
is joined as it is.

So the rows of ``left`` are shuffled once, on key and salt, and never on the bare key. The
sketch reads ``left`` a second time: callers give it partitioned (``repartition``), so that
the second read is one of a shuffle that is there anyway.

Settings (session configuration, read at plan time):
``linkloom.skew.enabled`` (default true), ``linkloom.skew.hotKeyThreshold``
(default 100000 rows) and ``linkloom.skew.trackedKeys`` (default 16384).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hot keys at most.
TOP = 4096


@dataclass(frozen=True)
class SkewSettings:
    enabled: bool = True
    threshold: int = 100_000
    tracked: int = 16_384

    @classmethod
    def of(cls, spark: SparkSession) -> SkewSettings:
        get = spark.conf.get
        return cls(
            enabled=get("linkloom.skew.enabled", "true").lower() == "true",
            threshold=max(1, int(get("linkloom.skew.hotKeyThreshold", str(cls.threshold)))),
            tracked=max(TOP, int(get("linkloom.skew.trackedKeys", str(cls.tracked)))),
        )


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of ``df``, from file sizes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own estimate of ``df``, from file sizes, is under its broadcast
    threshold. A join with it is planned as a broadcast then, so no task holds a key's rows
    together and there is nothing to salt."""
    session = df.sparkSession._jsparkSession
    return estimated_bytes(df) <= session.sessionState().conf().autoBroadcastJoinThreshold()


def hot_hashes(left: DataFrame, keys: Sequence[str], settings: SkewSettings) -> DataFrame:
    """``_hash, _buckets`` of the keys named more than ``threshold`` times (at most ``TOP``):
    the hash of the key and the number of salt values that its rows need."""
    hashes = left.select(F.xxhash64(*keys).alias("_hash"))
    top = hashes.agg(F.call_function("approx_top_k", F.col("_hash"), F.lit(TOP), F.lit(settings.tracked)).alias("top"))
    found = top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("_hash"), F.col("t.count").alias("_n"))
    return found.where(F.col("_n") > settings.threshold).select("_hash", F.ceil(F.col("_n") / settings.threshold).cast("int").alias("_buckets"))


def hot_keys(left: DataFrame, keys: Sequence[str], threshold: int) -> DataFrame:
    """The hot keys themselves with ``_buckets``, by an exact count of the sketch's candidates
    only: to see what a join would salt."""
    candidates = hot_hashes(left, keys, SkewSettings(threshold=threshold)).select("_hash")
    named = left.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(candidates), "_hash", "left_semi")
    counts = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > threshold)
    return counts.select(*keys, F.ceil(F.col("_n") / threshold).cast("int").alias("_buckets"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread: str,
    settings: SkewSettings | None = None,
    right_reduce: Callable[[DataFrame, list[str]], DataFrame] | None = None,
) -> DataFrame:
    """Exact inner join of ``left`` with ``right`` on ``keys`` (see the module docstring).
    ``right_reduce(df, group_keys)``, if given, makes ``right`` one row per key: it runs after
    the hot rows are replicated, grouped on ``keys + _salt``, so its shuffle is the one that
    the join needs."""
    keys = list(keys)
    settings = settings or SkewSettings.of(left.sparkSession)
    plain = right if right_reduce is None else right_reduce(right, keys)
    if not settings.enabled or fits_broadcast(plain):
        return left.join(plain, keys)
    hot = F.broadcast(hot_hashes(left, keys, settings))  # at most TOP rows of two numbers

    def with_buckets(side: DataFrame) -> DataFrame:
        return side.withColumn("_hash", F.xxhash64(*keys)).join(hot, "_hash", "left")

    salted_left = with_buckets(left).select(
        *left.columns, F.coalesce(F.pmod(F.xxhash64(F.col(spread)), F.col("_buckets")), F.lit(0)).cast("int").alias("_salt")
    )
    replicated_right = with_buckets(right).select(
        *right.columns, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_buckets"), F.lit(1)) - 1)).alias("_salt")
    )
    if right_reduce is not None:
        replicated_right = right_reduce(replicated_right, [*keys, "_salt"])
    return salted_left.join(replicated_right, [*keys, "_salt"]).drop("_salt")
