"""Emitting only new or changed documents against a stored fingerprint state.

State rows are ``(uri_hex, hash)``, one per key: the lower-case hex of the key's
UTF-8 bytes and the upper-case SHA-1 of the document's canonical JSON. A document
is in the increment when its key is absent from the state or its hash differs.
Keys missing from the new frames stay in the state and are never reported.
Documents that share a key count as one (``one_per_uri``); a document without a
key is an error.

``increment_plan`` is the pure DataFrame plan. ``compute_frames_increment`` runs it
against a state folder, which any number of writers may share (``state_log``):

* ``version=N`` holds what round N found: the new and changed rows with their
  documents (an upsert - the rest of the state is not rewritten);
* ``snapshot=N`` is the whole state after round N, ``delta=N`` the latest row of each key
  that has changed since the snapshot. The state is these two folders, both bucketed by key:
  a round shuffles the frames to the buckets and joins them there; the state is not shuffled.
  Each round writes a new delta; every ``COMPACT_EVERY`` rounds it is folded into a
  snapshot instead, with more buckets where the state has outgrown them;
* a round that another one has overtaken is run again on the state which that one left;
* when a snapshot is written, rounds older than ``RETAIN_ROUNDS`` are deleted. Until then a
  replayed batch gets its stored increment and nobody else's (the record names the
  caller's run and batch); a batch replayed later is a round of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import fingerprint, key_hex, key_unhex
from ..operators.keys import one_per_uri
from .buckets import bucketed_reader, write_bucketed
from .state_log import StateLog

STATE_SCHEMA = "uri_hex string, hash string"
ROUND_SCHEMA = "uri_hex string, hash string, doc variant"
COMPACT_EVERY = 16
#: Rounds that stay readable and replayable.
RETAIN_ROUNDS = 64
#: A snapshot gets twice the buckets as long as one would hold more rows.
BUCKET_ROWS = 4_000_000


def hashed_frames(frames: DataFrame, unique_uris: bool = False) -> DataFrame:
    """``(uri_hex, hash, doc)``, one row per key."""
    key = F.coalesce("uri", F.raise_error(F.lit("frame without a key")).cast("string"))
    keyed = frames.select(key.alias("uri"), "doc")
    keyed = keyed if unique_uris else one_per_uri(keyed)
    return keyed.select(key_hex(F.col("uri")).alias("uri_hex"), fingerprint(F.col("doc")).alias("hash"), "doc")


def _found(frames: DataFrame, state: DataFrame, unique_uris: bool) -> DataFrame:
    """``(uri_hex, hash, doc, status)`` of the new and changed documents."""
    hashed = hashed_frames(frames, unique_uris)
    old = state.groupBy("uri_hex").agg(F.max("hash").alias("old_hash"))  # one row per key, whoever wrote it
    joined = hashed.join(old, "uri_hex", "left")
    status = F.when(F.col("old_hash").isNull(), F.lit("new")).otherwise(F.lit("changed"))
    return joined.where(~F.col("hash").eqNullSafe(F.col("old_hash"))).select("uri_hex", "hash", "doc", status.alias("status"))


def _upserted(state: DataFrame, found: DataFrame) -> DataFrame:
    kept = state.select("uri_hex", "hash").join(found.select("uri_hex"), "uri_hex", "left_anti")
    return kept.groupBy("uri_hex").agg(F.max("hash").alias("hash")).unionByName(found.select("uri_hex", "hash"))


def increment_plan(frames: DataFrame, state: DataFrame, unique_uris: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(increment (uri, doc, status), new_state (uri_hex, hash))``."""
    found = _found(frames, state, unique_uris)
    increment = found.select(key_unhex(F.col("uri_hex")).alias("uri"), "doc", "status")
    return increment, _upserted(state, found)


def _overlaid(under: DataFrame | None, over: DataFrame) -> DataFrame:
    """The rows of ``over``, and those of ``under`` whose keys it lacks."""
    if under is None:
        return over.select("uri_hex", "hash")
    under, over = under.select("uri_hex", F.col("hash").alias("_under")), over.select("uri_hex", F.col("hash").alias("_over"))
    return under.join(over, "uri_hex", "full").select("uri_hex", F.coalesce("_over", "_under").alias("hash"))


def _round_rows(log: StateLog, n: int) -> DataFrame:
    return log.spark.read.schema(ROUND_SCHEMA).parquet(f"{log.root}/version={n}")


def _increment(log: StateLog, n: int) -> DataFrame:
    return _round_rows(log, n).select(key_unhex(F.col("uri_hex")).alias("uri"), "doc")


def buckets_for(buckets: int, rows: int) -> int:
    while rows > buckets * BUCKET_ROWS:
        buckets *= 2
    return buckets


def changed_frames(hashed: DataFrame, state: list[DataFrame], buckets: int) -> DataFrame:
    """The rows of ``hashed`` that differ from the state. ``state`` holds tables in ``buckets``
    buckets by key, later ones above earlier ones; only the frames are shuffled."""
    joined, olds = hashed.repartition(buckets, "uri_hex"), []
    for i, part in enumerate(state):
        olds.insert(0, F.col(f"_old{i}"))
        joined = joined.join(part.select("uri_hex", F.col("hash").alias(f"_old{i}")).hint("merge"), "uri_hex", "left")
    old = F.coalesce(*olds) if olds else F.lit(None).cast("string")
    return joined.where(~F.col("hash").eqNullSafe(old)).select("uri_hex", "hash", "doc")


@dataclass
class PendingRound:
    """A round that has written what it found and is not committed yet."""

    log: StateLog
    number: int
    after: dict | None
    record: dict

    def commit(self) -> DataFrame | None:
        """The increment, or None if another round has been committed meanwhile; what this
        one wrote is deleted then."""
        if self.log.commit(self.number, self.after, self.record):
            if self.record["since_snapshot"] == 0:
                self.log.retire(self.number - RETAIN_ROUNDS)
            return _increment(self.log, self.number)
        for kind in ("version", "delta", "snapshot"):
            self.log.delete(f"{kind}={self.number}")
        return None


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """The retained rounds under ``root`` that were finished."""
    return StateLog(spark, root).commits()


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """The state ``(uri_hex, hash)`` after the last finished round, one row per key."""
    head = StateLog(spark, root).head()
    folders = [f"{root.rstrip('/')}/{head[kind]}" for kind in ("snapshot", "delta") if head[kind]] if head else []
    parts = [spark.read.schema(STATE_SCHEMA).parquet(f) for f in folders]
    if not parts:
        return spark.createDataFrame([], STATE_SCHEMA)
    return parts[0] if len(parts) == 1 else _overlaid(*parts)


def begin_increment(
    spark: SparkSession,
    frames: DataFrame,
    state_root: str,
    num_partitions: int | None = None,
    run_id: str | None = None,
    batch_id: int | None = None,
    unique_uris: bool = False,
) -> PendingRound | DataFrame:
    """The first half of a round: compares ``frames`` with the last state and writes what is new
    or changed. Returns the round, which is to be committed - or, if this batch of this run
    is committed already, its stored increment."""
    log = StateLog(spark, state_root)
    head = log.head()
    last = head or {"round": 0, "snapshot": None, "delta": None, "since_snapshot": 0, "rows": 0, "runs": []}
    if run_id is not None:
        for run, batch, n in last["runs"]:
            if (run, batch) == (run_id, batch_id):
                return _increment(log, n)
    buckets = last["buckets"] if head else max(1, num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = log.claim({"run": run_id, "batch": batch_id})
    record = {"round": n, "run": run_id, "batch": batch_id, "rows": last["rows"], "since_snapshot": last["since_snapshot"] + 1}
    record["runs"] = [r for r in last["runs"] if r[2] >= n - RETAIN_ROUNDS] + ([[run_id, batch_id, n]] if run_id is not None else [])
    with bucketed_reader(spark, "uri_hex") as read:
        snapshot, delta = (read(f"{log.root}/{last[k]}", STATE_SCHEMA, buckets) if last[k] else None for k in ("snapshot", "delta"))
        found = changed_frames(hashed_frames(frames, unique_uris), [s for s in (snapshot, delta) if s is not None], buckets)
        found.write.mode("overwrite").parquet(f"{log.root}/version={n}")
        fresh = _round_rows(log, n).select("uri_hex", "hash").repartition(buckets, "uri_hex")
        if record["since_snapshot"] >= COMPACT_EVERY:
            changed = spark.read.schema(STATE_SCHEMA).parquet(f"{log.root}/{last['delta']}").count() if last["delta"] else 0
            more = buckets_for(buckets, last["rows"] + changed + _round_rows(log, n).count())
            state = _overlaid(snapshot, _overlaid(delta, fresh))
            write_bucketed(state if more == buckets else state.repartition(more, "uri_hex"), f"{log.root}/snapshot={n}", "uri_hex", more)
            rows = spark.read.schema(STATE_SCHEMA).parquet(f"{log.root}/snapshot={n}").count()
            record |= {"snapshot": f"snapshot={n}", "delta": None, "since_snapshot": 0, "rows": rows, "buckets": more}
        else:
            write_bucketed(_overlaid(delta, fresh), f"{log.root}/delta={n}", "uri_hex", buckets)
            record |= {"snapshot": last["snapshot"], "delta": f"delta={n}", "buckets": buckets}
    return PendingRound(log, n, head, record)


def compute_frames_increment(
    spark: SparkSession,
    frames: DataFrame,
    state_root: str,
    num_partitions: int | None = None,
    run_id: str | None = None,
    batch_id: int | None = None,
    unique_uris: bool = False,
    attempts: int = 10,
) -> DataFrame:
    """Run one round against ``state_root`` (a shared, durable folder) and return the
    new or changed documents ``(uri, doc)``, read back from what was written.

    Rounds of several writers may overlap: one that another overtook is run again, up to
    ``attempts`` times. With ``run_id`` and ``batch_id`` the round can be replayed: if that
    batch of that run is committed, its stored increment is returned. Another run's batches
    never are. ``num_partitions`` is the number of buckets of a new state (by default the
    session's shuffle partitions)."""
    for _ in range(attempts):
        begun = begin_increment(spark, frames, state_root, num_partitions, run_id, batch_id, unique_uris)
        increment = begun.commit() if isinstance(begun, PendingRound) else begun
        if increment is not None:
            return increment
    raise RuntimeError(f"{state_root}: overtaken by other rounds {attempts} times")
