"""Sharding: a Feistel permutation with cycle walking over global row numbers.

Rows get gapless row numbers ``0 .. n-1`` from their own values only (never from
how they happen to be partitioned), a keyed permutation of that range shuffles
them, and shard and slot are the remainder and quotient of the permuted number.
Shard sizes differ by at most one row, slots are gapless, the same table always
gives the same layout, and ``locate`` computes the place of a row number (and
``row_at`` the row number of a place) without any data.

DataFrame functions only. Texts are never shuffled: only the narrow columns that
order the rows are.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

ROUNDS = 6
#: Steps that the cycle walk is given; see ``permuted``.
WALK = 64
#: Copies of one row are laid out in runs of this many, so that no array grows with them.
RUN = 65_536


def _sides(n: int) -> tuple[int, int]:
    """Sides (a, b) of the smallest near-square grid with a * b >= n; a * b - n < a."""
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, -(-n // a) if n else 1


def _noise(seed: int, number: Column, value: Column) -> Column:
    """The round function: 60 bits of an MD5 of seed, round and half."""
    text = F.concat_ws(":", F.lit(str(seed)), number.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _feistel(x: Column, n: int, seed: int) -> Column:
    """One pass of the network over the grid a x b: even rounds move the left half
    modulo a, odd rounds the right half modulo b; each round can be undone."""
    a, b = _sides(n)

    def one(acc: Column, k: Column) -> Column:
        left, right = acc["l"], acc["r"]
        return F.when(
            k % 2 == 0, F.struct(F.pmod(left + _noise(seed, k, right), F.lit(a)).alias("l"), right.alias("r"))
        ).otherwise(F.struct(left.alias("l"), F.pmod(right + _noise(seed, k, left), F.lit(b)).alias("r")))

    start = F.struct(((x - F.pmod(x, F.lit(b))) / F.lit(b)).cast("long").alias("l"), F.pmod(x, F.lit(b)).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one, lambda s: s["l"] * F.lit(b) + s["r"])


def permuted(x: Column, n: int, seed: int) -> Column:
    """The permutation of ``0 .. n-1`` at ``x``: the network is repeated until its
    value falls under ``n`` (cycle walking). Fewer than sqrt(n) points of the grid
    lie outside, so up to n = 4096 no walk exceeds ``WALK`` steps, and beyond that
    64 steps outside in a row have a chance under 64 ** -64; should it happen the
    job fails instead of returning a wrong place."""
    limit = F.lit(n)

    def step(acc: Column, k: Column) -> Column:
        return F.when((k > 0) & (acc < limit), acc).otherwise(_feistel(acc, n, seed))

    walked = F.aggregate(F.sequence(F.lit(0), F.lit(WALK)), x.cast("long"), step)
    return F.when(walked < limit, walked).otherwise(F.raise_error(F.lit("the cycle walk did not end")).cast("long"))


def locate(row_no: int, n: int, shards: int, seed: int) -> tuple[int, int]:
    """(shard, slot) of a row number, computed without data."""
    a, b = _sides(n)
    x = row_no
    while True:
        left, right = divmod(x, b)
        for k in range(ROUNDS):
            noise = _noise_of(seed, k, right if k % 2 == 0 else left)
            left, right = ((left + noise) % a, right) if k % 2 == 0 else (left, (right + noise) % b)
        x = left * b + right
        if x < n:
            return x % shards, x // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """The row number at a place: the inverse of ``locate``."""
    a, b = _sides(n)
    x = slot * shards + shard
    while True:
        left, right = divmod(x, b)
        for k in reversed(range(ROUNDS)):
            noise = _noise_of(seed, k, right if k % 2 == 0 else left)
            left, right = ((left - noise) % a, right) if k % 2 == 0 else (left, (right - noise) % b)
        x = left * b + right
        if x < n:
            return x


def _noise_of(seed: int, k: int, value: int) -> int:
    return int(hashlib.md5(f"{seed}:{k}:{value}".encode()).hexdigest()[:15], 16)


def number_rows(df: DataFrame, cols: list[str]) -> tuple[DataFrame, int]:
    """``cols`` of every row with its global ``row_no`` (gapless from 0), and the
    number of rows.

    Rows are ordered by a hash bucket of ``cols`` and then by ``cols`` (nulls
    first). Equal rows are counted before any shuffle and take consecutive
    numbers, so a row repeated any number of times is one row of the shuffle.
    About sqrt(n) / 4 buckets of about 4 sqrt(n) rows are used: the one ordered
    pass over all buckets sees sqrt(n) / 4 rows."""
    groups = stage(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies")), "row-groups")
    n = groups.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, math.isqrt(n) // 4)
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    bucket = F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(buckets))
    groups = groups.withColumn("_bucket", bucket)
    sizes = groups.groupBy("_bucket").agg(F.sum("_copies").alias("_rows"))
    starts = sizes.select("_bucket", (F.sum("_rows").over(Window.orderBy("_bucket")) - F.col("_rows")).alias("_start"))
    inside = Window.partitionBy("_bucket").orderBy(*[F.asc_nulls_first(c) for c in cols]).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        groups.withColumn("_first", F.sum("_copies").over(inside) - F.col("_copies"))
        .join(F.broadcast(starts), "_bucket")  # sqrt(n) / 4 rows
        .withColumn("_first", F.col("_first") + F.col("_start"))
    )
    runs = placed.select(*cols, "_first", "_copies", F.explode(F.sequence(F.lit(0), ((F.col("_copies") - 1) / RUN).cast("long"))).alias("_run"))
    begin = F.col("_first") + F.col("_run") * RUN
    end = F.least(begin + RUN, F.col("_first") + F.col("_copies")) - 1
    return runs.hint("rebalance").select(*cols, F.explode(F.sequence(begin, end)).alias("row_no")), n


def shard_rows(df: DataFrame, cols: list[str], shards: int, seed: int = 20_240_601) -> DataFrame:
    """``cols`` of every row of ``df`` with ``row_no``, ``shard`` (int) and ``slot`` (long).

    ``cols`` name the values that tell rows apart (an id, a checksum, ...); other
    columns, whatever their names, are not read. Null values are values like any
    other; equal rows share their numbers in any order, which changes nothing. An
    empty table gives an empty result."""
    if shards < 1:
        raise ValueError("shards must be positive")
    rows, n = number_rows(df.select(*cols), cols)
    place = rows.withColumn("_place", permuted(F.col("row_no"), n, seed))
    return place.select(
        *cols,
        "row_no",
        F.pmod("_place", F.lit(shards)).cast("int").alias("shard"),
        ((F.col("_place") - F.pmod("_place", F.lit(shards))) / shards).cast("long").alias("slot"),
    )
