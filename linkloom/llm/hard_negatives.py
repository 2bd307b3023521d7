"""Hard-negative mining with Four-Russians scoring: exact inner products from subset-sum tables.

Vectors are quantised to whole numbers. Of a candidate only bits are kept: plane b has bit
b of every component, in two's complement, eight dimensions to a byte. For each group of
eight dimensions an anchor has a table with the sums of all 256 subsets of its components
there. The sum of one plane then is one lookup per byte, the score the planes' sums,
shifted and added; the highest plane counts negative. Scores are exact.

Candidates are packed into *blocks* of rows, blocks are dealt to *slabs* of bounded size,
anchors come in groups of bounded size. One Spark task at a time works on one group and one
slab, block by block, and keeps a few rows per anchor; so both passes - the best positives,
then the negatives in the windows that these set - return little, and a lost task repeats
one group and one slab.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_package, stage, tidy

#: Candidates in a block, blocks in a slab, anchors in a group.
BLOCK_ROWS = 8192
SLAB_BLOCKS = 64
GROUP_ANCHORS = 256
#: Stands for a null id, which comes last among equal scores.
NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Mining:
    positives: int = 5
    negatives: int = 10
    low_percent: int = 30  # of the positive's score
    high_percent: int = 90
    scale: int = 256


def quantised(vectors: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of list values, as rows of whole numbers; short rows end in zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    x = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(x) and np.abs(x).max() >= 2.0**52:
        raise ValueError("a component is too large to be scored exactly")
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = x.astype(np.int64)
    return out


def bits_of(q: np.ndarray) -> int:
    """Bits that hold all of ``q`` in two's complement."""
    return 1 + max(int(q.max(initial=0)).bit_length(), int(-(q.min(initial=0) + 1)).bit_length() if q.size and q.min() < 0 else 0)


def planes_of(q: np.ndarray, bits: int) -> np.ndarray:
    """(plane, group of eight dimensions, row): the bits of ``q``, eight dimensions to a byte."""
    n, dims = q.shape
    groups = max(1, -(-dims // 8))
    wide = np.zeros((n, 8 * groups), np.int64)
    wide[:, :dims] = q
    return np.stack([np.packbits((wide >> b & 1).astype(np.uint8), axis=1, bitorder="little").T for b in range(bits)])


def subset_sums(q: np.ndarray, groups: int) -> np.ndarray:
    """For each anchor the sums of all subsets of each eight components: (anchor, 256 * group + subset)."""
    out = np.zeros((len(q), groups, 256), np.int64)
    wide = np.zeros((len(q), 8 * groups), np.int64)
    dims = min(q.shape[1], 8 * groups)
    wide[:, :dims] = q[:, :dims]
    for d in range(8 * groups):
        g, j = divmod(d, 8)
        out[:, g, 1 << j : 2 << j] = out[:, g, : 1 << j] + wide[:, d, None]
    return out.reshape(len(q), -1)


class Block:
    """Packed candidates in a worker."""

    def __init__(self, data: bytes):
        n, bits, groups = np.frombuffer(data, "<i8", 3)
        self.ids, self.labels, self.digests = np.frombuffer(data, "<i8", 3 * n, 24).reshape(3, n)
        planes = np.frombuffer(data, np.uint8, bits * groups * n, 24 + 24 * n).reshape(bits, groups, n)
        self.groups = int(groups)
        self.at = planes.astype(np.intp) + 256 * np.arange(groups)[:, None]  # places in an anchor's tables

    @staticmethod
    def pack(ids: np.ndarray, labels: np.ndarray, digests: np.ndarray, q: np.ndarray) -> bytes:
        planes = planes_of(q, bits_of(q))
        head = np.array([len(ids), planes.shape[0], planes.shape[1]], "<i8")
        return head.tobytes() + np.array([ids, labels, digests], "<i8").tobytes() + planes.tobytes()

    def scores(self, table: np.ndarray) -> np.ndarray:
        """The exact inner products with one anchor, from its subset sums."""
        total = -table.take(self.at[-1]).sum(axis=0)
        for plane in self.at[-2::-1]:
            total = 2 * total + table.take(plane).sum(axis=0)
        return total


class Anchors:
    """A group of anchors in a worker."""

    def __init__(self, data: bytes):
        n, dims = np.frombuffer(data, "<i8", 2)
        self.ids, self.labels, self.digests = np.frombuffer(data, "<i8", 3 * n, 16).reshape(3, n)
        self.q = np.frombuffer(data, "<i8", n * dims, 16 + 24 * n).reshape(n, dims)
        self._tables: dict[int, np.ndarray] = {}

    @staticmethod
    def pack(ids: np.ndarray, labels: np.ndarray, digests: np.ndarray, q: np.ndarray) -> bytes:
        return np.array(q.shape, "<i8").tobytes() + np.array([ids, labels, digests], "<i8").tobytes() + q.astype("<i8").tobytes()

    def table(self, i: int, groups: int) -> np.ndarray:
        if groups not in self._tables:
            self._tables = {groups: subset_sums(self.q, groups)}
        return self._tables[groups][i]


class Best:
    """The first ``n`` of the rows seen: higher scores first, then smaller ids; equal rows count once."""

    def __init__(self, n: int):
        self.n, self.rows = n, np.zeros((3, 0), np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray, digests: np.ndarray) -> None:
        if self.rows.shape[1] == self.n:  # all others come too late
            ok = scores >= self.rows[0, -1]
            scores, ids, digests = scores[ok], ids[ok], digests[ok]
        if len(scores):
            rows = np.concatenate((self.rows, np.stack((scores, ids, digests))), axis=1)
            rows = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))]
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
            self.rows = rows[:, new][:, : self.n]


def _valid(rows: DataFrame, vec_id: str, label: str, vector: str, anchors: Column) -> DataFrame:
    """(id, label, digest, vector, anchor) of the rows that take part."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    found = rows.where(F.coalesce(finite, F.lit(False)) & F.col(label).isNotNull())
    found = found.select(
        F.coalesce(F.col(vec_id).cast("long"), F.lit(NO_ID)).alias("id"), F.col(label).cast("long").alias("label"),
        values.alias("vector"), F.coalesce(anchors & F.col(vec_id).isNotNull(), F.lit(False)).alias("anchor"),
    )
    return found.withColumn("digest", F.xxhash64("id", "label", "vector"))


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _candidate_blocks(valid: DataFrame, scale: int) -> DataFrame:
    """``block, bits, dims, data``."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(at, BLOCK_ROWS)
                q = quantised(some.column("vector"), scale)
                data = Block.pack(*(_numbers(some, c) for c in ("id", "label", "digest")), q)
                columns = [pa.array([bits_of(q)], pa.int32()), pa.array([q.shape[1]], pa.int32()), pa.array([data], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["bits", "dims", "data"])

    rows = valid.select("id", "label", "digest", "vector")
    return stage(rows.mapInArrow(run, "bits int, dims int, data binary").withColumn("block", F.monotonically_increasing_id()), "vectors")


def _anchor_groups(valid: DataFrame, scale: int) -> tuple[DataFrame, int]:
    """``ag`` (0 .. groups - 1), ``bits, data``; equal anchors are one."""
    chosen = stage(valid.where("anchor").dropDuplicates(["id", "label", "digest"]).select("id", "label", "digest", "vector"), "anchors")
    groups = max(1, -(-chosen.count() // GROUP_ANCHORS))
    dealt = chosen.withColumn("ag", F.pmod("digest", F.lit(groups)).cast("int")).repartition("ag").sortWithinPartitions("ag", "id", "digest")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def packed() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            q = quantised(whole.column("vector"), scale)
            data = Anchors.pack(*(_numbers(whole, c) for c in ("id", "label", "digest")), q)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([bits_of(q)], pa.int32()), pa.array([data], pa.binary())], ["ag", "bits", "data"])

        for batch in batches:
            for ag in np.unique(_numbers(batch, "ag")).tolist():
                if ag != now and held:
                    yield packed()
                    held = []
                now = ag
                held.append(batch.filter(pa.array(_numbers(batch, "ag") == ag)))
        if held:
            yield packed()

    return stage(dealt.mapInArrow(run, "ag int, bits int, data binary"), "anchor-groups"), groups


def _meetings(blocks: DataFrame, anchors: DataFrame, groups: int, slabs: int) -> DataFrame:
    """Rows (ag, slab, kind, data, windows), in order: a group of anchors with the windows
    asked for (kind 0), then the blocks of a slab (kind 1). Each block goes to each group of
    the stated anchors."""
    slab = F.pmod(F.xxhash64("block"), F.lit(slabs)).cast("int")
    each = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("ag"), slab.alias("slab"), F.lit(1).alias("kind"), "data", F.lit(None).cast(_WINDOWS).alias("windows"))
    first = anchors.select("ag", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))).alias("slab"), F.lit(0).alias("kind"), "data", "windows")
    return each.unionByName(first).repartition("ag", "slab").sortWithinPartitions("ag", "slab", "kind")


_WINDOWS = "array<struct<anchor:int,number:int,least:bigint,most:bigint>>"
_FOUND = "ag int, anchor int, number int, anchor_id long, score long, id long, digest long"


def _found_batch(ag: int, anchors: Anchors, best: dict[tuple[int, int], Best]) -> pa.RecordBatch:
    keys = [(i, k, b.rows) for (i, k), b in best.items() if b.rows.shape[1]]
    many = [rows.shape[1] for _, _, rows in keys]
    at = np.repeat(np.array([i for i, _, _ in keys], np.int64), many)
    columns = [np.full(len(at), ag), at, np.repeat(np.array([k for _, k, _ in keys], np.int64), many), anchors.ids[at]]
    columns += list(np.concatenate([rows for _, _, rows in keys] or [np.zeros((3, 0), np.int64)], axis=1))
    kinds = [pa.int32()] * 3 + [pa.int64()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["ag", "anchor", "number", "anchor_id", "score", "id", "digest"])


def _scan(meetings: DataFrame, mining: Mining, negatives: bool) -> DataFrame:
    """The best rows of each group and slab: positives of each anchor, or negatives in each of its windows."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, anchors, windows, best = None, None, {}, {}
        for batch in batches:
            for r in range(batch.num_rows):
                ag, slab, kind, data = (batch.column(c)[r].as_py() for c in ("ag", "slab", "kind", "data"))
                if (ag, slab) != now:
                    if best:
                        yield _found_batch(now[0], anchors, best)
                    now, anchors, best = (ag, slab), None, {}
                if kind == 0:
                    anchors, windows = Anchors(data), {}
                    for w in batch.column("windows")[r].as_py() or []:
                        windows.setdefault(w["anchor"], []).append((w["number"], w["least"], w["most"]))
                elif anchors is not None:
                    block = Block(data)
                    for i in windows if negatives else range(len(anchors.ids)):
                        scores = block.scores(anchors.table(i, block.groups))
                        if negatives:
                            other = block.labels != anchors.labels[i]
                            for number, least, most in windows[i]:
                                ok = np.flatnonzero(other & (scores >= least) & (scores <= most))
                                best.setdefault((i, number), Best(mining.negatives)).add(scores[ok], block.ids[ok], block.digests[ok])
                        else:
                            same = (block.labels == anchors.labels[i]) & ~((block.ids == anchors.ids[i]) & (block.digests == anchors.digests[i]))
                            ok = np.flatnonzero(same)
                            best.setdefault((i, 0), Best(mining.positives)).add(scores[ok], block.ids[ok], block.digests[ok])
        if best:
            yield _found_batch(now[0], anchors, best)

    return meetings.mapInArrow(run, _FOUND)


def _floor_percent(x: Column, percent: int) -> Column:
    """floor(x * percent / 100) in whole numbers."""
    return F.call_function("div", x * percent - F.pmod(x * percent, F.lit(100)), F.lit(100))


def _first(found: DataFrame, n: int) -> DataFrame:
    """Of the slabs' best rows the first ``n`` of each anchor and number, with their ``rank``."""
    up = Window.partitionBy("ag", "anchor", "number").orderBy(F.desc("score"), "id", "digest")
    return found.distinct().withColumn("rank", F.row_number().over(up)).where(F.col("rank") <= n)


def mine(
    rows: DataFrame, anchors: Column, mining: Mining = Mining(), vec_id: str = "vec_id", label: str = "label", vector: str = "embedding"
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each
    row that ``anchors`` chooses and each of its positives (the first rows of its label, itself
    left out), the first rows of other labels whose scores lie in the positive's window.

    A score is the inner product of the rows' components floor(scale * x); higher ones come
    first, ties by smaller id, rows without an id last. Rows with a null label, a null vector
    or a component that is null or not finite take no part; a row without an id is no anchor.
    Rows equal in id, label and vector count once; rows of one id that differ are rows each,
    and so are anchors. Of vectors of different lengths the shorter ends in zeros; an empty
    vector scores 0. Scores that could pass 63 bits are an error. Other columns are not read
    (but by ``anchors``), an empty table gives an empty result."""
    ship_package(rows.sparkSession)
    valid = _valid(rows, vec_id, label, vector, anchors)
    blocks = _candidate_blocks(valid, mining.scale)
    groups, many = _anchor_groups(valid, mining.scale)
    size = blocks.agg(F.count(F.lit(1)).alias("n"), F.max("bits").alias("bits"), F.max("dims").alias("dims")).first()
    wide = groups.agg(F.max("bits").alias("bits")).first()["bits"]
    if size["n"] and wide and size["bits"] + wide + int(size["dims"]).bit_length() > 62:
        raise ValueError("scores may pass 63 bits")
    slabs = max(1, -(-size["n"] // SLAB_BLOCKS))
    bare = groups.select("ag", "data", F.lit(None).cast(_WINDOWS).alias("windows"))
    positives = _first(_scan(_meetings(blocks, bare, many, slabs), mining, negatives=False), mining.positives)
    positives = stage(positives.select("ag", "anchor", F.col("rank").alias("number"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    p = F.col("positive_score")
    least, most = -_floor_percent(-p, mining.low_percent), _floor_percent(p, mining.high_percent)
    asked = positives.where(least <= most).groupBy("ag").agg(F.collect_list(F.struct("anchor", "number", least.alias("least"), most.alias("most"))).alias("windows"))
    windows = groups.select("ag", "data").join(asked, "ag")  # windows of one group of anchors
    found = _first(_scan(_meetings(blocks, windows, many, slabs), mining, negatives=True), mining.negatives)
    named = found.drop("anchor_id").join(positives, ["ag", "anchor", "number"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
    known = [F.when(F.col(c) != NO_ID, F.col(c)).alias(c) if c in ("positive_id", "negative_id") else F.col(c) for c in named.columns]
    return stage(named.select(*known), "hard-negatives")
