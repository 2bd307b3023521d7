"""MinHash near-dedup: b-bit signatures after band candidates.

Exact components of the documents whose sets of word shingles have a Jaccard similarity
of at least ``percent`` / 100, as far as bands and signatures let a pair through (below).

* Documents with equal sets are one *class*; from here on only classes are compared.
* Each class has ``bands * rows`` minima, each under a hash function of its own. The minima
  of a band together are a *bucket* key: classes that share a bucket are candidates.
* Of each minimum the low ``bits`` bits are kept, packed into one signature. Where two sets
  differ, the bits still agree with probability 2 ** -bits, so the share of agreeing
  minima, counted in the bits of two packed signatures, overstates the similarity; the
  estimate is corrected for that. Pairs under a limit that a true link misses once in
  10 ** 9 cases are dropped without a look at their sets.
* Links are confirmed on the full sets. First every bucket's members are compared with one
  member of it, its *hub*, another one for each bucket: a group of thousands of near
  copies becomes one component at linear cost. Buckets that still hold two components
  are cut into tiles of bounded size (pairs of slices, each tile a group of its own in
  the shuffle), where signatures leave few pairs of different components to compare.

A link of similarity s shares no bucket with probability (1 - s ** rows) ** bands: 2e-8 at
0.85 with 24 bands of 4, less for more similar pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, discard, stage, tidy
from .components import components
from .exchange import Block, make_blocks, with_answers
from .jaccard_join import Sets, linked

#: Rows and bytes of sets that one slice of a tile holds.
SLICE_ROWS = 256
SLICE_BYTES = 16_000_000
_U = np.uint64


@dataclass(frozen=True)
class MinHash:
    shingle: int = 5
    percent: int = 85
    bands: int = 24
    rows: int = 4
    bits: int = 4  # 1, 2, 4 or 8
    miss: float = 1e-9  # probability that signatures rule out a link

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    def similarity(self, agreeing: np.ndarray | float) -> np.ndarray | float:
        """The estimate from the number of agreeing low bits, without those that agree by chance."""
        chance = 2.0**-self.bits
        return (agreeing / self.minima - chance) / (1 - chance)

    def least_agreeing(self) -> int:
        """Agreeing minima that a link has, but for a share of ``miss``."""
        t, chance, k = self.percent / 100, 2.0**-self.bits, self.minima
        p, below = t + (1 - t) * chance, 0.0
        for n in range(k + 1):
            below += comb(k, n) * p**n * (1 - p) ** (k - n)
            if below > self.miss:
                return n
        return k


def minima(sets: Sets, seed: int, k: int) -> np.ndarray:
    """``k`` minima of each set that is not empty, one row a set."""
    full = np.flatnonzero(sets.sizes)
    out = np.empty((len(full), k), np.uint32)
    if not len(full):
        return out
    x = (sets.values >> _U(32)).astype(np.uint32)
    starts = (sets.ends - sets.sizes)[full]
    factors = np.random.default_rng(seed).integers(0, 1 << 32, (k, 2), np.uint32) | np.uint32(1)
    for i, (a, b) in enumerate(factors):
        h = x * a
        h ^= h >> np.uint32(16)
        h *= b
        out[:, i] = np.minimum.reduceat(h, starts)
    return out


def band_keys(least: np.ndarray, how: MinHash) -> np.ndarray:
    """A 64-bit bucket key for each band of each row of ``least``."""
    keys = np.zeros((len(least), how.bands), np.uint64)
    for band in range(how.bands):
        h = np.full(len(least), (band + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
        for i in range(band * how.rows, (band + 1) * how.rows):
            h ^= least[:, i].astype(np.uint64)
            h *= _U(0xD6E8FEB86659FD93)
            h ^= h >> _U(32)
        keys[:, band] = h
    return keys


def packed(least: np.ndarray, bits: int) -> np.ndarray:
    """The low bits of each row's minima, as whole 64-bit numbers."""
    low = (least[:, :, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    raw = np.packbits(low.reshape(len(least), -1).astype(np.uint8), axis=1, bitorder="little")
    wide = np.zeros((len(least), -(-raw.shape[1] // 8) * 8), np.uint8)
    wide[:, : raw.shape[1]] = raw
    return wide.view(np.uint64)


#: The lowest bit of each field of so many bits.
_FIELDS = {b: _U(((1 << 64) - 1) // ((1 << b) - 1)) for b in (1, 2, 4, 8)}


def agreeing(one: np.ndarray, many: np.ndarray, how: MinHash) -> np.ndarray:
    """How many of the packed minima agree: fields without a differing bit."""
    differ = one ^ many
    step = 1
    while step < how.bits:
        differ = differ | differ >> _U(step)
        step *= 2
    return how.minima - np.bitwise_count(differ & _FIELDS[how.bits]).sum(axis=-1).astype(np.int64)


def may_link(one: np.ndarray, n: int, many: np.ndarray, sizes: np.ndarray, how: MinHash) -> np.ndarray:
    """Whether sizes and estimates leave room for a link."""
    fits = 100 * np.minimum(n, sizes) >= how.percent * np.maximum(n, sizes)
    return fits & (agreeing(one, many, how) >= how.least_agreeing())


def _measured(blocks: DataFrame, how: MinHash) -> DataFrame:
    """A row per document: block, place, doc_id, n, set digest h1 h2, bucket keys, signature (null without words)."""
    schema = pa.schema([(c, pa.int64()) for c in ("block", "place", "doc_id", "n", "h1", "h2")] + [("keys", pa.list_(pa.int64())), ("bits", pa.binary())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = Block(data.as_py())
                sets = Sets(block, how.shingle)
                least = minima(sets, int.from_bytes(block.keys.seed, "little"), how.minima)
                k = len(block)
                keys, bits = [None] * k, [None] * k
                for place, row, sign in zip(np.flatnonzero(sets.sizes).tolist(), band_keys(least, how).view(np.int64), packed(least, how.bits)):
                    keys[place], bits[place] = row, sign.tobytes()
                h1, h2 = sets.digests()
                numbers = [pa.array(c, pa.int64()) for c in (np.full(k, number), np.arange(k))]
                numbers += [block.doc.field("doc_id").cast(pa.int64()), *[pa.array(c, pa.int64()) for c in (sets.sizes, h1, h2)]]
                yield pa.RecordBatch.from_arrays([*numbers, pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary())], schema=schema)

    spec = "block long, place long, doc_id long, n long, h1 long, h2 long, keys array<long>, bits binary"
    return stage(blocks.select("block", "data").mapInArrow(run, spec), "minhash")


def _classes(docs: DataFrame) -> DataFrame:
    """One row per set: class, h1, h2, n, docs, doc_id (the smallest), block and place of one holder."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "block", "place")
    found = docs.where(F.col("n") > 0).groupBy("h1", "h2", "n").agg(F.min(order).alias("r"), F.count(F.lit(1)).alias("docs"))
    return stage(found.select(F.monotonically_increasing_id().alias("class"), "h1", "h2", "n", "docs", "r.doc_id", "r.block", "r.place"), "classes")


def _live(docs: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (key, class) of the buckets with two classes or more; (class, n, bits) of their members."""
    signed = docs.select("block", "place", "keys", "bits").join(classes.select("class", "n", "block", "place"), ["block", "place"])
    signed = stage(signed.select("class", "n", "keys", "bits"), "signed")
    rows = signed.select(F.explode("keys").alias("key"), "class")
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1).select("key")
    live = stage(rows.join(shared, "key").select("key", "class"), "buckets")
    members = live.select("class").distinct()
    return live, stage(signed.select("class", "n", "bits").join(members, "class"), "signatures")


def _sets(blocks: DataFrame, classes: DataFrame, members: DataFrame, how: MinHash) -> DataFrame:
    """``class, data`` (the sorted set) of ``members``."""
    wanted = classes.select("class", "block", "place").join(members.select("class"), "class", "left_semi")
    places = wanted.groupBy("block").agg(F.collect_list(F.struct("place", "class")).alias("answers"))  # a block's own documents

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, mine in zip(batch.column(1), batch.column(2)):
                mine = sorted(mine.as_py() or [], key=lambda m: m["place"])
                if mine:
                    sets = Sets(Block(data.as_py()), how.shingle, [m["place"] for m in mine])
                    values = [sets[m["place"]].tobytes() for m in mine]
                    yield pa.RecordBatch.from_arrays([pa.array([m["class"] for m in mine], pa.int64()), pa.array(values, pa.binary())], ["class", "data"])

    return stage(with_answers(blocks, [places]).mapInArrow(run, "class long, data binary"), "sets")


def _both(pairs: DataFrame, facts: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` (a, b) with ``columns`` of either class, named a_... and b_... ."""
    for side in ("a", "b"):
        pairs = pairs.join(facts.select(F.col("class").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)
    return pairs.select("a", "b", *[f"{side}_{c}" for side in ("a", "b") for c in columns])


def _passing(pairs: DataFrame, signatures: DataFrame, how: MinHash) -> DataFrame:
    """The pairs that sizes and estimates do not rule out."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("a_bits", "b_bits"))
                ok = may_link(a, batch.column("a_n").to_numpy(), b, batch.column("b_n").to_numpy(), how)
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    return _both(pairs, signatures, ["n", "bits"]).mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, how: MinHash) -> DataFrame:
    """The pairs that are links, by their full sets."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("a_data"), batch.column("b_data"))
            ok = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), how.percent) for x, y in both]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return _both(pairs, sets, ["data"]).mapInArrow(run, "a long, b long")


def _with_hubs(live: DataFrame) -> DataFrame:
    """Pairs (a, b): every member of a bucket with the bucket's hub."""
    turn = F.struct(F.xxhash64("key", "class").alias("h"), "class")
    hubs = live.groupBy("key").agg(F.min(turn)["class"].alias("hub"))
    pairs = live.join(hubs, "key").where(F.col("class") != F.col("hub"))
    return pairs.select(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")).distinct()


def _tiles(live: DataFrame, roots: DataFrame, signatures: DataFrame) -> DataFrame:
    """The buckets that hold two components, as rows (key, i, j, side, class, root, n, bits). A
    bucket of s slices makes a tile (i, j) for each two slices, whose classes meet those of
    the other side, and one for each slice (i, i), whose classes meet each other."""
    rooted = live.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    rooted = rooted.select("key", "class", F.coalesce("root", "class").alias("root"))
    sized = rooted.join(signatures.select("class", "n"), "class")
    kinds = sized.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("rows"), F.sum("n").alias("entries"))
    slices = F.ceil(F.greatest(F.col("rows") / F.lit(SLICE_ROWS), 8 * F.col("entries") / F.lit(SLICE_BYTES)))
    kinds = stage(kinds.where(F.col("lo") != F.col("hi")).select("key", slices.cast("int").alias("slices")), "open-buckets")
    rows = sized.join(kinds, "key").withColumn("mine", F.pmod(F.xxhash64("class"), F.col("slices")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    i, j, side = F.least("mine", "other"), F.greatest("mine", "other"), F.col("mine") > F.col("other")
    rows = rows.select("key", i.alias("i"), j.alias("j"), side.alias("side"), "class", "root", "n")
    return rows.join(signatures.select("class", "bits"), "class").select("key", "i", "j", "side", "class", "root", "n", "bits")


_TILE = ["key", "i", "j"]


def _by_tile(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_TILE).sortWithinPartitions(*_TILE, "side", "class")


class _Tile:
    """The rows of one tile in a worker: for each class those of other components it may be linked with."""

    def __init__(self, rows: list[tuple], how: MinHash):
        _, i, j, side, self.classes, roots, n, bits, *data = zip(*rows)
        self.how, self.data = how, data[0] if data else None
        self.apart = i[0] != j[0]
        self.first = sum(not s for s in side)  # of the other side
        self.roots = list(roots)
        self.root, self.n = np.array(roots, np.int64), np.array(n, np.int64)
        self.bits = np.frombuffer(b"".join(bits), np.uint64).reshape(len(rows), -1)

    def candidates(self) -> Iterator[tuple[int, np.ndarray]]:
        for one in range(self.first if self.apart else len(self.classes)):
            least = self.first if self.apart else one + 1
            open_ = self.root[least:] != self.root[one]
            if open_.any():
                open_ &= may_link(self.bits[one], int(self.n[one]), self.bits[least:], self.n[least:], self.how)
                if open_.any():
                    yield one, np.flatnonzero(open_) + least

    def links(self) -> Iterator[tuple[int, int]]:
        """Links that join components; of two in one component by now none is needed."""
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        sets = [np.frombuffer(d, np.uint64) for d in self.data]
        for one, others in self.candidates():
            for other in others.tolist():
                a, b = find(self.roots[one]), find(self.roots[other])
                if a != b and linked(sets[one], sets[other], self.how.percent):
                    up[a] = b
                    yield self.classes[one], self.classes[other]


def _tile_groups(batches: Iterator[pa.RecordBatch], how: MinHash) -> Iterator[tuple[tuple, _Tile]]:
    """Tiles of sorted rows; a tile holds at most about two slices."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))):
            if row[:3] != now and rows:
                yield now, _Tile(rows, how)
                rows = []
            now = row[:3]
            rows.append(row)
    if rows:
        yield now, _Tile(rows, how)


def _left_over(tiles: DataFrame, sets: DataFrame, how: MinHash) -> DataFrame:
    """Links (a, b) between different components: signatures choose the rows whose sets are needed."""

    @tidy
    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, i, j), tile in _tile_groups(batches, how):
            live = {x for one, others in tile.candidates() for x in (one, *others.tolist())}
            if live:
                columns = [[key] * len(live), [i] * len(live), [j] * len(live), [tile.classes[x] for x in live]]
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*_TILE, "class"])

    @tidy
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tile in _tile_groups(batches, how):
            found = list(tile.links())
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    tiles = stage(tiles, "tiles")
    live = _by_tile(tiles).mapInArrow(screen, "key long, i int, j int, class long")
    rows = tiles.join(live, [*_TILE, "class"]).join(sets, "class").select(*_TILE, "side", "class", "root", "n", "bits", "data")
    return _by_tile(rows).mapInArrow(confirm, "a long, b long")


def near_duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", how: MinHash = MinHash()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` (and ``class_id``, the smallest document
    with the same set) of every row of ``docs``.

    Words are the stretches between ASCII white space, A-Z in lower case. A text of fewer
    words than a shingle is one shingle; a text without words, or null, has none and is
    linked with nothing. ``component_id`` is the smallest id that links lead to, its own
    included (null ids come last); ``kept`` tells whether that is the row's own id, so a
    row without an id is kept only where its whole component has none. Repeated rows are
    returned each. Sets hold 64-bit hashes under a key of the run. Other columns are not
    read; an empty table gives an empty result. A very long text is a block of its own."""
    if how.bits not in _FIELDS or 64 % how.bits:
        raise ValueError("bits must be 1, 2, 4 or 8")
    blocks = make_blocks(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_body")), "_body", ["doc_id"])
    rows = _measured(blocks, how)
    classes = _classes(rows)
    live, signatures = _live(rows, classes)
    sets = _sets(blocks, classes, signatures, how)
    discard(blocks)
    near = stage(_passing(_with_hubs(live), signatures, how), "hub-pairs")
    links = stage(_confirmed(near, sets, how), "hub-links")
    links = links.unionByName(_left_over(_tiles(live, components(links), signatures), sets, how))
    roots = components(stage(links, "links"))
    known = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    known = stage(known.select("h1", "h2", "docs", "root", F.col("doc_id").alias("class_id")), "class-roots")
    names = known.groupBy("root").agg(F.min("class_id").alias("component_id"), F.count(F.lit(1)).alias("rows"))
    total = known.agg(F.count(F.lit(1)).alias("classes"), F.coalesce(F.sum("docs"), F.lit(0)).alias("docs")).first()
    named = attach(known, names, ["root"], "rows", total["classes"], ["h1"]).select("h1", "h2", "docs", "class_id", F.col("_found.component_id"))
    h1, h2 = (F.when(F.col("n") > 0, F.col(h)).alias(h) for h in ("h1", "h2"))  # documents without words keep to themselves
    found = attach(rows.select("doc_id", "n", h1, h2, "block", "place"), named, ["h1", "h2"], "docs", total["docs"], ["block", "place"])
    own = F.col("_found").isNull()
    found = found.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(own, F.col("doc_id")).otherwise(F.col("_found.component_id")).alias("component_id"),
        F.when(own, F.col("doc_id")).otherwise(F.col("_found.class_id")).alias("class_id"),
    )
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
