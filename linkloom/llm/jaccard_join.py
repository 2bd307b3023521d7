"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

Exact components of the documents whose sets of word shingles have a Jaccard
similarity of at least ``percent`` / 100.

* Documents with equal sets are one *class*; from here on only classes are compared.
* Two similar sets share one of their first ``n - ceil(t n) + 1`` elements in any
  common order (prefix filter). The order is by hash, with elements that very many
  documents have at the end, so that they hardly serve as a meeting place. The classes
  that share such an element form a *tile*. A block exchange finds the elements that
  two classes share at all; all others are never written out.
* In a tile, classes come by size and only a band of sizes (from ``t n`` to ``n``) is
  held. Bitmap signatures - one hashed bit per element - give an upper bound of the
  overlap by counting the bits that one has and the other lacks. Classes that this
  leaves without any partner are done, and their sets are never written.
* Tiles need no pair that is already connected. So first each class is compared with one
  class of each of three of its tiles, which joins a group of near copies at linear cost;
  only tiles that hold two components then go on, and only with pairs of two components.
* Sets are intersected exactly. Each class takes its set to one of its tiles (twice, by
  different choices), where it is linked to what is connected already, if it can be. Then all tiles that still hold two
  components are gone through by signatures, and the pairs left over are verified. No link between different sets is lost, and a group of
  thousands of near copies costs no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .block_dedup import _reduce_probes
from .common import attach, discard, release_shuffles, stage, tidy
from .components import components
from .exchange import Block, Stretches, Words, by_part, exchange, make_blocks, mix, parts_for, with_answers

#: Elements in more than 1 / COMMON of all set entries go to the end of the order; at most COMMON elements do.
COMMON = 100_000
#: Classes that bring their sets to one tile together; larger tiles are dealt at random.
TILE = 2_000
#: Rows that hold sets or signatures, sent to a worker at once.
BATCH_ROWS = 1_000
_U = np.uint64


@dataclass(frozen=True)
class Similarity:
    shingle: int = 4
    percent: int = 85

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1


class Sets:
    """The shingle sets of a block's documents, or of those at ``places`` (ascending): sorted
    distinct 64-bit hashes, cut at ``ends``."""

    def __init__(self, block: Block, size: int, places: list[int] | None = None):
        words = Words(block if places is None else block.only(places), lower=True)
        counts, starts = words.ends - words.starts, words.starts
        stretches = Stretches(words.hashes, block.keys)
        many = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        doc = np.repeat(np.arange(len(counts)), many)
        first = np.repeat(starts, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        length = np.minimum(counts, size)[doc]
        values = stretches.hashes(first, first + length)
        values = np.where(length < size, mix(values + length.astype(np.uint64)), values)  # a short text is its own kind of shingle
        edges = np.cumsum(many)
        sets = [np.unique(values[b - m : b]) for m, b in zip(many.tolist(), edges.tolist())]
        self.values = np.concatenate(sets or [np.zeros(0, np.uint64)])
        self.sizes = np.array([len(v) for v in sets], np.int64)
        if places is not None:  # the other documents' sets are left out
            sizes, self.sizes = self.sizes, np.zeros(len(block), np.int64)
            self.sizes[places] = sizes
        self.ends = np.cumsum(self.sizes)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.values[self.ends[i] - self.sizes[i] : self.ends[i]]

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each set: two sums of hashes of its elements."""
        sums = []
        for salt in (0, 0x9E3779B97F4A7C15):
            total = np.concatenate(([_U(0)], np.cumsum(mix(self.values ^ _U(salt)), dtype=np.uint64)))
            sums.append((total[self.ends] - total[self.ends - self.sizes]).view(np.int64))
        return sums[0], sums[1]


def prefix_of(values: np.ndarray, common: np.ndarray, similarity: Similarity) -> np.ndarray:
    """The first elements of a sorted set in the order by (common, hash)."""
    late = np.zeros(len(values), bool)
    if len(common):
        late = common[np.minimum(np.searchsorted(common, values), len(common) - 1)] == values
    return np.concatenate((values[~late], values[late]))[: similarity.prefix(len(values))]


def signature(values: np.ndarray, bits: int) -> np.ndarray:
    """One bit for each element, by the lowest bits of its hash; ``bits`` is a power of two, 64 at least."""
    at = (values & _U(bits - 1)).astype(np.int64)
    out = np.zeros(bits // 64, np.uint64)
    np.bitwise_or.at(out, at >> 6, _U(1) << (at & 63).astype(np.uint64))
    return out


def signature_bits(n: int, per_element: int = 1) -> int:
    return max(64, 1 << (int(n) * per_element - 1).bit_length())


def folded(bitmap: np.ndarray, bits: int) -> np.ndarray:
    """A signature with half as many bits, again and again: its halves joined."""
    while bitmap.shape[-1] * 64 > bits:
        half = bitmap.shape[-1] // 2
        bitmap = bitmap[..., :half] | bitmap[..., half:]
    return bitmap


def may_link(bitmap: np.ndarray, n: int, bitmaps: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether the bit counts leave room for a link. Each bit that only one signature has
    stands for an element that the other set lacks."""
    mine = np.bitwise_count(bitmap & ~bitmaps).sum(axis=1).astype(np.int64)
    theirs = np.bitwise_count(bitmaps & ~bitmap).sum(axis=1).astype(np.int64)
    overlap = np.minimum(n - mine, sizes - theirs)
    return 100 * overlap >= percent * (n + sizes - overlap)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test on two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    overlap = int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
    return 100 * overlap >= percent * (len(a) + len(b) - overlap) and len(a) > 0


class Tile:
    """Sets that come by size; each is linked to what is connected already, if it can be."""

    def __init__(self, percent: int):
        self.percent, self.bits = percent, 64
        self.ids: list[int] = []
        self.sets: list[np.ndarray] = []
        self.sizes = np.zeros(0, np.int64)
        self.bitmaps = np.zeros((0, 1), np.uint64)
        self.groups: dict[int, int] = {}
        self.root: dict[int, int] = {}

    def _find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def add(self, number: int, values: np.ndarray, group: int) -> Iterator[tuple[int, int]]:
        """The links of a new set; ``group`` is the component that it is known to be in."""
        n = len(values)
        gone = int(np.searchsorted(self.sizes, -(-self.percent * n // 100)))  # too small for this and all later sets
        if gone:
            self.ids, self.sets, self.sizes, self.bitmaps = self.ids[gone:], self.sets[gone:], self.sizes[gone:], self.bitmaps[gone:]
        if signature_bits(n) > self.bits:
            self.bits = signature_bits(n)
            self.bitmaps = np.array([signature(s, self.bits) for s in self.sets], np.uint64).reshape(len(self.sets), self.bits // 64)
        bitmap = signature(values, self.bits)
        self.root.setdefault(group, group)
        tried = np.flatnonzero(may_link(bitmap, n, self.bitmaps, self.sizes, self.percent)) if self.ids else ()
        for i in tried:
            other, mine = self._find(self.groups[self.ids[i]]), self._find(group)
            if other != mine and linked(values, self.sets[i], self.percent):
                self.root[other] = mine
                yield self.ids[i], number
        self.groups[number] = group
        self.ids.append(number)
        self.sets.append(values)
        self.sizes = np.append(self.sizes, n)
        self.bitmaps = np.concatenate((self.bitmaps, bitmap[None]))


class _Band:
    """Signatures that come by size. Few are compared as whole numbers, one by one, many
    as an array in which the smallest set held has the width of all."""

    FEW = 24

    def __init__(self):
        self.items: list[tuple[int, int, int, int, bytes]] = []  # number, root, size, bits, signature
        self.begin = 0
        self.arrays = None

    def partners(self, number: int, root: int, n: int, raw: bytes, percent: int) -> list[int]:
        """Those of another component that a new signature does not rule out; it is held then."""
        least = -(-percent * n // 100)
        items = self.items
        while self.begin < len(items) and items[self.begin][2] < least:
            self.begin += 1
        if len(items) - self.begin > self.FEW:
            found = self._among_many(root, n, raw, percent)
        else:
            self.arrays = None
            found = [i[0] for i in items[self.begin :] if i[1] != root and _may_link(n, raw, i[2], i[4], percent)]
        items.append((number, root, n, len(raw), raw))
        return found

    def _among_many(self, root: int, n: int, raw: bytes, percent: int) -> list[int]:
        held = self.items[self.begin :]
        width = held[0][3] // 8
        have = self.arrays
        if have is None or have[0] != width:
            stack = np.array([folded(np.frombuffer(i[4], np.uint64), width * 64) for i in held], np.uint64)
            have = width, self.begin, stack, *(np.array([i[k] for i in held], np.int64) for k in range(3))
        _, begin, stack, ids, roots, sizes = have
        fresh = held[begin + len(ids) - self.begin :]
        if fresh:
            stack = np.concatenate((stack, [folded(np.frombuffer(i[4], np.uint64), width * 64) for i in fresh]))
            ids, roots, sizes = (np.append(x, [i[k] for i in fresh]) for k, x in enumerate((ids, roots, sizes)))
        gone = self.begin - begin
        stack, ids, roots, sizes = stack[gone:], ids[gone:], roots[gone:], sizes[gone:]
        self.arrays = width, self.begin, stack, ids, roots, sizes
        ok = roots != root
        if ok.any():
            ok[ok] = may_link(folded(np.frombuffer(raw, np.uint64), width * 64), n, stack[ok], sizes[ok], percent)
        return ids[ok].tolist()


def _may_link(n: int, raw: bytes, m: int, other: bytes, percent: int) -> bool:
    """``may_link`` of two signatures as whole numbers."""
    x, y = int.from_bytes(raw, "little"), int.from_bytes(other, "little")
    wide, narrow = len(raw), len(other)
    while wide != narrow:
        if wide > narrow:
            wide //= 2
            x = x >> 8 * wide | x & ((1 << 8 * wide) - 1)
        else:
            narrow //= 2
            y = y >> 8 * narrow | y & ((1 << 8 * narrow) - 1)
    both = (x & y).bit_count()
    overlap = min(n - x.bit_count() + both, m - y.bit_count() + both)
    return 100 * overlap >= percent * (n + m - overlap)


def _sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, tuple]]:
    """(key, rest of the row) of every row."""
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            yield row[:keys], row[keys:]


def _pair_batches(pairs: Iterator[tuple[int, int]], names: list[str] = ["a", "b"]) -> Iterator[pa.RecordBatch]:
    a, b = [], []
    for x, y in pairs:
        a.append(x)
        b.append(y)
        if len(a) >= 100_000:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names)
            a, b = [], []
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names)


def _classes(blocks: DataFrame, doc_id: str, similarity: Similarity) -> tuple[DataFrame, DataFrame, list[int]]:
    """Documents (block, place, doc_id, n, digest h1 h2), classes (class, h1, h2, docs,
    doc_id, block, place) and the common elements."""

    @tidy
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = Block(data.as_py())
                sets = Sets(block, similarity.shingle)
                h1, h2 = sets.digests()
                ids = block.doc.field(doc_id).cast(pa.int64())
                k = len(block)
                yield _rows([number] * k, np.arange(k), ids, sets.sizes, h1, h2)
                values, count = np.unique(sets.values, return_counts=True)
                often = count > 2  # an element of one in some hundred documents is seen so often in a block
                k = int(often.sum())
                yield _rows([number] * k, np.full(k, -1), pa.nulls(k, pa.int64()), count[often], values[often].view(np.int64), np.zeros(k, np.int64))

    rows = stage(blocks.select("block", "data").mapInArrow(measure, "block long, place long, doc_id long, n long, h1 long, h2 long"), "sets")
    docs = rows.where(F.col("place") >= 0)
    entries = docs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    often = rows.where(F.col("place") < 0).groupBy("h1").agg(F.sum("n").alias("n")).where(F.col("n") * COMMON > F.lit(entries))
    common = sorted(r["h1"] for r in often.select("h1").collect())  # at most COMMON numbers
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "block", "place")
    classes = docs.where(F.col("n") > 0).groupBy("h1", "h2").agg(F.min(order).alias("r"), F.count(F.lit(1)).alias("docs"))
    classes = classes.select(F.monotonically_increasing_id().alias("class"), "h1", "h2", "docs", "r.doc_id", "r.block", "r.place")
    return docs, stage(classes, "classes"), common


def _rows(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], ["block", "place", "doc_id", "n", "h1", "h2"])


def _prefix_blocks(blocks: DataFrame, classes: DataFrame, common: list[int], similarity: Similarity) -> DataFrame:
    """``block, data``: packed class numbers, set sizes, first elements and signatures of
    the classes that each block stands for."""
    late = np.sort(np.array(common, np.int64).view(np.uint64))
    members = classes.groupBy("block").agg(F.collect_list(F.struct("place", "class")).alias("answers"))  # a block's own documents

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data, mine in zip(batch.column(0), batch.column(1), batch.column(2)):
                mine = sorted(mine.as_py() or [], key=lambda m: m["place"])
                if mine:
                    sets = Sets(Block(data.as_py()), similarity.shingle, [m["place"] for m in mine])
                    packed = _pack([m["class"] for m in mine], [sets[m["place"]] for m in mine], late, similarity)
                    yield pa.RecordBatch.from_arrays([pa.array([number.as_py()], pa.int64()), pa.array([packed], pa.binary())], ["block", "data"])

    out = stage(with_answers(blocks, [members]).mapInArrow(run, "block long, data binary"), "prefixes")
    release_shuffles(out.sparkSession)
    return out


def _pack(numbers: list[int], sets: list[np.ndarray], late: np.ndarray, similarity: Similarity) -> bytes:
    prefixes = [prefix_of(v, late, similarity) for v in sets]
    head = np.array([numbers, [len(v) for v in sets], [len(p) for p in prefixes]], "<i8")
    bits = b"".join(signature(v, signature_bits(len(v))).tobytes() for v in sets)
    return len(numbers).to_bytes(8, "little") + head.tobytes() + b"".join(p.tobytes() for p in prefixes) + bits


def _unpack(data: bytes) -> tuple[list[int], list[int], list[np.ndarray], list[bytes]]:
    """Class numbers, set sizes, first elements and signatures."""
    k = int.from_bytes(data[:8], "little")
    numbers, sizes, lengths = np.frombuffer(data, "<i8", 3 * k, 8).reshape(3, k)
    at = 8 + 24 * k
    every = np.frombuffer(data, np.uint64, int(lengths.sum()), at)
    at += every.nbytes
    widths = [signature_bits(n) // 8 for n in sizes.tolist()]
    ends = np.cumsum(widths).tolist()
    bits = [data[at + e - w : at + e] for w, e in zip(widths, ends)]
    return numbers.tolist(), sizes.tolist(), np.split(every, np.cumsum(lengths)[:-1]) if k else [], bits


class _Shared:
    """The distinct prefix elements of a block, and which of them another class has."""

    def __init__(self, prefixes: list[np.ndarray], parts: int):
        every = np.concatenate(prefixes or [np.zeros(0, np.uint64)])
        self.values, self.back, count = np.unique(every, return_inverse=True, return_counts=True)
        self.twice = count > 1
        self.part = ((self.values >> _U(32)) % _U(parts)).astype(np.int32)

    def emit(self) -> Iterator[tuple[int, bytes]]:
        for part, places in by_part(self.part):
            flags = np.packbits(np.concatenate((self.twice[places], ~self.twice[places])))
            yield part, np.array([part, len(places)], "<u4").tobytes() + (self.values[places] & _U(0xFFFFFFFF)).astype("<u4").tobytes() + flags.tobytes()

    def flags(self, answers: list[bytes]) -> np.ndarray:
        """For each prefix element, in order: is it shared?"""
        many = self.twice.copy()
        told = {int.from_bytes(a[:4], "little"): a for a in answers}
        for part, places in by_part(self.part):
            if part in told:
                asked = places[~self.twice[places]]
                many[asked] |= np.unpackbits(np.frombuffer(told[part], np.uint8, offset=4), count=len(asked)).astype(bool)
        return many[self.back]


def _tiles(blocks: DataFrame, classes: DataFrame, common: list[int], similarity: Similarity) -> DataFrame:
    """Rows (token, class, n, data): one without ``data`` per class and shared prefix
    element, and one with its signature as ``data`` (and no token) per class that has any."""
    prefixes = _prefix_blocks(blocks, classes, common, similarity)
    parts = parts_for(blocks, 0.15)

    def offer(data):
        return _Shared(_unpack(data)[2], parts).emit()

    answers = exchange(prefixes, [], offer, _reduce_probes, "shared-elements")

    @tidy
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, told in zip(batch.column(1), batch.column(2)):
                found = list(zip(*_unpack(data.as_py())))
                flags = _Shared([prefix for _, _, prefix, _ in found], parts).flags(told.as_py() or [])
                tokens, numbers, sizes, sets, at = [], [], [], [], 0
                for number, n, prefix, bits in found:
                    here = prefix[flags[at : at + len(prefix)]]
                    at += len(prefix)
                    if len(here):
                        tokens += [*here.view(np.int64).tolist(), None]
                        numbers += [number] * (len(here) + 1)
                        sizes += [n] * (len(here) + 1)
                        sets += [None] * len(here) + [bits]
                arrays = [pa.array(tokens, pa.int64()), pa.array(numbers, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["token", "class", "n", "data"])

    out = stage(with_answers(prefixes, [answers]).mapInArrow(write, "token long, class long, n long, data binary"), "tiles")
    discard(prefixes, answers)
    release_shuffles(out.sparkSession)
    return out


def _hub_links(tokens: DataFrame, signatures: DataFrame, blocks: DataFrame, classes: DataFrame, similarity: Similarity) -> DataFrame:
    """Links found at linear cost: each class is compared with one class, the hub, of each of
    three of its tiles. The tiles are chosen by a hash of their element, so near copies choose
    the same ones, and a group of near copies becomes one component or a few."""
    choices = [F.min(F.struct(F.xxhash64(F.col("token"), F.lit(seed)).alias("h"), "token"))["token"].alias(f"t{seed}") for seed in range(3)]
    homes = tokens.groupBy("class").agg(*choices).select("class", F.explode(F.array_distinct(F.array("t0", "t1", "t2"))).alias("token"))
    homes = stage(homes, "homes")
    turn = F.struct(F.xxhash64("token", "class").alias("h"), "class")
    hubs = homes.groupBy("token").agg(F.min(turn)["class"].alias("hub"), F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
    pairs = homes.join(hubs.select("token", "hub"), "token").where(F.col("class") != F.col("hub"))
    pairs = pairs.select(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")).distinct()

    @tidy
    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_pylist() for c in ("a_n", "b_n"))
            raw = zip(n, batch.column("a_data").to_pylist(), m, batch.column("b_data").to_pylist())
            ok = [_may_link(*four, similarity.percent) for four in raw]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    near = stage(_both(pairs, signatures, ["n", "data"]).mapInArrow(screen, "a long, b long"), "hub-pairs")
    named = near.select(F.col("a").alias("class")).unionByName(near.select(F.col("b").alias("class")))
    sets = _sets(blocks, classes, named, similarity)
    links = stage(_confirmed(near, sets, similarity.percent), "hub-links", BATCH_ROWS)
    discard(sets, homes, near)
    return links


def _both(pairs: DataFrame, facts: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` (a, b) with ``columns`` of either class, named a_... and b_... ."""
    for side in ("a", "b"):
        pairs = pairs.join(facts.select(F.col("class").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)
    return pairs.select("a", "b", *[f"{side}_{c}" for c in columns for side in ("a", "b")])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are links, by their sets."""

    @tidy
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("a_data"), batch.column("b_data"))
            ok = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent) for x, y in both]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return _both(pairs, sets, ["data"]).mapInArrow(verify, "a long, b long")


def _live(tokens: DataFrame, roots: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The rows of ``tokens`` that have a partner of another component in their tile which the
    signatures do not rule out."""
    rows = _open_tiles(tokens, roots).join(signatures.select("class", "data"), "class").select("token", "class", "root", "n", "data")
    tiles = rows.repartition("token").sortWithinPartitions("token", "n", "class")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def live():
            now = None
            for key, (number, root, n, raw) in _sorted_groups(batches, 1):
                if key != now:
                    now, band, told = key, _Band(), set()
                partners = band.partners(number, root, n, raw, percent)
                for one in (*partners, number) if partners else ():
                    if one not in told:
                        told.add(one)
                        yield key[0], one

        return _pair_batches(live(), ["token", "class"])

    found = tiles.mapInArrow(run, "token long, class long")
    return stage(found.join(signatures.select("class", "n"), "class").select("token", "class", "n"), "live-rows", BATCH_ROWS)


def _sets(blocks: DataFrame, classes: DataFrame, live: DataFrame, similarity: Similarity) -> DataFrame:
    """``class, data`` (the sorted set) of the classes of ``live``."""
    wanted = classes.join(live.select("class").distinct(), "class", "left_semi")
    members = wanted.groupBy("block").agg(F.collect_list(F.struct("place", "class")).alias("answers"))

    @tidy
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, mine in zip(batch.column(1), batch.column(2)):
                mine = sorted(mine.as_py() or [], key=lambda m: m["place"])
                if mine:
                    sets = Sets(Block(data.as_py()), similarity.shingle, [m["place"] for m in mine])
                    values = [sets[m["place"]].tobytes() for m in mine]
                    yield pa.RecordBatch.from_arrays([pa.array([m["class"] for m in mine], pa.int64()), pa.array(values, pa.binary())], ["class", "data"])

    out = stage(with_answers(blocks, [members]).mapInArrow(write, "class long, data binary"), "sets")
    release_shuffles(out.sparkSession)
    return out


def _open_tiles(tokens: DataFrame, roots: DataFrame) -> DataFrame:
    """``token, class, n, root`` of the tiles that hold two components or more. A class
    without a link is its own component."""
    rows = tokens.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    rows = rows.select("token", "class", "n", F.coalesce("root", "class").alias("root"))
    kinds = rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    kinds = stage(kinds.where(F.col("lo") != F.col("hi")).select("token"), "open-tiles")
    return stage(rows.join(kinds, "token"), "open-rows")


def _at_home(rows: DataFrame, sets: DataFrame, seed: int, percent: int) -> DataFrame:
    """Links that are found when each class of ``rows`` takes its set to one of its tiles."""
    choice = F.xxhash64(F.col("token"), F.lit(seed))
    home = rows.groupBy("class", "root").agg(F.min(F.struct(choice.alias("h"), "token")).alias("m")).select("class", "root", F.col("m.token").alias("token"))
    counts = home.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
    placed = attach(home, counts, ["token"], "rows", home.count(), ["class"]).where(F.col("_found").isNotNull())
    deal = F.pmod(F.xxhash64("class", F.lit(seed)), F.ceil(F.col("_found.rows") / TILE))
    placed = placed.select("token", deal.cast("int").alias("deal"), "class", "root")
    tiles = placed.join(sets, "class").select("token", "deal", "class", "root", F.octet_length("data").alias("n"), "data")
    tiles = tiles.repartition("token", "deal").sortWithinPartitions("token", "deal", "n", "class").select("token", "deal", "class", "root", "data")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links():
            now, tile = None, None
            for key, (number, root, data) in _sorted_groups(batches, 2):
                if key != now:
                    now, tile = key, Tile(percent)
                yield from tile.add(number, np.frombuffer(data, np.uint64), root)

        return _pair_batches(links())

    return tiles.mapInArrow(run, "a long, b long")


def _left_over(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components of the open tiles ``rows``: fine signatures (eight
    bits per element, which few pairs pass that are no link) first, then sets."""

    @tidy
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(d.as_py(), np.uint64) for d in batch.column(1)]
            bits = [signature(v, signature_bits(len(v), 8)).tobytes() for v in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], ["class", "bits"])

    signed = sets.join(rows.select("class").distinct(), "class", "left_semi").select("class", "data").mapInArrow(sign, "class long, bits binary")
    tiles = rows.join(signed, "class").select("token", "class", "root", "n", "bits")
    tiles = tiles.repartition("token").sortWithinPartitions("token", "n", "class")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            now, seen = None, set()
            for key, (number, root, n, raw) in _sorted_groups(batches, 1):
                if key != now:
                    now, band = key, _Band()
                for other in band.partners(number, root, n, raw, percent):
                    if (other, number) not in seen:
                        if len(seen) > 500_000:  # the same pair of another tile is dropped later
                            seen.clear()
                        seen.add((other, number))
                        yield other, number

        return _pair_batches(pairs())

    pairs = stage(tiles.mapInArrow(run, "a long, b long").distinct(), "pairs", BATCH_ROWS)
    return _confirmed(pairs, sets, percent)


def _grouped(blocks: DataFrame, similarity: Similarity) -> DataFrame:
    """``block, place, doc_id, n, root, component_id, class_id`` of every document; ``root`` names
    its component, those without words have none."""
    rows, classes, common = _classes(blocks, "doc_id", similarity)
    tiles = _tiles(blocks, classes, common, similarity)
    signatures = tiles.where(F.col("data").isNotNull()).select("class", "n", "data")
    tokens = tiles.where(F.col("data").isNull()).select("token", "class", "n")
    links = _hub_links(tokens, signatures, blocks, classes, similarity)
    roots = stage(components(links), "roots")
    tokens = _live(tokens, roots, signatures, similarity.percent)
    discard(tiles)
    sets = _sets(blocks, classes, tokens, similarity)
    for seed in (1, 2):
        links = stage(links.unionByName(_at_home(_open_tiles(tokens, roots), sets, seed, similarity.percent)), "links-so-far", BATCH_ROWS)
        roots = stage(components(links), "roots")
        release_shuffles(blocks.sparkSession)
    links = links.unionByName(_left_over(_open_tiles(tokens, roots), sets, similarity.percent))
    roots = stage(components(stage(links, "all-links", BATCH_ROWS)), "roots")
    discard(sets, tokens)
    known = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    known = stage(known.select("h1", "h2", "docs", "root", F.col("doc_id").alias("class_id")), "class-roots")
    names = known.groupBy("root").agg(F.min("class_id").alias("component_id"), F.count(F.lit(1)).alias("rows"))
    total = known.agg(F.count(F.lit(1)).alias("classes"), F.coalesce(F.sum("docs"), F.lit(0)).alias("docs")).first()
    named = attach(known, names, ["root"], "rows", total["classes"], ["h1"])
    named = named.select("h1", "h2", "docs", "root", "class_id", F.col("_found.component_id"))
    # documents without words keep to themselves
    h1, h2 = (F.when(F.col("n") > 0, F.col(h)).alias(h) for h in ("h1", "h2"))
    found = attach(rows.select("doc_id", "n", h1, h2, "block", "place"), named, ["h1", "h2"], "docs", total["docs"], ["block", "place"])
    own = F.col("_found").isNull()
    ids = [F.when(own, F.col("doc_id")).otherwise(F.col(f"_found.{c}")).alias(c) for c in ("component_id", "class_id")]
    return found.select("block", "place", "doc_id", "n", F.col("_found.root"), *ids)


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: Similarity = Similarity()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` (and ``class_id``, the smallest document with
    the same set) of every row of ``docs``.

    Words are the stretches between ASCII white space, A-Z in lower case. A text of fewer
    words than a shingle is one shingle; a text without words, or null, has none and is
    linked with nothing. ``component_id`` is the smallest id that links lead to, its own
    included (null ids come last). Repeated rows are returned each. Sets hold 64-bit
    hashes under a key of the run. Other columns are not read; an empty table gives an
    empty result."""
    blocks = make_blocks(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_body")), "_body", ["doc_id"])
    found = _grouped(blocks, similarity)
    discard(blocks)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "class_id")


def keep_one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: Similarity = Similarity()) -> DataFrame:
    """The rows of ``docs``, with all their columns, without those that are near duplicates of
    a kept one: of each component the row with the smallest id stays (null ids last, then any
    one row, so of equal rows one). Rows are told apart by where they lie, not by their ids:
    two texts under one id are two documents, and copies without an id are copies. Rows
    without words stay."""
    others = [c for c in docs.columns if c != text]
    row = F.struct(F.col(text).isNull().alias("_none"), F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"c_{c}") for c in others]).alias("_rest"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row.alias("_row"), F.col(text).alias("_body"))
    blocks = make_blocks(rows, "_body", ["doc_id", "_row"])
    found = _grouped(blocks, similarity).where(F.col("root").isNotNull()).select("block", "place", "doc_id", "root")
    found = stage(found, "grouped-rows")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "block", "place")
    best = found.groupBy("root").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
    dropped = found.join(best, "root").where((F.col("block") != F.col("best.block")) | (F.col("place") != F.col("best.place")))
    dropped = dropped.groupBy("block").agg(F.collect_list("place").alias("answers"))  # a block's own documents

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, gone in zip(batch.column(1), batch.column(2)):
                block = Block(data.as_py())
                kept = np.ones(len(block), bool)
                kept[gone.as_py() or []] = False
                texts = pa.array([t for t, k in zip(block.texts(), kept.tolist()) if k], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([block.doc.field("_row").filter(pa.array(kept)), texts], ["_row", "_body"])

    left = with_answers(blocks, [dropped]).mapInArrow(run, f"_row {rows.schema['_row'].dataType.simpleString()}, _body string")
    body = F.when(~F.col("_row._none"), F.col("_body"))
    return left.select(*[body.alias(c) if c == text else F.col("_row._rest")[f"c_{c}"].alias(c) for c in docs.columns])
