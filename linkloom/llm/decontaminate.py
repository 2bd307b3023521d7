"""Benchmark decontamination: q-gram lemma filtering.

A text region within ``k`` edits of a passage of ``n`` characters shares at least
``n - q + 1 - k q`` of its q-grams, all on diagonals (place in the text minus place
in the passage) that differ by ``k`` at most. Diagonals are cut into bands of
``2 (k + 1)`` that overlap by half, so some band holds them all. Shared q-grams are
counted per band, bands under the bound are dropped - no region within the budget is
lost - and the others are verified by a banded alignment.

Items longer than a passage are cut into passages that start every ``step`` characters,
so each run of ``passage + step - 1`` characters of an item holds a whole one. Items
under ``min_chars`` are too short for edits: they are looked for as whole words, unchanged.

Benchmark items are compiled into an index of bounded size; a larger benchmark is
taken in blocks, each of which is one pass over the documents. The documents are not
shuffled. Both sides are compared in lower case with every run of other characters
than letters and digits as one space.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shipped, tidy

#: Characters of benchmark text in one index; the bound of what is sent to every task.
INDEX_CHARS = 2_000_000
#: Characters of documents that are searched at once.
PIECE_CHARS = 1_000_000
#: Pairs of a place in a text and one in a passage that are held at once, but for very repetitive passages.
MEETINGS = 4_000_000


@dataclass(frozen=True)
class Budget:
    q: int = 8
    rate: float = 0.1  # edits per character of a passage
    passage: int = 69  # longer items are searched as passages of so many characters,
    step: int = 12  # that start every so many characters: a verbatim run of 80 holds one
    min_chars: int = 24  # shorter items are searched as whole words without edits

    def edits(self, n: int) -> int:
        """The edit budget of a passage; never so large that the bound on shared q-grams is under 1."""
        return max(0, min(int(n * self.rate), (n - self.q) // self.q))

    def shared(self, n: int) -> int:
        return n - self.q + 1 - self.edits(n) * self.q


@lru_cache(1)
def _folds() -> np.ndarray:
    """What each code point becomes: a lower-case letter or digit, or a space."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] in "LNM":
            out[c] = ord(chr(c).lower()[0])
    return out


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the folded text, and the place in the text of each."""
    folded = _folds()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    space = folded == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    keep[:1] = ~space[:1]
    at = np.flatnonzero(keep)
    if len(at) and folded[at[-1]] == 32:
        at = at[:-1]
    return folded[at], at


def gram_hashes(x: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the ``q`` values at each place."""
    n = len(x) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = 0x9E3779B97F4A7C15
    have, h, out, done = 1, x.astype(np.uint64), None, 0
    while True:
        if q & have:
            out = h[done : done + n].copy() if out is None else out * np.uint64(pow(base, have, 1 << 64)) + h[done : done + n]
            done += have
        if have * 2 > q:
            return out ^ (out >> np.uint64(31))
        h = h[:-have] * np.uint64(pow(base, have, 1 << 64)) + h[have:]
        have *= 2


class Index:
    """Passages of benchmark items and their q-grams."""

    TABLE_BITS = 22

    def __init__(self, items: list[tuple[int, str]], budget: Budget):
        self.budget = budget
        self.item, self.passages = [], []
        self.short: dict[bytes, list[int]] = {}  # folded text -> items under min_chars
        for number, (_, text) in enumerate(items):
            x, _ = normalise(text)
            if len(x) < budget.min_chars:
                if len(x):
                    self.short.setdefault(x.tobytes(), []).append(number)
                continue
            whole = len(x) <= budget.passage + budget.step // 2
            starts = [0] if whole else sorted({*range(0, len(x) - budget.passage, budget.step), len(x) - budget.passage})
            for s in starts:
                self.item.append(number)
                self.passages.append(x if whole else x[s : s + budget.passage])
        self.ids = [i for i, _ in items]
        self.item = np.array(self.item, np.int64)
        self.sizes = np.array([len(p) for p in self.passages], np.int64)
        self.edits = np.array([budget.edits(n) for n in self.sizes.tolist()], np.int64)
        self.shared = np.array([budget.shared(n) for n in self.sizes.tolist()], np.int64)
        self.of_item = np.bincount(self.item, minlength=len(items)) if len(self.item) else np.zeros(len(items), np.int64)
        grams = [gram_hashes(p, budget.q) for p in self.passages]
        every = np.concatenate(grams or [np.zeros(0, np.uint64)])
        passage = np.repeat(np.arange(len(grams)), [len(g) for g in grams]).astype(np.int64)
        place = np.concatenate([np.arange(len(g)) for g in grams] or [np.zeros(0, np.int64)])
        order = np.argsort(every, kind="stable")
        self.passage, self.place = passage[order], place[order]
        self.values, self.begin = np.unique(every[order], return_index=True)
        self.count = np.diff(np.append(self.begin, len(every)))
        self.table = np.zeros(1 << self.TABLE_BITS, bool)
        self.table[self._slot(self.values)] = True
        self.gap = int(self.edits.max(initial=0)) + 1

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.TABLE_BITS)).astype(np.int64)

    def candidates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, first diagonal) of the bands that reach their bound."""
        h = gram_hashes(x, self.budget.q)
        at = np.flatnonzero(self.table[self._slot(h)])
        h = h[at]
        found = np.minimum(np.searchsorted(self.values, h), len(self.values) - 1)
        ok = self.values[found] == h
        at, found = at[ok], found[ok]
        # a region holds its shared q-grams close together: those far from enough others are dropped
        least, reach = int(self.shared.min()), int((self.sizes + self.edits).max()) - self.budget.q
        if len(at) < least:
            at, found = at[:0], found[:0]
        elif least > 1:
            dense = (at[least - 1 :] - at[: len(at) - least + 1] <= reach).astype(np.int64)
            run = np.cumsum(np.append(dense, np.zeros(least - 1, np.int64)) - np.append(np.zeros(least, np.int64), dense[:-1])[: len(at)])
            at, found = at[run > 0], found[run > 0]
        keys = np.unique(np.concatenate([self._bands(len(x), at[a:b], found[a:b]) for a, b in self._pieces(at, found)] or [np.zeros(0, np.int64)]))
        span = self._span(len(x))
        passage = keys // span
        return passage, (keys % span) * (self.edits[passage] + 1) - self.sizes[passage]

    def _span(self, length: int) -> int:
        return length + int(self.sizes.max(initial=0)) + 2

    def _pieces(self, at: np.ndarray, found: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of the q-grams found that meet at most about MEETINGS places of passages each, however
        often a text and a passage repeat themselves. Neighbouring runs share so much text that
        every band lies whole in one of them."""
        reach = int(self.sizes.max(initial=0)) + 4 * self.gap
        total = np.cumsum(self.count[found])
        a = 0
        while a < len(at):
            b = int(np.searchsorted(total, (total[a - 1] if a else 0) + MEETINGS, side="right"))
            b = max(b, int(np.searchsorted(at, at[a] + 2 * reach, side="right")))
            yield a, min(b, len(at))
            if b >= len(at):
                return
            a = max(a + 1, int(np.searchsorted(at, at[b - 1] - reach)))

    def _bands(self, length: int, at: np.ndarray, found: np.ndarray) -> np.ndarray:
        """passage * span + band of the bands that reach their bound among these q-grams."""
        n = self.count[found]
        rows = np.repeat(self.begin[found], n) + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))
        passage = self.passage[rows]
        width = self.edits[passage] + 1
        band = (np.repeat(at, n) - self.place[rows] + self.sizes[passage]) // width  # never negative
        span = self._span(length)
        key = np.concatenate((passage * span + band, passage * span + band - 1))
        # a hashed count, never too small, leaves few keys to sort
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
        enough = np.bincount(slot.astype(np.int64), minlength=1 << 20)[slot.astype(np.int64)] >= self.shared[np.concatenate((passage, passage))]
        # of equal q-grams of a text in a band, each place of the passage counts once
        places = int(self.sizes.max(initial=0)) + 1
        key = np.unique(key[enough] * places + np.tile(self.place[rows], 2)[enough]) // places
        key, count = np.unique(key, return_counts=True)
        ok = (count >= self.shared[np.maximum(key, 0) // span]) & (key >= 0)
        return key[ok]

    def verify(self, x: np.ndarray, passage: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(edits, first and last place in the text) of the best region of each band;
        edits over the passage's budget mean none."""
        best = np.full(len(passage), np.iinfo(np.int64).max)
        first, last = np.zeros(len(passage), np.int64), np.zeros(len(passage), np.int64)
        sizes = self.sizes[passage]
        order = np.argsort(sizes, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            for a in range(0, len(some), 2000):
                part = some[a : a + 2000]
                if len(part):
                    same_size = np.stack([self.passages[p] for p in passage[part].tolist()])
                    best[part], first[part], last[part] = align(x, same_size, diagonal[part], int(self.edits[passage[part[0]]]))
        return best, first, last


def align(x: np.ndarray, passages: np.ndarray, diagonal: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Banded semi-global alignment of each row of ``passages`` on the diagonals from
    ``diagonal - k`` to ``diagonal + 3 k + 1``: (edits, first, last place) of the best region
    of each band. Start and end in the text are free; all bands move through their passages together."""
    low, width = diagonal - k, 4 * k + 2
    lanes = np.arange(width)
    stride = np.int64(1) << 31
    never = stride << 20
    size = passages.shape[1]
    margin = size + 3 * width  # no band begins further outside
    padded = np.concatenate((np.zeros(margin, x.dtype), x, np.zeros(margin, x.dtype)))  # 0 equals nothing
    best, first, last = np.full(len(low), k + 1), np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
    alive = np.arange(len(low))
    # edits first, then the earliest start
    state = np.broadcast_to(low[:, None] + lanes, (len(low), width)) + (np.int64(1) << 30)
    for i in range(size):
        at = low[alive][:, None] + (lanes + i)
        step = state + stride * (padded[at + margin] != passages[alive, i][:, None])
        step[(at < 0) | (at >= len(x))] = never
        step[:, :-1] = np.minimum(step[:, :-1], state[:, 1:] + stride)  # a character of the passage is missing
        # characters of the text may be skipped: cheapest of all lanes to the left
        state = np.minimum.accumulate(step - lanes * stride, axis=1) + lanes * stride
        if i % 8 == 7:  # bands that have spent the budget are given up
            going = state.min(axis=1) < (k + 1) * stride
            alive, state = alive[going], state[going]
            if not len(alive):
                break
    if len(alive):
        lane = state.argmin(axis=1)
        got = state[np.arange(len(alive)), lane]
        best[alive] = np.minimum(got // stride, k + 1)
        first[alive] = np.clip(got % stride - (1 << 30), 0, None)
        last[alive] = low[alive] + lane + size - 1
    return best, first, last


def _pieces(texts: list[str | None], index: Index) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Folded texts joined with gaps that no alignment crosses: (values, text number and
    place in the text of each value). Long texts come in overlapping pieces."""
    overlap = 2 * (int(index.sizes.max(initial=0)) + 4 * index.gap)
    gap = np.zeros(index.gap, np.uint32)
    values, owners, places, held = [], [], [], 0
    for number, text in enumerate(texts):
        x, at = normalise(text or "")
        for a in range(0, max(len(x) - overlap, 1), PIECE_CHARS):
            b = min(len(x), a + PIECE_CHARS + overlap)
            if b - a >= index.budget.q:
                values += [x[a:b], gap]
                owners += [np.full(b - a, number, np.int64), np.full(len(gap), number, np.int64)]
                places += [at[a:b], np.full(len(gap), at[b - 1], np.int64)]
                held += b - a
            if held >= PIECE_CHARS:
                yield np.concatenate(values), np.concatenate(owners), np.concatenate(places)
                values, owners, places, held = [], [], [], 0
    if held:
        yield np.concatenate(values), np.concatenate(owners), np.concatenate(places)


def search(texts: list[str | None], index: Index) -> list[tuple[int, int, int, int, int, int, int]]:
    """(text number, item number, matched passages, all passages, edits, start, end) of
    every text and item; edits are the least of a matched passage, start and end the
    stretch of the text from the first to the last match."""
    hits: dict[tuple[int, int], dict[int, tuple[int, int, int]]] = {}
    if not len(index.values):
        return []
    for x, owner, place in _pieces(texts, index):
        passage, diagonal = index.candidates(x)
        edits, first, last = index.verify(x, passage, diagonal)
        for i in np.flatnonzero(edits <= index.edits[passage]) if len(passage) else ():
            p = int(passage[i])
            end = min(int(last[i]), len(x) - 1)
            # a best region may begin or end on skipped characters of the gap: its middle is inside the text
            text = int(owner[(int(first[i]) + end) // 2])
            found = hits.setdefault((text, int(index.item[p])), {})
            new = (int(edits[i]), int(place[first[i]]), int(place[end]) + 1)
            found[p] = min(found.get(p, new), new)
    return [
        (text, item, len(f), int(index.of_item[item]), min(e for e, _, _ in f.values()), min(s for _, s, _ in f.values()), max(e for _, _, e in f.values()))
        for (text, item), f in sorted(hits.items())
    ]


def search_short(texts: list[str | None], index: Index) -> list[tuple[int, int, int, int, int, int, int]]:
    """As ``search``, for the items under ``min_chars``: each is one passage, found where
    the folded text has it between spaces or ends."""
    if not index.short:
        return []
    base = np.uint64(0x9E3779B97F4A7C15)

    def ends(x: np.ndarray, at: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per length, the places ``at`` where words end after so many characters, and a hash of these."""
        h = np.zeros(len(at), np.uint64)
        for n in range(1, most + 1):
            at, h = at[at + n < len(x)], h[at + n < len(x)]
            h = h * base + x[at + n - 1].astype(np.uint64)
            whole = x[at + n] == 32
            yield n, at[whole], h[whole]

    by_size: dict[int, list[int]] = {}
    for key in index.short:
        x = np.append(np.frombuffer(key, np.uint32), np.uint32(32))
        *_, (n, _, h) = ends(x, np.zeros(1, np.int64), len(x) - 1)
        by_size.setdefault(n, []).append(int(h[0]))
    hashes = {n: np.unique(np.array(h, np.uint64)) for n, h in by_size.items()}
    hits: dict[tuple[int, int], tuple[int, int]] = {}
    for number, text in enumerate(texts):
        x, place = normalise(text or "")
        if not len(x):
            continue
        x = np.append(x, np.uint32(32))
        starts = np.append(0, np.flatnonzero(x[:-1] == 32) + 1)
        for n, at, h in ends(x, starts, max(hashes)):
            if n not in hashes:
                continue
            found = np.minimum(np.searchsorted(hashes[n], h), len(hashes[n]) - 1)
            for a in at[hashes[n][found] == h].tolist():
                begin, end = int(place[a]), int(place[a + n - 1]) + 1
                for item in index.short.get(x[a : a + n].tobytes(), ()):
                    first, last = hits.get((number, item), (begin, end))
                    hits[number, item] = min(first, begin), max(last, end)
    return [(text, item, 1, 1, 0, first, last) for (text, item), (first, last) in sorted(hits.items())]


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of about INDEX_CHARS characters, by a hash of the text.
    One block at a time is on the driver."""
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    total = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // INDEX_CHARS))
    for b in range(blocks):
        yield [(r["id"], r["text"]) for r in items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()]


_COLUMNS = ["item_id", "n_matched", "n_passages", "edits", "start", "end"]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    budget: Budget = Budget(),
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per row of ``docs`` and benchmark item of which it holds a passage within
    the edit budget: the columns ``keep``, ``item_id``, ``n_matched`` of ``n_passages``,
    the least ``edits`` and where in the text (``start``, ``end``, code points).

    Any verbatim run of ``passage + step - 1`` folded characters of an item is found; items
    up to ``passage + step / 2`` long are one passage; items under ``min_chars`` are found
    as whole words. Null and empty texts match nothing; repeated rows and items are
    reported each. An empty table on either side gives an empty result."""
    rows = docs.select(F.struct(*keep).alias("_doc"), F.col(text).alias("_text"))
    doc_type = rows.schema["_doc"].dataType.simpleString()
    schema = f"_doc {doc_type}, " + ", ".join(f"{c} long" for c in _COLUMNS)
    out = None
    for items in benchmark_blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(items)  # at most about INDEX_CHARS characters

        @tidy
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = _compiled(shared.value, budget)
            for batch in batches:
                texts = batch.column("_text").to_pylist()
                hits = search(texts, index) + search_short(texts, index)
                row = pa.array([h[0] for h in hits], pa.int64())
                values = [[index.ids[h[1]] for h in hits], *([h[i] for h in hits] for i in range(2, 7))]
                arrays = [batch.column("_doc").take(row), *(pa.array(v, pa.int64()) for v in values)]
                yield pa.RecordBatch.from_arrays(arrays, ["_doc", *_COLUMNS])

        found = shipped(rows).mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out.select(*[F.col("_doc")[c].alias(c) for c in keep], *_COLUMNS)


_last: tuple[list, Budget, Index] | None = None


def _compiled(items: list[tuple[int, str]], budget: Budget) -> Index:
    """The index of ``items``; a worker keeps the last one for its next task."""
    global _last
    if _last is None or _last[0] is not items or _last[1] != budget:
        _last = items, budget, Index(items, budget)
    return _last[2]


def drop_leaks(docs: DataFrame, benchmark: DataFrame, budget: Budget = Budget(), text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, unchanged."""
    out = docs
    for items in benchmark_blocks(benchmark, "item_id", "text"):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        @tidy
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = _compiled(shared.value, budget)
            for batch in batches:
                texts = batch.column(text).to_pylist()
                bad = {h[0] for h in search(texts, index) + search_short(texts, index)}
                yield batch.take(pa.array([i for i in range(batch.num_rows) if i not in bad], pa.int64()))

        out = shipped(out).mapInArrow(run, docs.schema)
    return out
