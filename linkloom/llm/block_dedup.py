"""Substring dedup: fixed-block anchors.

Each text's words are cut into non-overlapping reference blocks of ``b`` words with
``2 b - 1 <= length``, so every window of ``length`` words holds a whole block of its
own text. The blocks are indexed; every rolling window of ``b`` words of every text
probes them. A block that any other place equals is a hit, and only windows that
hold a hit block can occur twice. Those are extended to whole windows of ``length``
words and compared with each other; the union of the windows that start at two
places or more are the maximal exact repeats, and all their copies go.

Both comparisons are exchanges between blocks of documents: probes carry no
identity, equal ones of a block are sent once, and only index entries are answered.
A probe is 32 bits and the part's number - a false hit costs a comparison, no more.
Whole windows are compared by 64 bits, and dealt by an independent hash.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy
from .exchange import Block, Stretches, Words, by_part, exchange, make_blocks, mix, parts_for, with_answers

_U = np.uint64


class Places(Words):
    """The words of a block, with hashes of their windows."""

    def __init__(self, block: Block):
        super().__init__(block)
        self.stretches = Stretches(self.hashes, block.keys)

    def windows(self, size: int) -> np.ndarray:
        """Starts of all windows of ``size`` words inside a text."""
        n = len(self.hashes)
        ok = np.ones(n, bool)
        for s, e in zip(self.starts.tolist(), self.ends.tolist()):
            ok[max(s, e - size + 1) : e] = False
        return np.flatnonzero(ok)

    def hash_at(self, starts: np.ndarray, size: int) -> np.ndarray:
        return self.stretches.hashes(starts, starts + size)


class Probes:
    """Distinct rolling windows of a block's texts, and which of them are its index entries."""

    def __init__(self, words: Places, size: int, parts: int):
        starts = words.windows(size)
        h = words.hash_at(starts, size)
        self.values, back, count = np.unique(h, return_inverse=True, return_counts=True)
        self.twice = count > 1
        doc = np.searchsorted(words.ends, starts, side="right")
        at = (starts - words.starts[doc]) % size == 0 if len(starts) else np.zeros(0, bool)
        self.entry_starts = starts[at]
        self.entry_value = back[at]
        self.asked = np.zeros(len(self.values), bool)
        self.asked[self.entry_value] = True
        self.asked &= ~self.twice
        self.part = ((self.values >> _U(32)) % _U(parts)).astype(np.int32)

    def emit(self) -> Iterator[tuple[int, bytes]]:
        for part, places in by_part(self.part):
            low = (self.values[places] & _U(0xFFFFFFFF)).astype("<u4")
            flags = np.packbits(np.concatenate((self.twice[places], self.asked[places])))
            yield part, struct.pack("<II", part, len(places)) + low.tobytes() + flags.tobytes()

    def hits(self, answers: list[bytes]) -> np.ndarray:
        """Starts of the index entries that another place equals."""
        hit = self.twice.copy()
        told = {struct.unpack_from("<I", a)[0]: a for a in answers}
        for part, places in by_part(self.part):
            if part in told:
                asked = places[self.asked[places]]
                hit[asked] |= np.unpackbits(np.frombuffer(told[part], np.uint8, offset=4), count=len(asked)).astype(bool)
        return self.entry_starts[hit[self.entry_value]]


def _reduce_probes(payloads: list[bytes]) -> Iterator[tuple[int, bytes]]:
    yield from _reduce_counts(payloads, "<u4")


def _reduce_counts(payloads: list[bytes], kind: str) -> Iterator[tuple[int, bytes]]:
    """For every asked value of every payload: does another place have it?"""
    width = np.dtype(kind).itemsize
    values, twice, asked, part = [], [], [], 0
    for p in payloads:
        part, n = struct.unpack_from("<II", p)
        values.append(np.frombuffer(p, kind, n, 8))
        flags = np.unpackbits(np.frombuffer(p, np.uint8, offset=8 + width * n), count=2 * n).astype(bool)
        twice.append(flags[:n])
        asked.append(flags[n:])
    every = np.concatenate(values)
    order = np.argsort(every, kind="stable")
    v = every[order]
    new = np.ones(len(v), bool)
    new[1:] = v[1:] != v[:-1]
    heads = np.flatnonzero(new)
    total = np.add.reduceat(1 + np.concatenate(twice)[order].astype(np.int64), heads) if len(v) else np.zeros(0, np.int64)
    many = np.zeros(len(v), bool)
    many[order] = np.repeat(total > 1, np.diff(np.append(heads, len(v))))
    at = 0
    for i, a in enumerate(asked):
        mine = many[at : at + len(a)][a]
        at += len(a)
        if mine.any():
            yield i, struct.pack("<I", part) + np.packbits(mine).tobytes()


class Candidates:
    """Windows of ``length`` words that hold a hit entry, and their distinct hashes."""

    def __init__(self, words: Places, hits: np.ndarray, size: int, length: int, parts: int):
        change = np.zeros(len(words.hashes) + 1, np.int64)
        np.add.at(change, np.maximum(hits - (length - size), 0), 1)
        np.add.at(change, hits + 1, -1)
        ok = np.cumsum(change[:-1]) > 0
        starts = words.windows(length)
        self.starts = starts[ok[starts]] if len(starts) else starts
        self.values, self.value, count = np.unique(words.hash_at(self.starts, length), return_inverse=True, return_counts=True)
        self.twice = count > 1
        self.part = (mix(self.values ^ _U(0x5851F42D4C957F2D)) % _U(parts)).astype(np.int32)

    def emit(self) -> Iterator[tuple[int, bytes]]:
        for part, places in by_part(self.part):
            flags = np.packbits(np.concatenate((self.twice[places], ~self.twice[places])))
            yield part, struct.pack("<II", part, len(places)) + self.values[places].tobytes() + flags.tobytes()

    def repeated(self, answers: list[bytes]) -> np.ndarray:
        """Starts of the windows that start elsewhere too."""
        many = self.twice.copy()
        told = {struct.unpack_from("<I", a)[0]: a for a in answers}
        for part, places in by_part(self.part):
            if part in told:
                asked = places[~self.twice[places]]
                many[asked] |= np.unpackbits(np.frombuffer(told[part], np.uint8, offset=4), count=len(asked)).astype(bool)
        return self.starts[many[self.value]]


def _reduce_windows(payloads: list[bytes]) -> Iterator[tuple[int, bytes]]:
    yield from _reduce_counts(payloads, "<u8")


def remove_repeated_words(docs: DataFrame, keep: list[str], length: int = 35, text: str = "text") -> DataFrame:
    """Every row of ``docs`` without the words that are covered by a window of ``length``
    words whose sequence also starts anywhere else, in the same row or another.

    Returns the columns ``keep``, ``kept`` (the words that stay, joined by one space),
    ``n_words``, ``n_removed`` and ``spans`` (array of first and last removed word of
    each maximal repeat). Words are the stretches between ASCII white space,
    unchanged; windows are judged on the input. A null text has no words; equal rows
    are repeats of each other. Other columns are not read, an empty table gives an
    empty result."""
    size = (length + 1) // 2
    if size < 1:
        raise ValueError("length must be positive")
    blocks = make_blocks(docs, text, keep)
    parts = parts_for(blocks, 0.7)
    parts2 = parts_for(blocks, 0.3)

    def probe(data):
        return Probes(Places(Block(data)), size, parts).emit()

    def candidates(words, first):
        return Candidates(words, Probes(words, size, parts).hits(first), size, length, parts2)

    def extend(data, first):
        return candidates(Places(Block(data)), first).emit()

    first = exchange(blocks, [], probe, _reduce_probes, "block-hits")
    second = exchange(blocks, [first], extend, _reduce_windows, "window-counts")
    doc_type = docs.select(F.struct(*keep).alias("_doc")).schema["_doc"].dataType.simpleString()

    @tidy
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                _, data, a, b = (batch.column(i)[row].as_py() for i in range(4))
                block = Block(data)
                words = Places(block)
                starts = candidates(words, a or []).repeated(b or [])
                change = np.zeros(len(words.hashes) + 1, np.int64)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                out = []
                for mine, s, e in zip(block.texts(), words.starts.tolist(), words.ends.tolist()):
                    g = gone[s:e]
                    mine = mine.split()
                    if not g.any():
                        out.append((b" ".join(mine), e - s, 0, []))
                        continue
                    edges = np.flatnonzero(np.diff(np.concatenate(([False], g, [False])).astype(np.int8)))
                    spans = [{"first": int(x), "last": int(y) - 1} for x, y in zip(edges[::2], edges[1::2])]
                    out.append((b" ".join([w for w, x in zip(mine, g.tolist()) if not x]), e - s, int(g.sum()), spans))
                kept, n, removed, spans = zip(*out)
                arrays = [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, _SPANS)]
                yield pa.RecordBatch.from_arrays([block.doc, *arrays], ["_doc", "kept", "n_words", "n_removed", "spans"])

    schema = f"_doc {doc_type}, kept string, n_words long, n_removed long, spans array<struct<first int, last int>>"
    done = with_answers(blocks, [first, second]).mapInArrow(finish, schema)
    return done.select(*[F.col("_doc")[c].alias(c) for c in keep], "kept", "n_words", "n_removed", "spans")


_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
