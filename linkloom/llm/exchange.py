"""Blocks of whole documents, and exchanges of small items between them.

Operators that compare every place of every text with all others first pack the
documents into blocks of about ``BLOCK_BYTES`` (a long document is a block of its
own). In an exchange each block emits compact items, dealt by a key that equal
items share into ``parts``; Spark shuffles them; each part is reduced on its own
and answers go back to the blocks that asked. Items that are equal within a block
are sent once, so no key can have more items than there are blocks, however many
documents hold it. A task never holds more than one block or one part, and the
number of parts follows the size of the input.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_shuffles, ship_package, stage, tidy

BLOCK_BYTES = 2_000_000
PART_BYTES = 2_000_000
#: What a worker is sent at once: by rows alone it would be all blocks of a task.
BATCH_BYTES = 4_000_000


def make_blocks(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``block, docs, bytes, data`` written to the shared folder. ``data`` is an Arrow
    stream of ``_text`` (null texts as empty ones) and the columns ``keep`` as struct ``_doc``.
    All blocks carry one secret number, new for each call, from which hashes get their keys."""
    ship_package(docs.sparkSession)
    seed = secrets.token_bytes(8)
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"), F.struct(*keep).alias("_doc"))

    def packed(slices: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(slices).combine_chunks().replace_schema_metadata({"seed": seed})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(whole)
        size = pc.sum(pc.binary_length(whole["_text"])).as_py() or 0
        columns = [pa.array([whole.num_rows], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["docs", "bytes", "data"])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column("_text")).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
            done = 0
            while done < batch.num_rows:
                before = int(ends[done - 1]) if done else 0
                stop = min(int(np.searchsorted(ends, before + BLOCK_BYTES - held)) + 1, batch.num_rows)
                slices.append(batch.slice(done, stop - done))
                held += int(ends[stop - 1]) - before
                done = stop
                if held >= BLOCK_BYTES:
                    yield packed(slices)
                    slices, held = [], 0
        if slices:
            yield packed(slices)

    blocks = rows.mapInArrow(run, "docs long, bytes long, data binary").withColumn("block", F.monotonically_increasing_id())
    return stage(blocks, "blocks", batch_bytes=BATCH_BYTES)


class Block:
    """A block in a worker: ``doc`` (struct array), ``text`` (all bytes) and ``ends`` of the texts."""

    def __init__(self, data: bytes):
        whole = pa.ipc.open_stream(data).read_all().combine_chunks()
        self.keys = Keys(int.from_bytes((whole.schema.metadata or {}).get(b"seed", b""), "little"))
        self.doc = whole["_doc"].combine_chunks() if whole.num_rows else whole["_doc"].chunk(0)
        texts = whole["_text"].combine_chunks()
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        raw = texts.cast(pa.binary())
        offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1]
        data_buffer = raw.buffers()[2]
        self.text = np.frombuffer(data_buffer, np.uint8)[offsets[0] : offsets[-1]] if data_buffer is not None else np.zeros(0, np.uint8)

    def __len__(self) -> int:
        return len(self.ends)

    def only(self, places: list[int]) -> Block:
        """The documents at ``places`` (ascending), without their columns."""
        part = object.__new__(Block)
        lengths = (self.ends - self.starts)[places]
        part.keys, part.doc = self.keys, None
        part.ends = np.cumsum(lengths)
        part.starts = part.ends - lengths
        part.text = np.concatenate([self.text[a:b] for a, b in zip(self.starts[places], self.ends[places])] or [self.text[:0]])
        return part

    def texts(self) -> list[bytes]:
        raw = self.text.tobytes()
        return [raw[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist())]

    def numbers(self, field: str) -> np.ndarray:
        """An integer field of the documents; nulls become the largest number."""
        values = pc.struct_field(self.doc, field).cast(pa.int64())
        return pc.fill_null(values, np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def parts_for(blocks: DataFrame, bytes_per_byte: float) -> int:
    """Parts of about ``PART_BYTES`` if each byte of text emits ``bytes_per_byte``."""
    total = blocks.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"]
    return max(1, -(-int(total * bytes_per_byte) // PART_BYTES))


def exchange(
    blocks: DataFrame,
    answers: list[DataFrame],
    emit: Callable[..., Iterable[tuple[int, bytes]]],
    reduce: Callable[[list[bytes]], Iterable[tuple[int, bytes]]],
    name: str,
) -> DataFrame:
    """``block, answers`` (array of binary; blocks without an answer are absent).

    ``emit(data, *answers so far)`` yields (part, payload) of a block. ``reduce``
    gets the payloads of a part and yields (number of the payload, answer). An
    answer must tell what it belongs to; answers come in no order."""

    @tidy
    def emit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, data, *got = (batch.column(i)[row].as_py() for i in range(batch.num_columns))
                out = list(emit(data, *[g or [] for g in got]))
                if out:
                    parts, payloads = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(parts, pa.int32()), pa.array([block] * len(out), pa.int64()), pa.array(payloads, pa.binary())], ["part", "block", "payload"]
                    )

    @tidy
    def reduce_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, owners, payloads = None, [], []

        def answered() -> Iterator[pa.RecordBatch]:
            out = [(owners[i], a) for i, a in reduce(payloads)]
            if out:
                to, what = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array(what, pa.binary())], ["block", "answer"])

        for batch in batches:
            for part, block, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if part != now and payloads:
                    yield from answered()
                    owners, payloads = [], []
                now = part
                owners.append(block)
                payloads.append(payload)
        if payloads:
            yield from answered()

    items = with_answers(blocks, answers).mapInArrow(emit_all, "part int, block long, payload binary")
    dealt = items.repartition("part").sortWithinPartitions("part")
    got = dealt.mapInArrow(reduce_all, "block long, answer binary")
    out = stage(got.groupBy("block").agg(F.collect_list("answer").alias("answers")), name, batch_bytes=BATCH_BYTES)
    release_shuffles(out.sparkSession)
    return out


def with_answers(blocks: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """``block, data`` and one array column per exchange so far. Answers grow with the
    input, so they are never broadcast, however small they happen to be."""
    out = blocks.select("block", "data")
    for i, one in enumerate(answers):
        out = out.join(one.select("block", F.col("answers").alias(f"_answers{i}")).hint("shuffle_merge"), "block", "left")
    return out


def by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places with it, in order) of an array of parts."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for places in np.split(order, cuts):
        if len(places):
            yield int(part[places[0]]), places


# --- hashes of places in a sequence ----------------------------------------------------------

_U = np.uint64


# The multiplier of a public 64-bit mixing function.
def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class Keys:
    """Numbers that only one run knows: whoever writes a text cannot aim at its hashes."""

    def __init__(self, seed: int):
        raw = hashlib.blake2b(b"linkloom", key=seed.to_bytes(8, "little"), digest_size=40).digest()
        self.seed = raw[:8]
        first, second, *rest = (int.from_bytes(raw[i : i + 8], "little") | 1 for i in range(0, 40, 8))
        self.first, self.second = _U(first), _U(second)
        self.lanes = [_U(x) for x in rest]

    def mixed(self, raw: np.ndarray, lane: int = 0) -> np.ndarray:
        """A bijection that spreads every bit; what a text itself says must pass it before ``join``."""
        x = raw ^ self.lanes[lane]
        x ^= x >> _U(32)
        x *= self.first
        x ^= x >> _U(32)
        x *= self.second
        x ^= x >> _U(32)
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A hash of two hashes. For one of them fixed it is a bijection of the other; it
        is no sum, so parts of a stretch cannot cancel each other."""
        x = a * self.first
        x += b
        x ^= x >> _U(32)
        x *= self.second
        x ^= x >> _U(29)
        return x


class Stretches:
    """Hashes of stretches of a sequence. Level by level, the numbers of two neighbouring
    stretches of 2 ** k items make the one of 2 ** (k + 1); any other stretch is hashed
    from the two of the largest such size that cover it, and its length."""

    def __init__(self, values: np.ndarray, keys: Keys, level: int = 0):
        self.values, self.keys, self.level = values, keys, level  # a value covers 2 ** level items

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the items from ``start`` to ``end``, at least 2 ** level of them."""
        size = end - start
        out = np.zeros(len(size), np.uint64)
        if not len(size):
            return out
        kind = np.frexp(size)[1] - 1
        last, level, keys = int(kind.max()), self.values, self.keys
        for k in range(self.level, last + 1):
            mine = slice(None) if (kind == k).all() else np.flatnonzero(kind == k)
            both = keys.join(level[start[mine]], level[end[mine] - (1 << k)])
            out[mine] = keys.join(both, keys.mixed(size[mine].astype(np.uint64)))
            if k < last:
                level = keys.join(level[: -(1 << k)], level[1 << k :])
        return out


def lanes(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number (no copy); zeros follow the text."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    return np.ndarray((len(text) + 1,), "<u8", padded, 0, (1,))


_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Longer stretches of bytes are hashed one by one.
LONG_BYTES = 256


def byte_hashes(text: np.ndarray, begin: np.ndarray, end: np.ndarray, keys: Keys) -> np.ndarray:
    """64 bits of each stretch of bytes, eight bytes of all stretches at a time."""
    eight, size = lanes(text), end - begin
    h = keys.mixed(size.astype(np.uint64), 2)
    short = np.flatnonzero(size <= LONG_BYTES)
    for at in range(0, int(size[short].max(initial=0)), 8):
        short = short[size[short] > at]
        raw = eight[begin[short] + at] & _MASKS[np.minimum(size[short] - at, 8)]
        h[short] = keys.join(h[short], keys.mixed(raw))
    for i in np.flatnonzero(size > LONG_BYTES).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(text[begin[i] : end[i]].tobytes(), key=keys.seed, digest_size=8).digest(), "little")
    return h


#: Bytes that are no ASCII white space, and each byte with A-Z in lower case.
_SOLID = np.array([chr(b) not in " \t\n\x0b\x0c\r" for b in range(256)])
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


#: Words of more bytes are hashed one by one.
LONG_WORD = 32


def _word_hashes(text: np.ndarray, begin: np.ndarray, end: np.ndarray, keys: Keys) -> np.ndarray:
    """64 bits of each word. Up to 32 bytes it is the lanes that cover the word; different
    words of one length up to eight never have one hash."""
    eight = lanes(text)
    size = end - begin
    join, mixed = keys.join, keys.mixed
    h = mixed(eight[begin] & _MASKS[np.minimum(size, 8)])
    two = np.flatnonzero(size > 8)
    if len(two):
        h[two] = join(h[two], mixed(eight[end[two] - 8], 1))
    four = np.flatnonzero(size > 16)
    if len(four):
        h[four] = join(h[four], join(mixed(eight[begin[four] + 8], 2), mixed(eight[end[four] - 16])))
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(text[begin[i] : end[i]].tobytes(), key=keys.seed, digest_size=8).digest(), "little")
    return join(h, mixed(size.astype(np.uint64), 2))


class Words:
    """The words of a block's texts in a row: ``begin`` and ``end`` in the block's bytes,
    64-bit ``hashes``, and for each text where its words start and end (``starts``, ``ends``)."""

    def __init__(self, block: Block, lower: bool = False):
        text = _LOWER[block.text] if lower else block.text
        n = len(text)
        solid = _SOLID[text]
        border = np.zeros(n + 1, bool)  # a text starts here
        border[block.starts] = True
        first, last = solid.copy(), solid.copy()
        if n:
            first[1:] &= ~solid[:-1] | border[1:n]
            last[:-1] &= ~solid[1:] | border[1:n]
        self.begin, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.hashes = _word_hashes(text, self.begin, self.end, block.keys)
        counts = np.bincount(np.searchsorted(block.ends, self.begin, side="right"), minlength=len(block)).astype(np.int64)
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
