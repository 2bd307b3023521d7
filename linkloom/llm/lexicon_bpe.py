"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The corpus's most frequent words are compiled, with their token ids, into a
minimal acyclic automaton with shared suffixes whose arcs carry numbers: the sum
along a word's path is the word's number, which leads to its ids. The automaton is
one file that every worker memory-maps. Words that it lacks are merged exactly by
the tokenizer's rules. Reads byte-level BPE definitions of the tokenizers library.

Encoding is one Arrow pass over the texts without a shuffle. Texts are cut before
each single space between visible characters - a word border in any case - and
what a piece encodes to is kept while the worker's bounded cache has room.
"""

from __future__ import annotations

import heapq
import json
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import share_file, shipped, stage, tidy

#: Words of the lexicon at most; a longer list would only be faster.
LEXICON_WORDS = 65_536
#: Longer words are neither compiled nor merged in blocks.
LONG_WORD = 96
#: Pieces that a worker remembers, and characters that it encodes at once.
CACHE_PIECES = 400_000
BLOCK_CHARS = 1_000_000
#: Different words that a worker counts before it passes the counts on.
COUNT_WORDS = 400_000

#: Fixed value: the pattern that splits text for the byte-level BPE files.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PIECES = re.compile(r"(?<=\S)(?= \S)")
#: A space beside other white space.
_ODD_SPACE = re.compile(r" (?:(?=\s)|(?<=\s ))")


def pieces_of(text: str) -> list[str]:
    """The text cut before each single space between visible characters."""
    if text[:1] == " " or text[-1:] == " " or _ODD_SPACE.search(text):
        return _PIECES.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + r for r in rest]]


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a definition: itself if it prints, else the next one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


def is_word(piece: str) -> bool:
    """Whether a piece is letters only, perhaps after a space: then it is one word of the pattern."""
    return piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha())


# --- the automaton ---------------------------------------------------------------------------


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The automaton of ``entries`` (word -> ids) as the bytes of one file.

    Words are added in order; when a word leaves a branch, the branch is finished
    and replaced by an equal state if there is one (so suffixes are shared)."""
    words = sorted(w for w in entries if w)
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    known: dict[tuple[bool, tuple[tuple[int, int], ...]], int] = {}
    open_nodes: list[list] = [[False, []]]  # final, arcs of the path of the last word

    def close(depth: int, word: bytes) -> None:
        while len(open_nodes) > depth + 1:
            final, arcs = open_nodes.pop()
            state = (final, tuple(arcs))
            if state not in known:
                known[state] = len(states)
                states.append(state)
            open_nodes[-1][1].append((word[len(open_nodes) - 1], known[state]))

    last = b""
    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(common, last)
        for _ in word[common:]:
            open_nodes.append([False, []])
        open_nodes[-1][0] = True
        last = word
    close(0, last)
    states.append((open_nodes[0][0], tuple(open_nodes[0][1])))  # the root is the last state

    below: list[int] = []  # words that can follow from a state; children come first
    keys, targets, numbers = [], [], []
    for s, (final, arcs) in enumerate(states):
        before = int(final)
        for byte, child in arcs:
            keys.append(s * 256 + byte)
            targets.append(child)
            numbers.append(before)
            before += below[child]
        below.append(before)
    ids = [entries[w] for w in words]
    starts = np.cumsum([0, *map(len, ids)])
    flat = [i for one in ids for i in one]
    head = [len(keys), len(states), len(words), len(flat)]
    parts = [head, keys, targets, numbers, [int(f) for f, _ in states], starts, flat]
    return b"".join(np.asarray(p, np.int64).tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon, memory-mapped."""

    def __init__(self, path: str):
        data = np.memmap(path, np.int64, mode="r").view(np.ndarray)  # still the mapped file
        arcs, states, words, flat = (int(x) for x in data[:4])
        cuts = np.cumsum([4, arcs, arcs, arcs, states, words + 1, flat])
        self.keys, self.targets, self.numbers, self.final, self.starts, self.ids = (data[a:b] for a, b in zip(cuts, cuts[1:]))
        self.root = states - 1

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word (all of one length), -1 if it is not there. All words walk together."""
        letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1).astype(np.int64)
        out = np.full(len(words), -1, np.int64)
        at, state, number = np.arange(len(words)), np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        if not len(self.keys):
            return out
        for column in letters.T:
            key = state * 256 + column[at]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[arc] == key
            at, arc = at[ok], arc[ok]
            state, number = self.targets[arc], number[ok] + self.numbers[arc]
        ok = self.final[state] == 1
        out[at[ok]] = number[ok]
        return out

    def ids_of(self, numbers: np.ndarray) -> list[bytes]:
        """The ids of words as little-endian 32-bit numbers."""
        first, last = self.starts[numbers], self.starts[numbers + 1]
        size = last - first
        flat = self.ids[np.repeat(first, size) + _within(size)].astype("<u4").tobytes()
        ends = (4 * np.cumsum(size)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]


def _within(counts: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for each n of ``counts``, one after the other."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


# --- the rules -------------------------------------------------------------------------------


class Rules:
    """Vocabulary and merges of a byte-level BPE definition."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        flags = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        before = spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or spec["normalizer"] or any(model.get(k) for k in flags) or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
            raise ValueError("not a plain byte-level BPE definition")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in or normalise their surroundings are not supported")
        letters = _byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        vocab = model["vocab"]
        self.byte_ids = np.array([vocab[c] for c in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = max(self.bytes_of) + 1
        self.rank = {vocab[a] * self.size + vocab[b]: (r, vocab[a + b]) for r, (a, b) in enumerate(pairs)}
        order = np.array(sorted(self.rank), np.int64)
        self.pair_keys = order
        self.pair_ranks = np.array([self.rank[k][0] for k in order.tolist()], np.int64)
        self.pair_ids = np.array([self.rank[k][1] for k in order.tolist()], np.int64)
        names = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, names))) if names else None

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs in the table of merges; its length stands for none."""
        key = left * self.size + right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, at, len(self.pair_keys))

    def merge_block(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian 32-bit numbers) of words of one length: in each step every word merges its best pair
        (the lowest rank, the leftmost of equal ones) until it has none."""
        none = np.int64(1) << 40
        ranks_of = np.append(self.pair_ranks, none)
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)]
        out = [b""] * len(words)
        rows = np.arange(len(words))
        at = self._pairs(ids[:, :-1], ids[:, 1:]) if ids.shape[1] > 1 else np.zeros((len(words), 0), np.int64)
        while len(rows):
            ranks = ranks_of[at]
            best = ranks.argmin(axis=1) if at.shape[1] else np.zeros(len(rows), np.int64)
            going = ranks[np.arange(len(rows)), best] < none if at.shape[1] else np.zeros(len(rows), bool)
            done = ids[~going].astype("<u4")
            flat, width = done.tobytes(), 4 * done.shape[1]
            for k, i in enumerate(rows[~going].tolist()):
                out[i] = flat[k * width : (k + 1) * width]
            rows, ids, at, best = rows[going], ids[going], at[going], best[going]
            if not len(rows):
                break
            every, width = np.arange(len(rows)), ids.shape[1]
            merged = self.pair_ids[at[every, best]]
            ids = np.take_along_axis(ids, np.arange(width - 1)[None] + (np.arange(width - 1)[None] > best[:, None]), 1)
            ids[every, best] = merged
            if width == 2:
                at = at[:, :0]
                continue
            at = np.take_along_axis(at, np.arange(width - 2)[None] + (np.arange(width - 2)[None] >= best[:, None]), 1)
            left, right = best > 0, best < width - 2
            at[every[left], best[left] - 1] = self._pairs(ids[every[left], best[left] - 1], merged[left])
            at[every[right], best[right]] = self._pairs(merged[right], ids[every[right], best[right] + 1])
        return out

    def merge_long(self, word: bytes) -> list[int]:
        """Ids of one word of any length, by a heap of pairs over a linked list."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n, size, rank = len(ids), self.size, self.rank
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        # rank, place of the left half, merged id, the pair as it was
        heap = [(rank[k][0], i, rank[k][1], k) for i in range(n - 1) if (k := ids[i] * size + ids[i + 1]) in rank]
        heapq.heapify(heap)
        while heap:
            _, i, new, k = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or ids[i] * size + ids[j] != k:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (p := ids[a] * size + ids[b]) in rank:
                    r, merged = rank[p]
                    heapq.heappush(heap, (r, a, merged, p))
        return [x for x in ids if x >= 0]

    def merge(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of each word, as little-endian 32-bit numbers."""
        out: dict[bytes, bytes] = {}
        for group in _by_length(words):
            if len(group[0]) > LONG_WORD:
                out.update((w, np.array(self.merge_long(w), "<u4").tobytes()) for w in group)
            else:
                for a in range(0, len(group), 50_000):
                    out.update(zip(group[a : a + 50_000], self.merge_block(group[a : a + 50_000])))
        return out


def _by_length(words: Iterable[bytes]) -> list[list[bytes]]:
    groups: dict[int, list[bytes]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    return list(groups.values())


# --- encoder ---------------------------------------------------------------------------------


class Codec:
    """Encodes and decodes texts in a worker. Ids are little-endian 32-bit numbers in bytes."""

    def __init__(self, definition: str, lexicon: Lexicon | None):
        import regex

        self.rules = Rules(definition)
        self.lexicon = lexicon
        self.words = regex.compile(WORD_PATTERN).findall
        self.known: dict[str, bytes] = {}  # ids of pieces
        self.seen: dict[str, bytes] = {}  # ids of words
        self.tokens = [self.rules.bytes_of.get(i, b"") for i in range(self.rules.size)]

    def word_ids(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of each word: from the lexicon, else merged."""
        out: dict[bytes, bytes] = {}
        unseen = []
        for group in _by_length(words):
            if self.lexicon is None or len(group[0]) > LONG_WORD:
                unseen += group
                continue
            numbers = self.lexicon.find(group)
            known = np.flatnonzero(numbers >= 0)
            out.update(zip([group[i] for i in known.tolist()], self.lexicon.ids_of(numbers[known])))
            unseen += [group[i] for i in np.flatnonzero(numbers < 0).tolist()]
        out.update(self.rules.merge(unseen))
        return out

    def _learn(self, pieces: set[str]) -> None:
        split = {p: (p,) if is_word(p) else self.words(p) for p in pieces}
        if len(self.seen) > CACHE_PIECES:
            self.seen = {}
        seen = self.seen
        new = list({w for ws in split.values() for w in ws if w not in seen})
        raw = [w.encode() for w in new]
        ids = self.word_ids(raw)
        seen.update(zip(new, [ids[r] for r in raw]))
        for p, ws in split.items():
            self.known[p] = seen[ws[0]] if len(ws) == 1 else b"".join([seen[w] for w in ws])

    def _plain(self, texts: list[str]) -> list[bytes]:
        pieces = [pieces_of(t) for t in texts]
        here = set().union(*pieces)
        new = here - self.known.keys()
        if len(self.known) + len(new) > CACHE_PIECES:  # what occurs now is likely to come again
            self.known = {p: self.known[p] for p in here - new}
        self._learn(new)
        known = self.known
        return [b"".join([known[p] for p in one]) for one in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the definition's special strings become their own ids."""
        find = self.rules.specials
        special = [find.findall(t) if find else [] for t in texts]
        parts = [find.split(t) if s else [t] for t, s in zip(texts, special)]
        done = iter(self._plain([p for one in parts for p in one]))
        out = []
        for one, marks in zip(parts, special):
            ids = [next(done)]
            for mark in marks:
                ids += [self.rules.special[mark].to_bytes(4, "little"), next(done)]
            out.append(b"".join(ids))
        return out

    def decode(self, ids: bytes) -> str:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def _blocks(texts: pa.Array) -> Iterator[int]:
    """Numbers of texts in a row that have about BLOCK_CHARS bytes, or one."""
    size, held = 0, 0
    for n in pc.binary_length(texts).to_pylist():
        if size and held + n > BLOCK_CHARS:
            yield size
            size, held = 0, 0
        size += 1
        held += n
    if size:
        yield size


# --- Spark jobs ------------------------------------------------------------------------------


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word`` (its bytes) and ``n`` over all texts. Each worker counts before it passes on."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(WORD_PATTERN).findall
        counts: Counter[str] = Counter()

        def passed() -> pa.RecordBatch:
            words: Counter[bytes] = Counter()
            for piece, n in counts.items():
                for w in (piece,) if is_word(piece) else find(piece):
                    words[w.encode()] += n
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.binary()), pa.array(words.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for t in batch.column(0):
                counts.update(pieces_of(t.as_py() or ""))
                if len(counts) > COUNT_WORDS:
                    yield passed()
        yield passed()

    counts = shipped(docs).select(F.col(text).alias("text")).mapInArrow(run, "word binary, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def fit_lexicon(docs: DataFrame, definition: str, text: str = "text", words: int = LEXICON_WORDS) -> str:
    """Compiles the most frequent words of all texts and hands the file to the
    executors; returns its name. It takes all words that occur as often as the least
    power of 2 ** (1 / 8) which at most ``words`` words reach, so the driver holds that
    many at most, and no task sends more than its share of them. Words that occur
    once are left out. An empty corpus gives an empty lexicon."""
    rules = Rules(definition)
    counts = word_counts(docs, text).where((F.col("n") > 1) & (F.length("word") <= LONG_WORD))
    counts = stage(counts.withColumn("level", F.floor(8 * F.log2("n")).cast("int")), "word-counts")
    room, lowest = words, None
    for row in counts.groupBy("level").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("level")).collect():  # some 500 levels
        room -= row["k"]
        if room < 0:
            break
        lowest = row["level"]
    top = counts.where(F.col("level") >= F.lit(lowest))  # none if no level fits
    frequent = [bytes(r["word"]) for r in top.select("word").collect()]
    data = compile_lexicon({w: np.frombuffer(ids, "<u4").tolist() for w, ids in rules.merge(frequent).items()})
    return _share(docs.sparkSession, data)


def _share(spark: SparkSession, data: bytes) -> str:
    """Writes the file to the shared checkpoint folder, from where executors fetch it."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    spark.sparkContext.addFile(share_file(spark, name, data))
    return name


def encode_documents(docs: DataFrame, definition: str, lexicon: str | None, keep: list[str], text: str = "text", decoded: bool = False) -> DataFrame:
    """The columns ``keep`` and ``ids`` (binary: little-endian 32-bit ids) of every row;
    with ``decoded`` also the text to which the ids decode, as ``decoded``.

    ``lexicon`` is the name that ``fit_lexicon`` returned, or None. A null text is
    an empty one. Other columns are not read; repeated rows are encoded each."""
    rows = docs.select(F.struct(*keep).alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    doc_type = rows.schema["_doc"].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(definition, lexicon)
        for batch in batches:
            texts, done = batch.column("_text"), 0
            for size in _blocks(texts):
                ids = codec.encode(texts.slice(done, size).to_pylist())
                columns = [batch.column("_doc").slice(done, size), pa.array(ids, pa.binary())]
                if decoded:
                    columns.append(pa.array([codec.decode(i) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["_doc", "ids", "decoded"][: len(columns)])
                done += size
        codec.known, codec.seen = {}, {}

    out = shipped(rows).mapInArrow(run, f"_doc {doc_type}, ids binary" + ", decoded string" * decoded)
    return out.select(*[F.col("_doc")[c].alias(c) for c in keep], "ids", *["decoded"] * decoded)


_last: tuple[tuple[str, str | None], Codec] | None = None


def _codec(definition: str, lexicon: str | None) -> Codec:
    """The codec of a definition and a lexicon; a worker keeps the last one for its next task."""
    global _last
    if _last is None or _last[0] != (definition, lexicon):
        _last = None
        _last = (definition, lexicon), Codec(definition, Lexicon(SparkFiles.get(lexicon)) if lexicon else None)
    return _last[1]


def decode_documents(encoded: DataFrame, definition: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """``encoded`` with its ids decoded in the new column ``into`` (null ids: null)."""
    schema = T.StructType([*encoded.schema.fields, T.StructField(into, T.StringType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(definition, None)
        for batch in batches:
            texts = [codec.decode(v.as_py()) if v.is_valid else None for v in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, into])

    return shipped(encoded).mapInArrow(run, schema)
