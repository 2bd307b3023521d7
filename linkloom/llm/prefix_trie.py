"""Conversation prefix trie: balanced parentheses per shard, shared spines merged.

A node is a distinct sequence of first turns; conversations that start with it are its
members. Three things keep the work even, however the conversations are made:

* *Turns* are sorted over the cluster by conversation and turn, so one very long
  conversation lies in many tasks. Each task hashes the sequences of its part; the hashes
  (two sums modulo 2 ** 61 - 1 with secret bases, over SHA-256 digests of the turns) can
  be continued from one part to the next, and a narrow table of the parts' ends does it.
* A node is its depth and hash, and one aggregation counts all nodes. Below the last node
  that a conversation shares with another one lies its *tail*, whose nodes need no tree:
  one member, one leaf, nothing saved.
* Consecutive shared nodes with the same members make an *edge*, named by its smallest
  member and number of members. Each edge is written once, with the path of its smallest
  member, so a path is at most as long as the square root of twice the number of turns.

Paths are sorted over the cluster; each task is a *shard* and encodes its edges as balanced
parentheses. All tails below one edge are one leaf pair that counts for so many.
``findclose``, by minima and maxima of the excess in blocks, delimits each subtree; the rank
of leaf pairs counts its leaves, and cumulative arrays give what it saves. Edges on the
first and the last path of a shard (its spines) may go on in other shards: each shard adds
what lies in it, and an edge's own saving and its place among its parent's children count
in the one shard that has its smallest member.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, stage, tidy

PRIME = (1 << 61) - 1
#: Parentheses in a block of the excess directory.
EXCESS_BLOCK = 256
#: Characters of joined numbers in one row, before they are hashed.
CHUNK_CHARS = 60_000
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


class Parentheses:
    """Balanced parentheses with a directory of the least and greatest excess of each block."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens.astype(bool)
        self.excess = np.cumsum(np.where(self.opens, 1, -1))
        n = len(opens)
        blocks = max(1, -(-n // EXCESS_BLOCK))
        width = 1 << (blocks - 1).bit_length()
        cuts = np.arange(0, max(n, 1), EXCESS_BLOCK)
        # a heap: node i has the children 2 i and 2 i + 1
        self.least, self.most = np.full(2 * width, n + 1), np.full(2 * width, -1)
        if n:
            self.least[width : width + blocks] = np.minimum.reduceat(self.excess, cuts)
            self.most[width : width + blocks] = np.maximum.reduceat(self.excess, cuts)
        for i in range(width - 1, 0, -1):
            self.least[i] = min(self.least[2 * i], self.least[2 * i + 1])
            self.most[i] = max(self.most[2 * i], self.most[2 * i + 1])
        self.width = width
        leaf = np.zeros(n, np.int64)
        leaf[:-1] = self.opens[:-1] & ~self.opens[1:]
        self.leaf = leaf.astype(bool)

    def _has(self, node: int, target: int) -> bool:
        return self.least[node] <= target <= self.most[node]

    def findclose(self, at: int) -> int:
        """The place of the parenthesis that closes the one at ``at``: the next with one less excess."""
        target = self.excess[at] - 1
        block = at // EXCESS_BLOCK
        inside = np.flatnonzero(self.excess[at + 1 : (block + 1) * EXCESS_BLOCK] == target)
        if len(inside):
            return at + 1 + int(inside[0])
        node = self.width + block
        while node & 1 or not self._has(node + 1, target):  # up, until a right sibling has it
            node >>= 1
            if not node:
                raise ValueError("parentheses are not balanced")
        node += 1
        while node < self.width:
            node = 2 * node if self._has(2 * node, target) else 2 * node + 1
        first = (node - self.width) * EXCESS_BLOCK
        return first + int(np.flatnonzero(self.excess[first : first + EXCESS_BLOCK] == target)[0])

    def rank(self, weight: np.ndarray) -> np.ndarray:
        """Cumulative weights of the leaf pairs, by the place of their opening."""
        return np.cumsum(np.where(self.leaf, weight, 0))


class Shard:
    """Edges of consecutive paths. A path is a list of (members, conv_id, own), where ``own`` is
    None or, in the first path that has the edge, (saved here, tails below, members that end here)."""

    def __init__(self):
        self.opens: list[bool] = []
        self.count: list[int] = []  # leaves that a pair stands for
        self.saved: list[int] = []
        self.edges: list[list] = []  # [members, conv_id, owned, children, parent, place, last path]
        self.stack: list[int] = []
        self.first: set[int] = set()
        self.paths = 0
        self.unfinished = False  # the last edge has its children in another shard

    def _write(self, opens: bool, count: int = 0, saved: int = 0) -> None:
        self.opens.append(opens)
        self.count.append(count)
        self.saved.append(saved)

    def add(self, path: list[tuple]) -> None:
        keep = 0
        while keep < min(len(path), len(self.stack)) and tuple(self.edges[self.stack[keep]][:2]) == tuple(path[keep][:2]):
            keep += 1
        while len(self.stack) > keep:
            self._write(False)
            self.stack.pop()
        for members, conv_id, own in path[keep:]:
            parent = self.edges[self.stack[-1]] if self.stack else None
            self.stack.append(len(self.edges))
            edge = [members, conv_id, own is not None, 0, parent[1] if parent else None, len(self.opens)]
            self.edges.append(edge)
            if own is None:
                self._write(True)
                continue
            saved, tails, ends = own
            if parent:
                parent[3] += 1
            self._write(True, 1, saved)  # counts as a leaf if nothing comes below
            if tails:
                edge[3] += tails
                self._write(True, tails)
                self._write(False)
        if not self.paths:
            self.first = set(self.stack)
        self.paths += 1
        members, _, own = path[-1]
        self.unfinished = own is not None and not own[1] and own[2] < members

    def rows(self) -> Iterator[tuple]:
        """(members, conv_id, spine, owned, parent, children, leaves, saved) of each edge."""
        if not self.paths:
            return
        spine = self.first | set(self.stack)
        last, unfinished = set(self.stack), self.unfinished
        for _ in self.stack:
            self._write(False)
        tree = Parentheses(np.array(self.opens))
        leaves = tree.rank(np.array(self.count))
        saved = np.cumsum(np.array(self.saved))
        for i, (members, conv_id, owned, children, parent, at) in enumerate(self.edges):
            close = tree.findclose(at)
            before = at - 1
            n = int(leaves[close]) - (int(leaves[before]) if at else 0) - (unfinished and i in last)
            yield members, conv_id, i in spine, owned, parent, children, n, int(saved[close]) - (int(saved[before]) if at else 0)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _longs(*names: str) -> pa.Schema:
    return pa.schema([(n, pa.int64()) for n in names])


def _spec(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'boolean' if pa.types.is_boolean(f.type) else 'long'}" for f in schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns)))


def _emit(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 10_000:
            yield _batch(held, schema)
            held = []
    yield _batch(held, schema)


def _power(base: int, n: int) -> int:
    return pow(base, n, PRIME)


_SCANNED = pa.schema([*_longs("part", "conv", "pos", "p1", "p2", "cum", "chars"), ("ends_part", pa.bool_())])
_PLACED = _longs("conv", "pos", "p1", "p2", "cum", "chars")
_NODE_ROWS = pa.schema([*_longs("conv", "depth", "n1", "n2", "cum", "chars"), ("end", pa.bool_())])


def _placed_turns(turns: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """``conv, pos, p1, p2, cum, chars`` of each turn: its number in the conversation, the hash
    of all turns so far and their code points."""
    order = ["conv", F.asc_nulls_first("turn"), "role", "t1", "t2"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)

    @tidy
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def found() -> Iterator[tuple]:
            last = None
            for conv, t1, t2, chars in _rows(batches):
                if last is not None and last[1] == conv:
                    yield (*last, False)
                    _, _, pos, p1, p2, cum, _ = last
                else:
                    if last is not None:
                        yield (*last, True)
                    pos = p1 = p2 = cum = 0
                last = part, conv, pos + 1, (p1 * bases[0] + t1) % PRIME, (p2 * bases[1] + t2) % PRIME, cum + chars, chars
            if last is not None:
                yield (*last, True)

        return _emit(found(), _SCANNED)

    rows = stage(dealt.select("conv", "t1", "t2", "chars").mapInArrow(scan, _spec(_SCANNED)), "turns")
    # a conversation in several parts: what the parts before hold
    ends = rows.where("ends_part").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "pos", "p1", "p2", "cum"))).alias("ends"))
    carried = _longs("conv", "part", "b_pos", "b1", "b2", "b_cum")

    @tidy
    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv, ends in _rows(batches):
                pos = p1 = p2 = cum = 0
                for end in ends:
                    if pos:
                        yield conv, end["part"], pos, p1, p2, cum
                    p1 = (p1 * _power(bases[0], end["pos"]) + end["p1"]) % PRIME
                    p2 = (p2 * _power(bases[1], end["pos"]) + end["p2"]) % PRIME
                    pos, cum = pos + end["pos"], cum + end["cum"]

        return _emit(found(), carried)

    before = ends.where(F.size("ends") > 1).mapInArrow(carry, _spec(carried))
    before = stage(before, "parts")  # at most one row for each part but the first

    @tidy
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv, pos, p1, p2, cum, chars, b_pos, b1, b2, b_cum in _rows(batches):
                if b_pos:
                    p1 = (p1 + b1 * _power(bases[0], pos)) % PRIME
                    p2 = (p2 + b2 * _power(bases[1], pos)) % PRIME
                    pos, cum = pos + b_pos, cum + b_cum
                yield conv, pos, p1, p2, cum, chars

        return _emit(found(), _PLACED)

    joined = rows.join(F.broadcast(before), ["conv", "part"], "left")
    return stage(joined.select("conv", "pos", "p1", "p2", "cum", "chars", "b_pos", "b1", "b2", "b_cum").mapInArrow(place, _spec(_PLACED)), "placed-turns")


def _node_rows(placed: DataFrame, bases: tuple[int, int], group: int, most: int) -> DataFrame:
    """``conv, depth, n1, n2, cum, chars, end``: the nodes on the path of each rebuilt conversation."""
    start = F.struct("pos", "p1", "p2", "cum", "chars")
    convs = placed.groupBy("conv").agg(
        F.max("pos").alias("turns"), F.sort_array(F.collect_list(F.when(F.col("pos") < most, start))).alias("starts")  # at most most - 1
    )
    heads = convs.where(F.col("conv") % group == 0).select(F.col("conv").alias("head"), F.col("starts").alias("first"))
    h = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(most)).cast("long")
    convs = convs.withColumn("head", F.col("conv") - F.col("conv") % group).withColumn("h", h).join(heads, "head", "left")
    first = F.slice(F.coalesce("first", F.array().cast(convs.schema["starts"].dataType)), 1, F.col("h").cast("int"))
    convs = convs.withColumn("first", F.when(F.col("h") > 0, first).otherwise(F.array().cast(convs.schema["starts"].dataType)))
    convs = convs.withColumn("from", F.size("first").cast("long")).withColumn("depth", F.col("from") + F.greatest(F.lit(0), F.col("turns") - F.col("h")))
    last, own = F.try_element_at("first", F.lit(-1)), F.when(F.col("h") > 0, F.try_element_at("starts", F.greatest(F.lit(1), F.col("h")).cast("int")))
    zero = F.lit(0).cast("long")
    convs = convs.select(
        "conv", "h", "from", "depth", "first",
        *[F.coalesce(last[c], zero).alias(f"a_{c}") for c in ("p1", "p2", "cum")], *[F.coalesce(own[c], zero).alias(f"o_{c}") for c in ("p1", "p2", "cum")],
    )
    convs = stage(convs, "conversations")
    roots = convs.select("conv", zero.alias("depth"), zero.alias("n1"), zero.alias("n2"), zero.alias("cum"), zero.alias("chars"), (F.col("depth") == 0).alias("end"))
    heads = convs.select("conv", "depth", F.explode("first").alias("t")).select(
        "conv", F.col("t.pos").alias("depth"), F.col("t.p1").alias("n1"), F.col("t.p2").alias("n2"), "t.cum", "t.chars", (F.col("t.pos") == F.col("depth")).alias("end")
    )

    @tidy
    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv, pos, p1, p2, cum, chars, h, first, depth, a1, a2, a_cum, o1, o2, o_cum in _rows(batches):
                k = pos - h  # turns after the shared ones
                n1 = (p1 + (a1 - o1) * _power(bases[0], k)) % PRIME
                n2 = (p2 + (a2 - o2) * _power(bases[1], k)) % PRIME
                yield conv, first + k, n1, n2, cum + a_cum - o_cum, chars, first + k == depth

        return _emit(found(), _NODE_ROWS)

    own = placed.join(convs.drop("first"), "conv").where(F.col("pos") > F.col("h")).select(
        "conv", "pos", "p1", "p2", "cum", "chars", "h", "from", "depth", "a_p1", "a_p2", "a_cum", "o_p1", "o_p2", "o_cum"
    )
    return stage(roots.unionByName(heads).unionByName(own.mapInArrow(rebuild, _spec(_NODE_ROWS))), "node-rows")


_EDGES = pa.schema([*_longs("n", "mc"), ("spine", pa.bool_()), ("owned", pa.bool_()), *_longs("parent", "children", "leaves", "saved")])


def _subtrees(paths: DataFrame, root: tuple[int, int]) -> DataFrame:
    """``n, mc, parent, children, leaves, saved`` of each edge, from shards of sorted ``paths`` (key, path)."""
    dealt = paths.repartitionByRange("key").sortWithinPartitions("key").select("path")

    @tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for (path,) in _rows(batches):
            steps = [(e["n"], e["mc"], None if e["saved"] is None else (e["saved"], e["tails"], e["ends"])) for e in path]
            if steps[0][:2] != root:
                steps.insert(0, (*root, None))
            shard.add(steps)
        yield from _emit(shard.rows(), _EDGES)

    edges = stage(dealt.mapInArrow(encode, _spec(_EDGES)), "edges")
    columns = ["n", "mc", "parent", "children", "leaves", "saved"]
    spines = edges.where("spine").groupBy("n", "mc").agg(
        F.max(F.when(F.col("owned"), F.col("parent"))).alias("parent"), *[F.sum(c).alias(c) for c in columns[3:]]
    )
    return edges.where("NOT spine").select(columns).unionByName(spines.select(columns))


def _member_digests(ends: DataFrame) -> DataFrame:
    """``mc, n, sha``: the SHA-256 of the joined numbers ``conv`` of each (mc, n). They are joined
    to long rows where they lie sorted, over the cluster; only those rows meet per edge."""
    order = ["mc", "n", "conv"]
    chunks = pa.schema([*_longs("mc", "n", "first"), ("text", pa.string())])

    @tidy
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, held, size = None, None, [], 0
        for mc, n, conv in _rows(batches):
            if (mc, n) != now or size > CHUNK_CHARS:
                if held:
                    yield _batch([(*now, first, ",".join(held))], chunks)
                now, first, held, size = (mc, n), conv, [], 0
            held.append(str(conv))
            size += len(held[-1]) + 1
        if held:
            yield _batch([(*now, first, ",".join(held))], chunks)

    @tidy
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        schema = pa.schema([*_longs("mc", "n"), ("sha", pa.string())])
        for mc, n, _, text in _rows(batches):
            if (mc, n) == now:
                state.update(b"," + text.encode())
                continue
            if state:
                yield _batch([(*now, state.hexdigest())], schema)
            now, state = (mc, n), hashlib.sha256(text.encode())
        if state:
            yield _batch([(*now, state.hexdigest())], schema)

    joined = ends.select(order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "mc long, n long, first long, text string")
    return joined.repartition("mc", "n").sortWithinPartitions("mc", "n", "first").mapInArrow(digest, "mc long, n long, sha string")


def prefix_trie(
    rows: DataFrame, group: int = 100, most: int = 6, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The nodes of the trie of all conversations, each rebuilt: its first turns, crc32 of its
    decimal number modulo ``most`` of them, are those of conversation c - c % ``group`` (all if it
    has fewer, none if there is none), then come its own turns after so many.

    Turns come by ``turn`` (null first), ties by role, then by a digest of role and text; repeated
    rows are turns each. A null role or text is empty; rows without a conversation number
    belong to none and are left out. Returns one row per node: ``conv_id`` (the smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (over the
    subtree, the members but one of each node times the code points of its last text) and
    ``ends_sha256`` of the ascending, comma-joined numbers of the members that end there.
    Other columns are not read; an empty table has no node."""
    ship_package(rows.sparkSession)
    bases = tuple(secrets.randbelow(PRIME >> 1) + (PRIME >> 2) for _ in range(2))
    r, t = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.char_length(r).cast("string"), F.lit(":"), r, t), 256)
    turns = rows.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), r.alias("role"), F.char_length(t).cast("long").alias("chars"),
        *[(F.conv(F.substring(digest, i, 15), 16, 10).cast("long") + 1).alias(c) for c, i in (("t1", 1), ("t2", 16))],
    )
    found = _node_rows(_placed_turns(turns, bases), bases, group, most)
    name = ["depth", "n1", "n2"]
    nodes = found.groupBy(*name).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("mc"), F.max("cum").alias("cum"), F.max("chars").alias("chars"), F.max("end").alias("end")
    )
    nodes = stage(nodes, "nodes")
    top = nodes.where("depth = 0").select("n", "mc").first()
    root = (top["n"], top["mc"]) if top else (0, 0)
    shared = found.where("depth > 0").join(nodes.where("n > 1 AND depth > 0").select(*name, "n", "mc"), name).select("conv", "depth", "n", "mc")
    shared = stage(shared, "shared-nodes")
    # where each conversation leaves the shared part, and whether it ends there
    lengths = found.where("end").select("conv", F.col("depth").alias("length"))
    left = lengths.join(shared.groupBy("conv").agg(F.max("depth").alias("leaves_at"), F.max_by(F.struct("n", "mc"), "depth").alias("e")), "conv", "left")
    left = stage(left.select(
        "conv", F.coalesce("e.n", F.lit(root[0])).cast("long").alias("n"), F.coalesce("e.mc", F.lit(root[1])).cast("long").alias("mc"),
        F.coalesce("leaves_at", F.lit(0)).cast("long").alias("leaves_at"), (F.col("length") == F.coalesce("leaves_at", F.lit(0))).alias("ends"),
    ), "leavings")
    below = left.groupBy("n", "mc").agg(F.sum((~F.col("ends")).cast("long")).alias("tails"), F.sum(F.col("ends").cast("long")).alias("ends"))
    edges = nodes.where("n > 1").groupBy("n", "mc").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.min(F.col("cum") - F.col("chars")).alias("above"), F.max("cum").alias("cum")
    )
    zero = F.lit(0).cast("long")
    edges = stage(edges.join(below, ["n", "mc"], "left").select(
        "n", "mc", "top", "bottom", "above", ((F.col("n") - 1) * (F.col("cum") - F.col("above"))).alias("own"),
        F.coalesce("tails", zero).alias("tails"), F.coalesce("ends", zero).alias("ends"),
    ), "edge-facts")
    # the path of each edge's smallest member; the facts of an edge are with that member only
    facts = ["saved", "tails", "ends"]
    steps = shared.select("conv", "n", "mc", *[F.lit(None).cast("long").alias(c) for c in facts])
    steps = steps.unionByName(edges.select(F.col("mc").alias("conv"), "n", "mc", F.col("own").alias("saved"), "tails", "ends"))
    steps = steps.groupBy("conv", "n", "mc").agg(*[F.max(c).alias(c) for c in facts])
    paths = steps.groupBy("conv").agg(F.collect_list(F.struct((-F.col("n")).alias("turn"), "n", "mc", *facts)).alias("path"))
    paths = paths.where(F.exists("path", lambda e: e["saved"].isNotNull())).select(F.sort_array("path").alias("path"))
    # the child with the smallest member comes first, so the row that has an edge's facts is the edge's first
    step = lambda n, mc: F.concat(F.lpad(F.hex(mc.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"), F.lpad(F.hex(n), 16, "0"))
    key = F.array_join(F.transform("path", lambda e: step(e["n"], e["mc"])), "")
    # a path that does not begin with the root's edge has it in front
    start = step(*[F.lit(x).cast("long") for x in root])
    key = F.when(F.col("path")[0]["n"] == root[0], key).otherwise(F.concat(start, key))
    trees = _subtrees(paths.select(key.alias("key"), "path"), root)
    known = stage(edges.join(trees, ["n", "mc"]), "subtrees")
    members = _member_digests(left.where(F.col("ends") & (F.col("n") > 1)))
    known = known.join(members, ["n", "mc"], "left")
    at = nodes.where("n > 1").select("depth", "n", "mc", F.col("cum").alias("so_far"), "chars").join(known, ["n", "mc"])
    inner = at.select(
        F.col("mc").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("top"), F.col("parent")).otherwise(F.col("mc")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(F.col("depth") == F.col("bottom"), F.col("children")).otherwise(F.lit(1)).alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("saved") - (F.col("n") - 1) * (F.col("so_far") - F.col("chars") - F.col("above"))).alias("saved_tokens"),
        F.coalesce(F.when(F.col("depth") == F.col("bottom"), F.col("sha")), F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
    begins = left.where(~F.col("ends")).select(F.col("conv").alias("mc"), (F.col("leaves_at") + 1).alias("depth"), F.col("mc").alias("parent"))
    tails = nodes.where("n = 1").join(begins, ["mc", "depth"], "left").select(
        F.col("mc").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "mc")).alias("parent_conv_id"), F.lit(1).alias("n_convs"),
        F.when(F.col("end"), 0).otherwise(1).alias("n_children"), F.lit(1).alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("end"), F.sha2(F.col("mc").cast("string"), 256)).otherwise(F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
    return inner.unionByName(tails).select(
        "conv_id", "depth", "parent_conv_id", *[F.col(c).cast("long").alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], "ends_sha256"
    )
