import hashlib
import random
import zlib

import numpy as np
import pytest

from linkloom.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, group=100, most=6):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        head = c - int(np.fmod(c, group))
        whole[c] = tuple(own.get(head, [])[:h] + turns[h:])
    members, ends = {}, {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    total = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        leaves = 0 if node in children else 1
        for kid in children.get(node, ()):
            leaves += total[kid][0]
            saved += total[kid][1]
        total[node] = leaves, saved
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children.get(n, ())), *total[n],
         hashlib.sha256(",".join(map(str, sorted(ends.get(n, ())))).encode()).hexdigest())
        for n, m in members.items()
    ) if members else []


def trie(spark, rows, parts=5):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as n", "2 as mc", "'x' as path", "3 as depth", "4 as h")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return sorted(tuple(r) for r in pt.prefix_trie(df.repartition(3)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def key(rows):
    return sorted(rows, key=repr)


def conversations(seed):
    r = random.Random(seed)
    role = lambda: r.choice(["user", "assistant", "assistant", None, ""])
    rows = []
    for c in [*range(0, 60), *range(95, 130), *range(200, 230), -1, -5, -150, 10**12, 10**12 + 7]:
        if c in (100, 205):
            continue  # an absent head
        mode = r.random()
        for t in range(r.choice([1, 1, 2, 3, 5, 8])):
            text = r.choice(["hi", "ho", "ä€😀", "", None]) if mode < 0.8 else "t%d" % r.randrange(1000)
            rows.append((c, r.choice([t, t, t, None, 0]), role() if mode < 0.5 else "user", text))
    rows += [(300 + i, t, "user", "same") for i in range(70) for t in range(7)]  # very many copies
    rows += [(900 + i, t, "user", "deep%d" % t) for i in range(30) for t in range(2 * i + 1)]  # a caterpillar
    rows += rows[:20] + [(None, 0, "user", "nobody"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("seed,parts", [(1, 5), (2, 40)])
def test_against_brute_force(spark, monkeypatch, seed, parts):
    monkeypatch.setattr(pt, "CHUNK_CHARS", 40)
    monkeypatch.setattr(pt, "EXCESS_BLOCK", 4)
    rows = conversations(seed)
    assert key(trie(spark, rows, parts)) == key(brute(rows))


def test_a_conversation_that_holds_a_third_of_all_rows(spark):
    rows = [(7, t, "user", "x%d" % t) for t in range(900)] + [(8, t, "user", "x%d" % t) for t in range(870)]
    rows += [(c, t, "user", "y%d" % (c * t)) for c in range(300, 400) for t in range(5)]
    assert key(trie(spark, rows, 16)) == key(brute(rows))


@pytest.mark.parametrize("rows", [[], [(5, 0, "user", "a")], [(5, 0, "user", "a"), (5, 1, None, None)], [(5, 0, "u", "a"), (6, 0, "u", "a")], [(None, 1, "u", "a")]])
def test_small_tables(spark, rows):
    assert key(trie(spark, rows, 2)) == key(brute(rows))


def test_findclose_and_ranks():
    r = random.Random(4)
    for n in (1, 2, 5, 700):
        opens, depth = [], 0
        while len(opens) < 2 * n or depth:
            up = depth == 0 or (len(opens) < 2 * n and r.random() < 0.55)
            opens.append(up)
            depth += 1 if up else -1
        tree = pt.Parentheses(np.array(opens))
        stack = []
        for i, up in enumerate(opens):
            if up:
                stack.append(i)
            else:
                assert tree.findclose(stack.pop()) == i
        leaf = [i for i in range(len(opens) - 1) if opens[i] and not opens[i + 1]]
        assert tree.rank(np.ones(len(opens), int))[-1] == len(leaf)
