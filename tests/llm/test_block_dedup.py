import random
from collections import Counter

import pytest

from linkloom.llm import block_dedup, exchange


def brute(rows, length):
    count = Counter()
    texts = [(t or "").encode().split() for _, t in rows]
    for w in texts:
        count.update(tuple(w[s : s + length]) for s in range(len(w) - length + 1))
    out = []
    for (i, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if count[tuple(w[s : s + length])] > 1:
                gone[s : s + length] = [True] * length
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def corpus(seed):
    r = random.Random(seed)
    words = ["w%d" % i for i in range(40)] + ["é", " ", "Ж"]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passages = [text(r.randint(30, 90)) for _ in range(5)]
    rows = []
    for i in range(70):
        t = text(r.randint(0, 60))
        for _ in range(r.randint(0, 2)):
            p = r.choice(passages).split(" ")
            a = r.randint(0, 10)
            t += "\n\t " + " ".join(p[a:]) + "  " + text(r.randint(0, 40))
        rows.append((i if r.random() < 0.9 else None, t))
    return rows + [(100, None), (101, ""), (102, " \n"), (103, "a " * 200), (104, rows[0][1]), (104, rows[0][1]), (105, text(35))]


def removed(spark, rows, length=35):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' as kept", "1 as block", "2 as spans")
    got = block_dedup.remove_repeated_words(df.repartition(4), ["doc_id"], length).collect()
    for r in got:
        assert sum(s.last - s.first + 1 for s in r.spans) == r.n_removed
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=repr)


@pytest.mark.parametrize("length", [35, 4, 1])
def test_against_brute_force(spark, length):
    rows = corpus(length)
    assert removed(spark, rows, length) == brute(rows, length)


def test_many_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(exchange, "PART_BYTES", 500)
    rows = corpus(77)
    assert removed(spark, rows * 2) == brute(rows * 2, 35)
    assert removed(spark, []) == []


def test_hot_passage_and_long_text(spark):
    r = random.Random(3)
    passage = " ".join("p%d" % i for i in range(60))
    rows = [(i, f"x{i} " * 5 + passage + f" y{i}") for i in range(300)]
    rows.append((999, " ".join("u%d" % r.randrange(10**9) for _ in range(200_000)) + " " + passage))
    got = removed(spark, rows)
    assert all(x[2] == 60 for x in got)
