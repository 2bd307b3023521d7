import random

import numpy as np
import pytest

from linkloom.llm import exchange, minhash as mh


def shingles(text, k=5):
    w = [x.lower() for x in (text or "").encode().split()]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = ((d, len(s), least.get(find(i)), d == least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets)))
    return sorted(out, key=repr)


def corpus(seed, n=200):
    r = random.Random(seed)
    words = ["W%d" % i for i in range(300)] + ["é", "Ä"]
    text = lambda k: " ".join(r.choice(words) for _ in range(k))
    bases = [text(r.choice([6, 12, 40, 80, 150])) for _ in range(10)]
    rows = []
    for i in range(n):
        if r.random() < 0.7:
            w = r.choice(bases).split(" ")
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                at = r.randrange(len(w))
                w[at : at + r.choice([0, 1])] = r.choice([[], [r.choice(words)], [r.choice(words).lower()]])
                w = w or ["x"]
            t = " ".join(w)
        else:
            t = text(r.randint(0, 7))
        rows.append((i if r.random() < 0.95 else r.choice([None, 5]), t.upper() if r.random() < 0.2 else t))
    long = " ".join("long%d" % (i % 9000) for i in range(12000))
    return rows + [
        (900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "ONE two"), (905, "two one"),
        (None, rows[0][1]), (2, rows[0][1]), (2, rows[0][1]), (906, long), (907, long + " end"),
    ]


def grouped(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as class", "'x' as key", "3L as root")
    got = mh.near_duplicate_groups(df.repartition(4)).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=repr)


@pytest.mark.parametrize("slice_rows", [256, 3])
def test_against_brute_force(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(mh, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 20_000)
    rows = corpus(slice_rows)
    assert grouped(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert grouped(spark, []) == []


def test_large_group_of_near_copies_of_one_base(spark):
    r = random.Random(8)
    base = ["b%d" % i for i in range(150)]
    rows = [(i, " ".join(base)) for i in range(300)]
    for i in range(300, 700):  # two edits each: no link between most of them but through the base
        w = list(base)
        for _ in range(2):
            w[r.randrange(150)] = "x%d" % r.randrange(10**6)
        rows.append((i, " ".join(w)))
    got = grouped(spark, rows)
    assert {x[2] for x in got} == {0} and sum(x[3] for x in got) == 1


def test_estimate_is_corrected_for_chance_and_never_rules_out_a_link():
    class Values:
        pass

    r = np.random.default_rng(5)
    for bits in (1, 2, 4, 8):
        how = mh.MinHash(bits=bits)
        errors = []
        for t in np.linspace(0, 1, 60):
            n, both = 400, round(400 * 2 * t / (1 + t))
            pool = np.unique(r.integers(0, 1 << 63, 900).astype(np.uint64) * np.uint64(2))
            a, b = pool[:n], np.sort(np.concatenate((pool[:both], pool[n : 2 * n - both])))
            sets = Values()
            sets.values, sets.sizes = np.concatenate((a, b)), np.array([n, n])
            sets.ends = np.cumsum(sets.sizes)
            least = mh.minima(sets, 3 + int(1000 * t), how.minima)
            x, y = mh.packed(least, bits)
            same = int((least[0] & (1 << bits) - 1 == least[1] & (1 << bits) - 1).sum())
            assert mh.agreeing(x, y[None], how)[0] == same
            real = both / (2 * n - both)
            errors.append(how.similarity(same) - real)
            if real >= 0.85:
                assert mh.may_link(x, n, y[None], np.array([n]), how)[0]
        assert abs(np.mean(errors)) < 0.05 and np.std(errors) < 0.2
        assert 0 < how.least_agreeing() < how.minima * 0.95
