import random

import numpy as np
import pytest

from linkloom.llm import exchange, jaccard_join as jj
from linkloom.llm.components import components


def shingles(text, k=4):
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
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def corpus(seed, n=160):
    r = random.Random(seed)
    words = ["W%d" % i for i in range(300)] + ["é", "Ä"]
    text = lambda k: " ".join(r.choice(words) for _ in range(k))
    bases = [text(r.choice([5, 12, 40, 80, 150])) for _ in range(12)]
    passage = text(30)
    rows = []
    for i in range(n):
        kind = r.random()
        if kind < 0.6:
            w = r.choice(bases).split(" ")
            for _ in range(r.choice([0, 0, 1, 1, 2, 4, 8])):
                at = r.randrange(len(w))
                w[at : at + r.choice([0, 1])] = r.choice([[], [r.choice(words)], [r.choice(words).lower()]])
                w = w or ["x"]
            t = " ".join(w)
        elif kind < 0.8:
            t = text(r.randint(0, 20)) + " " + passage + "\n" + text(r.randint(0, 20))
        else:
            t = text(r.randint(0, 6))
        rows.append((i if r.random() < 0.95 else r.choice([None, 5]), t.upper() if r.random() < 0.2 else t))
    return rows + [(900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "ONE two"), (905, "two one"), (None, rows[0][1]), (2, rows[0][1])]


def grouped(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as class", "'x' as data")
    got = jj.similar_groups(df.repartition(4)).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr)


@pytest.mark.parametrize("seed", [1])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    assert grouped(spark, rows) == brute(rows)


def test_small_blocks_tiles_and_common_elements(spark, monkeypatch):
    monkeypatch.setattr(exchange, "PART_BYTES", 300)
    monkeypatch.setattr(jj, "COMMON", 400)
    monkeypatch.setattr(jj, "TILE", 3)
    rows = corpus(3)
    assert grouped(spark, rows) == brute(rows)
    assert grouped(spark, []) == []


def test_large_groups_of_copies_and_near_copies(spark):
    r = random.Random(8)
    base = ["b%d" % i for i in range(120)]
    rows = [(i, " ".join(base)) for i in range(400)]
    for i in range(400, 800):
        w = list(base)
        w[r.randrange(120)] = "x%d" % i
        rows.append((i, " ".join(w)))
    got = grouped(spark, rows)
    assert {x[2] for x in got} == {0} and len(got) == 800


def test_prefixes_meet_and_signatures_never_rule_out_a_link():
    r = np.random.default_rng(5)
    s = jj.Similarity()
    for _ in range(300):
        n = int(r.integers(1, 200))
        a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate((r.choice(a, max(1, int(len(a) * r.uniform(0.8, 1))), replace=False), r.integers(0, 1 << 63, int(r.integers(0, 1 + n // 8))).astype(np.uint64))))
        common = np.sort(r.choice(a, len(a) // 3, replace=False))
        if jj.linked(a, b, 85):
            assert set(jj.prefix_of(a, common, s).tolist()) & set(jj.prefix_of(b, common, s).tolist())
            bits = min(jj.signature_bits(len(a)), jj.signature_bits(len(b)))
            x, y = (jj.folded(jj.signature(v, jj.signature_bits(len(v))), bits) for v in (a, b))
            assert (x == jj.signature(a, bits)).all() and jj.may_link(x, len(a), y[None], np.array([len(b)]), 85).all()
        for per in (1, 8):
            p, q = (jj.signature(v, jj.signature_bits(len(v), per)) for v in (a, b))
            w = 64 * min(len(p), len(q))
            whole = jj.may_link(jj.folded(p, w), len(a), jj.folded(q, w)[None], np.array([len(b)]), 85)[0]
            assert whole == jj._may_link(len(a), p.tobytes(), len(b), q.tobytes(), 85) and (whole or not jj.linked(a, b, 85))


def test_bands_of_few_and_many_agree():
    r = np.random.default_rng(2)
    base = np.unique(r.integers(0, 1 << 63, 400).astype(np.uint64))
    sets = sorted((np.unique(np.concatenate((r.choice(base, int(r.integers(20, 400)), replace=False), r.integers(0, 1 << 63, 9).astype(np.uint64)))) for _ in range(150)), key=len)
    few, many = jj._Band(), jj._Band()
    few.FEW, many.FEW = 10**9, 0
    for i, v in enumerate(sets):
        bits = jj.signature(v, jj.signature_bits(len(v))).tobytes()
        got = many.partners(i, i % 5, len(v), bits, 85)
        need = few.partners(i, i % 5, len(v), bits, 85)
        assert set(need) <= set(got)  # the array folds to the smallest width, which rules out less
        assert all(j in need for j in range(i) if j % 5 != i % 5 and jj.linked(v, sets[j], 85))


def test_components(spark):
    r = random.Random(1)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(30)] + [(7, 2000 + i) for i in range(300)] + [(5000, 5000)]
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_group_stays(spark):
    r = random.Random(6)
    text = lambda n: " ".join("w%d" % r.randrange(10**6) for _ in range(n))
    one, other, third = text(60), text(60), text(60)
    rows = [(1, one), (5, one + " more"), (5, other), (None, third), (None, third), (None, third + " x"), (7, None), (7, ""), (None, None)]
    rows += [(9, text(50))] + [(20 + i, f"{third} y{i}") for i in range(len(rows) // 2)]
    schema = "doc_id long, text string, _none string, block string, n_chars long"
    df = spark.createDataFrame([(i, t, "clash", f"b{k}", k) for k, (i, t) in enumerate(rows)], schema)
    left = jj.keep_one_of_each_group(df.repartition(3), similarity=jj.Similarity(shingle=5, percent=80))
    assert left.columns == df.columns and left.schema == df.schema
    got = sorted(((x.doc_id, x.text) for x in left.collect() if x.doc_id is not None), key=repr)
    # 5 has two texts: only the near copy of 1 goes; of the group of the third text the smallest id stays
    assert got == sorted([(1, one), (5, other), (7, None), (7, ""), (9, rows[9][1]), (20, f"{third} y0")], key=repr)
    assert left.where("doc_id is null and text is null").count() == 1 and left.where("doc_id is null and text is not null").count() == 0
    assert jj.keep_one_of_each_group(df.where("false")).count() == 0
    copies = df.where("doc_id is null").unionByName(df.where("doc_id is null"))
    assert jj.keep_one_of_each_group(copies).where("text is not null").count() == 1
