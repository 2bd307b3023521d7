import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, mining=hn.Mining()):
    rows = list(dict.fromkeys((i, y, tuple(v)) for i, y, v in rows if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)))
    q = [[math.floor(mining.scale * float(np.float32(x))) for x in v] for _, _, v in rows]
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for a, (i, y, _) in enumerate(rows):
        if i is None or i % 100:
            continue
        scored = [(sum(m * n for m, n in zip(q[a], q[b])), rows[b][0], rows[b][1]) for b in range(len(rows)) if b != a]
        for p, pid, _ in sorted((s for s in scored if s[2] == y), key=order)[: mining.positives]:
            fit = [s for s in scored if s[2] != y and mining.low_percent * p <= 100 * s[0] <= mining.high_percent * p]
            for k, (s, nid, _) in enumerate(sorted(fit, key=order)[: mining.negatives]):
                out.append((i, pid, k + 1, nid, p, s))
    return sorted(out, key=repr)


def mined(spark, rows, mining=hn.Mining()):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "'x' as data", "2 as ag", "3 as digest")
    got = hn.mine(df.repartition(3), F.col("vec_id") % 100 == 0, mining).collect()
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got), key=repr)


def vectors(seed, n=700, dims=20):
    r = np.random.default_rng(seed)
    centres = r.normal(0, 0.4, (6, dims))
    rows = []
    for i in range(n):
        v = (centres[r.integers(6)] + r.normal(0, 0.15, dims)).tolist()
        rows.append((i, int(r.integers(0, 4)) if r.random() < 0.8 else 0, v))
    for i in range(n, n + 150):  # very many ties
        rows.append((i, int(r.integers(0, 3)), centres[0].tolist()))
    rows += rows[:120] + rows[:5]  # repeated rows, anchors among them
    rows += [(100, 2, rows[3][2]), (None, 1, rows[7][2]), (None, 0, rows[7][2]), (10_000, None, rows[1][2]), (10_100, 1, None)]
    rows += [(10_200, 1, rows[2][2][:-1] + [None]), (10_300, 1, [math.nan] * dims), (10_400, 2, [math.inf] * dims)]
    rows += [(10_500, 1, []), (10_600, 1, rows[2][2][:5]), (10_601, 2, rows[4][2] + [0.5] * 30), (10_700, 3, [-9.5] * dims)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # several blocks, slabs and groups
        monkeypatch.setattr(hn, "BLOCK_ROWS", 40)
        monkeypatch.setattr(hn, "SLAB_BLOCKS", 3)
        monkeypatch.setattr(hn, "GROUP_ANCHORS", 4)
    rows = vectors(1)
    got, need = mined(spark, rows), brute(rows)
    assert len(need) > 100 and got == need


def test_empty_tables_and_no_anchor(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [0.5]), (2, 1, [0.5]), (3, 2, [0.4])]) == []
    assert mined(spark, [(0, None, [0.5]), (2, None, [0.5])]) == []


def test_scores_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="63 bits|too large"):
        mined(spark, [(0, 1, [1e12] * 9), (1, 1, [1e12] * 9)])


def test_lookups_are_inner_products():
    r = np.random.default_rng(3)
    for dims in (1, 7, 8, 9, 64, 70):
        for spread in (1, 100, 10**6):
            a, c = r.integers(-spread, spread + 1, (5, dims)), r.integers(-spread, spread + 1, (300, dims))
            block = hn.Block(hn.Block.pack(np.arange(300), np.zeros(300), np.zeros(300), c))
            anchors = hn.Anchors(hn.Anchors.pack(np.arange(5), np.zeros(5), np.zeros(5), a))
            longer = hn.Block(hn.Block.pack(np.arange(300), np.zeros(300), np.zeros(300), np.concatenate((c, c + 1), axis=1)))
            for i in range(5):
                assert (longer.scores(anchors.table(i, longer.groups)) == c @ a[i]).all()
                assert (block.scores(anchors.table(i, block.groups)) == c @ a[i]).all()
    assert [hn.bits_of(np.array([[x]])) for x in (0, 1, -1, -2, -3, 127, -128, 128)] == [1, 2, 1, 2, 3, 8, 8, 9]
