import random

import numpy as np
import pytest

from linkloom.llm import decontaminate as dc


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(r.randint(2, 9))) for _ in range(n))


def edited(r, text, k):
    t = list(text)
    for _ in range(k):
        at = r.randrange(len(t))
        t[at : at + r.choice([0, 1])] = r.choice([[], [r.choice("xyz")]])
    return "".join(t)


def least_edits(x, p):
    """Edits of the best region of x for the passage p: the whole table."""
    row = np.zeros(len(x) + 1, np.int64)
    lanes = np.arange(len(x) + 1)
    for i, c in enumerate(p):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (x != c), row[1:] + 1)
        row = np.minimum.accumulate(new - lanes) + lanes
    return int(row.min())


def brute(texts, items, budget):
    index = dc.Index(items, budget)
    out = {}
    for t, text in enumerate(texts):
        x, _ = dc.normalise(text or "")
        for p, passage in enumerate(index.passages):
            e = least_edits(x, passage)
            if e <= index.edits[p]:
                out.setdefault((t, int(index.item[p])), []).append(e)
    return {k: (len(v), min(v)) for k, v in out.items()}


@pytest.mark.parametrize("budget", [dc.Budget(), dc.Budget(q=5, rate=0.15, passage=60, step=20)])
def test_no_region_within_the_budget_is_lost(budget):
    r = random.Random(4)
    items = [(i, prose(r, r.choice([3, 6, 15, 30, 60]))) for i in range(25)] + [(90, "ab " * 40), (91, "short"), (92, "")]
    texts = [None, "", "x", "ab " * 300]
    for _ in range(120):
        item = r.choice(items)[1]
        cut = item[r.randint(0, len(item) // 3) :] if r.random() < 0.3 else item
        k = int(len(cut) * r.choice([0, 0.03, 0.08, 0.1, 0.13, 0.2]))
        texts.append(prose(r, r.randint(0, 40)) + r.choice(["", " ", "\n"]) + (edited(r, cut, k).upper() if cut else "") + "  " + prose(r, r.randint(0, 20)))
    got = {(h[0], h[1]): (h[2], h[4]) for h in dc.search(texts, dc.Index(items, budget))}
    assert got == brute(texts, items, budget) and len(got) > 40


def test_places_and_very_long_texts(monkeypatch):
    r = random.Random(6)
    item = prose(r, 40)
    index = dc.Index([(3, item)], dc.Budget())
    text = prose(r, 30) + " ... " + item.upper().replace(" ", ",  ") + " ! " + prose(r, 30)
    (_, _, matched, passages, edits, start, end), = dc.search([text], index)
    assert matched == passages and edits == 0
    assert text[start:end].lower().replace(",  ", " ") == item
    monkeypatch.setattr(dc, "PIECE_CHARS", 1000)
    long = [prose(r, 900), prose(r, 200) + " " + item + " " + prose(r, 900), prose(r, 333) + " " + edited(r, item, 9)]
    assert {h[0] for h in dc.search(long, index)} == {1, 2}
    for cut in range(0, 1500, 97):  # wherever the pieces are cut
        assert len(dc.search(["q" * cut + " " + item + " " + prose(r, 300)], index)) == 1


def test_half_passages_of_neighbouring_texts_do_not_match():
    r = random.Random(7)
    item = prose(r, 16)
    texts = [prose(r, 20) + " " + item[: len(item) // 2], item[len(item) // 2 :] + " " + prose(r, 20)]
    assert dc.search(texts, dc.Index([(1, item)], dc.Budget())) == []


def test_sparse_hits_are_dropped_without_loss():
    r = random.Random(8)
    words = prose(r, 60).split()
    items = [(i, " ".join(r.choice(words) for _ in range(40))) for i in range(5)]  # one small vocabulary: many chance hits
    texts = []
    for _ in range(40):
        cut = r.choice(items)[1][r.randint(0, 60) :][: r.choice([70, 90, 200])]
        noise = [" ".join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(2)]
        texts.append(noise[0] + " " + edited(r, cut, r.randint(0, 9)) + " " + noise[1])
    index = dc.Index(items, dc.Budget())
    assert index.shared.min() > 1
    got = {(h[0], h[1]): (h[2], h[4]) for h in dc.search(texts, index)}
    assert got == brute(texts, items, dc.Budget()) and len(got) > 15


def test_every_run_of_80_characters_is_found():
    r = random.Random(9)
    for words in (14, 25, 50):
        item = prose(r, words)
        index = dc.Index([(1, item)], dc.Budget())
        n = min(80, len(item))
        texts = [prose(r, 12) + " " + item[a : a + n].strip() + " " + prose(r, 12) for a in range(len(item) - n + 1) if " " not in (item[a], item[a + n - 1])]
        assert {h[0] for h in dc.search(texts, index)} == set(range(len(texts)))


def test_short_items_are_found_as_whole_words(spark):
    r = random.Random(3)
    items = [(i, t) for i, t in enumerate(["Zürich", "42", "is 4 + 5 nine?", "Is 4, 5: NINE", "aa aa", "", "--", None, "q" * 23])]
    texts = [None, "", "zürich", "in ZÜRICH.", "zürichs", "x 142 420", "answer: 42", "4 5 is 4 5 nine", "is 4 5 ninety", "aa aa aa", "aaa aa", "q" * 24, "q" * 23]
    texts += [" ".join(r.choice(["aa", "42", "is", "4", "5", "nine", "zürich", "!"]) for _ in range(40)) for _ in range(50)]

    def folded(t):
        return " " + "".join(map(chr, dc.normalise(t or "")[0])) + " "

    want = {(t, i) for t, text in enumerate(texts) for i, item in items if folded(item).strip() and folded(item) in folded(text)}
    index = dc.Index([x for x in items if x[1] is not None], dc.Budget())
    got = dc.search_short(texts, index)
    assert {(h[0], index.ids[h[1]]) for h in got} == want and len(got) == len(want) and len(want) > 80
    assert dc.search_short(["so: Is 4, 5  nine!"], dc.Index(items[2:3], dc.Budget())) == [(0, 0, 1, 1, 0, 4, 17)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(x.doc_id, x.item_id) for x in dc.find_leaks(docs, bench, ["doc_id"]).collect()} == want
    assert {x.doc_id for x in dc.drop_leaks(docs, bench).collect()} == set(range(len(texts))) - {t for t, _ in want}


def test_jobs(spark, monkeypatch):
    monkeypatch.setattr(dc, "INDEX_CHARS", 600)
    r = random.Random(2)
    items = [(i, prose(r, 25)) for i in range(20)] + [(50, None), (None, prose(r, 25)), (7, "")]
    rows = [(i, prose(r, 60)) for i in range(40)] + [(100 + k, prose(r, 5) + " " + t + " " + prose(r, 9)) for k, (_, t) in enumerate(items) if t] + [(200, None), (201, "")]
    rows += [rows[40]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as item_id", "5 as start").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id")
    got = sorted((x.doc_id, x.item_id if x.item_id is not None else -1) for x in dc.find_leaks(docs, bench, ["doc_id"]).collect())
    assert got == sorted([(100 + k, i if i is not None else -1) for k, (i, t) in enumerate(items) if t] + [(100, 0)])
    left = dc.drop_leaks(docs, bench)
    assert sorted(x.doc_id for x in left.collect()) == [*range(40), 200, 201] and left.columns == docs.columns
    assert dc.find_leaks(docs.where("false"), bench, ["doc_id"]).count() == 0
    assert dc.find_leaks(docs, bench.where("false"), ["doc_id"]).count() == 0


def test_repetitive_texts_are_searched_in_bounded_runs(monkeypatch):
    r = random.Random(4)
    items = [(1, "0 " * 300), (2, prose(r, 40)), (3, "ab " * 60)]
    index = dc.Index(items, dc.Budget())
    texts = ["0 " * 3000, "ab " * 700 + items[1][1], prose(r, 300), "0 " * 30 + prose(r, 20) + "0 " * 45]
    whole = dc.search(texts, index)
    assert {(t, i) for t, i, *_ in whole} >= {(0, 0), (1, 2), (1, 1)}
    held = []
    bands = dc.Index._bands
    monkeypatch.setattr(dc.Index, "_bands", lambda self, n, at, found: held.append(int(self.count[found].sum())) or bands(self, n, at, found))
    monkeypatch.setattr(dc, "MEETINGS", 50_000)
    assert dc.search(texts, index) == whole
    assert len(held) > 10 and max(held) < 500_000  # 1.2 million pairs for the first text alone
