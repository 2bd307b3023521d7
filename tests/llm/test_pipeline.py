import random

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from linkloom.llm import decontaminate, line_quality
from linkloom.llm.queries import tokenizer_file


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))


def shingles(t):
    w = t.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows, items):
    """doc_id -> token ids, stage by stage, in plain Python. Rows: (id, text)."""
    # 6: no line here is above a limit, so only the base rules reject
    docs = {}
    for i, t in rows:
        n, _, _, _, repeats, _, _ = line_quality.measure(t)
        if n >= 50 and 100 * repeats <= 50 * n:
            docs[i] = t
    # 8
    order = sorted(docs)
    root = {i: i for i in order}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {i: shingles(docs[i]) for i in order}
    for i in order:
        for j in order:
            both = len(sets[i] & sets[j])
            if j < i and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    docs = {i: docs[i] for i in order if find(i) == i}
    # 7
    first = {}
    for i in sorted(docs):
        raw = docs[i].encode()
        for s in range(len(raw) - 149):
            first.setdefault(raw[s : s + 150], i)
    for i in list(docs):
        raw = docs[i].encode()
        gone = [False] * len(raw)
        for s in range(len(raw) - 149):
            if first[raw[s : s + 150]] < i:
                gone[s : s + 150] = [True] * 150
        docs[i] = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
    docs = {i: t for i, t in docs.items() if t}
    # 5: verbatim passages only in this corpus
    docs = {i: t for i, t in docs.items() if not any(x.lower() in t.lower() for x in items)}
    library = Tokenizer.from_file(tokenizer_file())
    return {i: library.encode(t, add_special_tokens=False).ids for i, t in docs.items()}


def test_run_against_brute_force(spark, tmp_path):
    r = random.Random(3)
    items = [prose(r, 30) for _ in range(4)]
    passage = prose(r, 70)
    rows = [(i, prose(r, r.randint(40, 120))) for i in range(40)]
    rows += [(100 + i, rows[5][1]) for i in range(5)]
    for i in range(6):
        w = rows[7][1].split(" ")
        w[r.randrange(len(w))] = "é"
        rows.append((110 + i, " ".join(w)))
    rows += [(120 + i, prose(r, 60) + " " + passage + " é " + prose(r, 60)) for i in range(5)]
    rows += [(130 + i, prose(r, 60) + " " + x + " " + prose(r, 10)) for i, x in enumerate(items)]
    rows += [(140, None), (141, ""), (142, "same words here " * 40), (143, passage)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, block string"
    data = [(i, t, "en", "s%d" % (i % 3) if i % 11 else None, len(t or ""), "clash") for i, t in rows]
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(x.round_trip and x.n_tokens * 4 == len(x.ids) for x in got)
    want = brute(rows, items)
    assert {x.doc_id: np.frombuffer(x.ids, "<u4").tolist() for x in got} == want
    assert 7 in want and 120 in want and 100 not in want and 130 not in want

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs, str(tmp_path)).columns == docs.columns
        assert function(spark, docs.where("false"), str(tmp_path)).count() == 0
    assert corpus_pipeline.encode(spark, docs.where("false"), str(tmp_path)).count() == 0


def test_benchmark_budget_is_the_default():
    assert decontaminate.Budget().edits(120) == 12


def test_frequent_lines_edited_leaks_and_rows_without_an_id(spark, tmp_path):
    r = random.Random(11)
    line, item = prose(r, 9), prose(r, 40)
    bodies = [prose(r, 70) for _ in range(40)]
    rows = [(i, f"{line}\n{t}", "menu") for i, t in enumerate(bodies)]
    edited = list(item)
    for at in (30, 90, 150):
        edited[at] = "z"
    rows.append((100, prose(r, 60) + " " + "".join(edited) + " " + prose(r, 20), "leak"))
    rows += [(None, prose(r, 60), "x")] + [(5, prose(r, 60), "y")]  # a second text under one id
    rows += [(None, rows[-2][1], "x")] * 3
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = Tokenizer.from_file(tokenizer_file())
    ids = lambda t: library.encode(t, add_special_tokens=False).ids
    want = [(i, ids(t)) for i, t in enumerate(bodies)] + [(5, ids(rows[42][1])), (None, ids(rows[41][1]))]
    assert sorted(((x.doc_id, np.frombuffer(x.ids, "<u4").tolist()) for x in got), key=repr) == sorted(want, key=repr)
