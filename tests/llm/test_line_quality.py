import random
import re
from collections import Counter, defaultdict

from linkloom.llm import line_quality as lq


def brute(text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), dups, len(covered)


def test_base_measures():
    r = random.Random(2)
    texts = [None, "", " \n\t", "a", "a a a a", "# * $ [ ] %&|<>", "x y z\nx y z\n\n\nx y z \nq", "é\x0b\xa0\x85 1\x0c2", "a b " * 50]
    texts += ["".join(r.choice(["a", "b", "c ", " ", "\n", "é", "#", "\t", "\r"]) for _ in range(r.randint(0, 300))) for _ in range(300)]
    for t in texts:
        assert lq.measure(t)[:5] == brute(t), t


def test_normalised_lines():
    assert lq.line_hash(b" Page 12 of\t99 ") == lq.line_hash(b"page 34 OF 00") != lq.line_hash(b"page 3 of 00")
    assert lq.line_hash(b" \t") is None


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))


def corpus():
    r = random.Random(1)
    rows, boiler = [], [prose(r, 12), prose(r, 30)]
    for i in range(60):  # prose with boilerplate
        rows.append((i, "a", "\n".join([prose(r, 40), boiler[0], prose(r, 40)])))
    for i in range(60, 100):  # mostly boilerplate
        rows.append((i, "a", "\n".join([boiler[0], boiler[1], *(prose(r, 2) for _ in range(10))])))
    copy = "\n".join(prose(r, 40) for _ in range(4))
    rows += [(i, "b", copy) for i in range(100, 200)]  # copies of one clean text
    rows += [(i, "b", prose(r, 80)) for i in range(200, 210)]
    rows += [(300, None, prose(r, 90)), (301, None, None), (302, "c", ""), (303, "c", "w " * 100), (303, "c", prose(r, 60))]
    return rows, boiler


def test_frequent_lines_go_and_depleted_documents_fail(spark):
    rows, boiler = corpus()
    df = spark.createDataFrame([(i, t, h) for i, h, t in rows], "doc_id long, text string, source string").selectExpr("*", "1 as n_words", "2 as _line", "3 as n_chars")
    got = defaultdict(list)
    for x in lq.judge_documents(df.repartition(3), ["doc_id"]).collect():
        got[x.doc_id].append(x)
    assert all(got[i][0].kept and got[i][0].words_left == got[i][0].n_words - 12 for i in range(60))
    assert all(not got[i][0].kept and not got[i][0].base_failed and got[i][0].words_left == 20 for i in range(60, 100))
    assert all(got[i][0].kept and got[i][0].words_left == got[i][0].n_words for i in range(100, 210))
    assert got[300][0].kept and got[301][0].base_failed and got[302][0].base_failed and len(got[303]) == 2
    assert sorted(x.kept for x in got[303]) == [False, True]

    clean = {x.doc_id: x for x in lq.clean_documents(df).collect()}
    assert set(clean) == {i for i, xs in got.items() if any(x.kept for x in xs)}
    assert clean[5].text == rows[5][2].replace(boiler[0] + "\n", "") and clean[5].n_chars == len(clean[5].text)
    assert clean[100].text == rows[100][2] and clean[100]._line == 2
    assert lq.clean_documents(df).columns == df.columns


def test_a_block_of_frequent_lines_goes_whole(spark):
    r = random.Random(5)
    rows = []
    for h in range(3):
        menu = [prose(r, 4) for _ in range(20)]
        rows += [(f"h{h}", "\n".join([*menu, prose(r, n)])) for n in [120] * 100 + [30] * 100]  # 80 words of menu each
        rows += [(f"h{h}", rows[-1][1])] * 50  # copies of a document count once
        rows += [(f"h{h}", "\n".join(prose(r, 50) for _ in range(2)))] * 100
    df = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    for x in lq.judge_documents(df.repartition(4), ["doc_id"]).collect():
        n = x.n_words
        assert (x.words_left, x.kept) == {200: (120, True), 110: (30, False), 100: (100, True)}[n]


def test_the_limit_counts_distinct_documents_on_both_sides(spark):
    r = random.Random(9)
    line, copy = prose(r, 12), prose(r, 60)
    rows = [(i, "\n".join([line, prose(r, 60)])) for i in range(40)] + [(i, prose(r, 60)) for i in range(40, 50)]
    rows += [(i, copy) for i in range(100, 1100)]  # copies of one text do not make the line rare
    rows.append((2000, " ".join(prose(r, 20) for _ in range(4000))))  # a very long text
    df = spark.createDataFrame([(i, t, "h") for i, t in rows], "doc_id long, text string, source string")
    got = {x.doc_id: x.words_left - x.n_words for x in lq.judge_documents(df, ["doc_id"]).collect()}
    assert all(got[i] == (-12 if i < 40 else 0) for i in got)


def test_sql_is_the_same_rule(spark, tmp_path):
    import duckdb

    from linkloom.llm.queries import OP6_SQL, op6_line_quality

    r = random.Random(7)
    menu = [prose(r, 4) for _ in range(20)]
    rows = [(i, "\n".join([*menu, prose(r, 56)]), "h") for i in range(200)] + [(200 + i, prose(r, 70), "h" if i % 2 else None) for i in range(60)]
    rows += [(300 + i, rows[0][1], "h") for i in range(30)] + [(400, None, None), (401, "", "h"), (402, "\n\n", "x")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op6_line_quality(spark, str(tmp_path))
    sql = duckdb.connect()
    sql.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    need = sql.sql(OP6_SQL)
    key = lambda x: (x[0], repr(x))
    assert sorted(map(tuple, got.select(need.columns).collect()), key=key) == sorted(need.fetchall(), key=key)
    assert {x.words_left for x in got.where("doc_id < 200").collect()} == {56}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert lq.judge_documents(df, ["doc_id"]).collect() == [] and lq.clean_documents(df).collect() == []
