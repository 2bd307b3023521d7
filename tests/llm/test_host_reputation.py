import re

from linkloom.llm import host_reputation as hr
from linkloom.llm.queries import URL_RULES


def judge(spark, pages, outcomes, rules=URL_RULES, **kw):
    p = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "'x' as host", "1 as rate", "2 as _found")
    o = spark.createDataFrame(outcomes, "page_id long, good boolean")
    return hr.judge_pages(p, o, rules, hr.ReputationSettings(**kw)).collect()


def test_urls_and_rules(spark):
    urls = {
        1: "https://WWW.Example.com/en/a?x=/b", 2: "http://example.com/en/b#/c", 3: "http://example.com", 4: "no scheme",
        5: None, 6: "ftp://a.b.net/es/1", 7: "http://net/fr/", 8: "x://é.ÉX.net/fr?http://example.com/en/", 9: "://", 10: "http://bexample.com/en/",
        11: "a://sub.www.example.com/en/\nq", 12: "http:///path", 13: "",
    }
    got = {r.page_id: r for r in judge(spark, list(urls.items()), [])}

    def rule(host, path):
        fits = [(r, v) for r, v in URL_RULES for h, p in [(r[: r.index("/")], r[r.index("/"):])] if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits, key=lambda x: len(x[0]), default=(None, None))

    for i, url in urls.items():
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split("[/?#]", rest)[0]
            path = re.split("[?#]", rest[len(host):])[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        assert (got[i].host, got[i].path) == (host, path), url
        name, verdict = rule(host, path)
        assert got[i].rule == name and (verdict is None or got[i].verdict == verdict)
        assert got[i].verdict in ("allow", "block")


def test_shrinkage_orders_hosts(spark):
    pages, outcomes, i = [], [], 0
    for host, good, bad in (("a.good.org", 40, 0), ("b.good.org", 1, 1), ("a.bad.org", 0, 40), ("b.bad.org", 1, 1), ("new.good.org", 0, 0), ("new.bad.org", 0, 0)):
        for k in range(max(1, good + bad)):
            i += 1
            pages.append((i, f"http://{host}/{k}"))
            if k < good + bad:
                outcomes.append((i, k < good))
    rate = {r.host: (r.rate, r.bound, r.verdict) for r in judge(spark, pages, outcomes, rules=[])}
    assert rate["b.good.org"][0] > rate["b.bad.org"][0]  # same labels, another domain
    assert rate["new.good.org"][0] > rate["new.bad.org"][0]
    assert rate["a.good.org"][2] == "allow" and rate["a.bad.org"][2] == "block"
    assert all(b < r for r, b, _ in rate.values())


def test_hot_host_nulls_repeats_and_empty(spark):
    pages = [(k % 40, "http://hot.example.org/") for k in range(400)] + [(None, None), (None, "http://x.org/")]
    got = judge(spark, pages, [(1, True), (1, False), (2, None), (None, True), (999, True)])
    assert len(got) == 402 and sum(r.host == "hot.example.org" for r in got) == 400
    assert judge(spark, [], []) == []


def test_long_suffixes(spark):
    s, d = hr.suffix_and_domain(__import__("pyspark").sql.functions.col("h"), hr.ReputationSettings(long_suffixes=("co.uk",)))
    df = spark.createDataFrame([("a.b.co.uk:80",), ("co.uk",), ("x.org",), ("org",), ("",), ("w.x.y.org",)], "h string")
    assert [tuple(r) for r in df.select(s.alias("s"), d.alias("d")).collect()] == [
        ("co.uk", "b.co.uk"), ("co.uk", "co.uk"), ("org", "x.org"), ("org", "org"), ("", ""), ("org", "y.org")]


def test_default_suffixes_addresses_and_the_sql(spark, tmp_path):
    import random

    import duckdb
    from pyspark.sql import functions as F

    from linkloom.llm.queries import OP1_SQL, op1_url_reputation

    s, d = hr.suffix_and_domain(F.col("h"), hr.ReputationSettings())
    hosts = [("a.b.co.uk:80",), ("co.uk",), ("1.2.3.4:8",), ("[::1]:80",), ("x.1.2.3.4",), ("q.com.br",), ("xco.uk",), ("a..b",), (".",), ("1.2.3",)]
    assert [tuple(r) for r in spark.createDataFrame(hosts, "h string").select(s, d).collect()] == [
        ("co.uk", "b.co.uk"), ("co.uk", "co.uk"), ("address", "1.2.3.4"), ("address", "[::1]"), ("4", "3.4"), ("com.br", "q.com.br"),
        ("uk", "xco.uk"), ("b", ".b"), ("", "."), ("3", "2.3"),
    ]
    r = random.Random(3)
    names = [h for h, in hosts] + [f"h{i % 7}.d{i % 5}.{x}" for i in range(30) for x in ("co.uk", "com.au", "org", "net")]
    pages = [(i, f"http://{r.choice(names)}/{i}") for i in range(900)] + [(2000, None), (2001, "x"), (None, "http://a.org/")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 0, 1])) for i in range(700)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sql = duckdb.connect()
    for t in ("pages", "labels"):
        sql.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    need = sql.sql(OP1_SQL)
    got = op1_url_reputation(spark, str(tmp_path)).select(need.columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(need.fetchall(), key=repr)
