"""Plan checks over every registered query (sf0.001) and the oracle match."""

import os
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import table_queries

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")

SAME_PLAN_MANY_TIMES = ("increment_many_rounds",)  # as increment_rounds, 40 times

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["uri", "o_totalprice", "c_name", "n_name", "r_name"]


def test_no_python_in_plans(spark):
    for name, fn in table_queries.QUERIES.items():
        if name in SAME_PLAN_MANY_TIMES:
            continue
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(n in plan for n in PYTHON_NODES), name


def scans(plan):
    return dict(Counter(re.findall(r"FileScan parquet .*?/(\w+)\.parquet", plan)))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_declared_keys_are_not_aggregated(spark):
    """With declared keys no document is sorted or digested before the join back."""
    plan = final_plan(entry.queries()["basic_merge_object"](spark, SF))
    assert "max_by" not in plan and "sha1" not in plan
    assert "sha1" in final_plan(entry.queries()["basic_merge_partitioned"](spark, SF))


def test_queries_match_oracles_small(spark):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    oracles = table_queries.ORACLES
    assert set(oracles) == set(table_queries.QUERIES)
    assert oracles.items() <= entry.oracle_sql().items()
    for name, fn in table_queries.QUERIES.items():
        df = fn(spark, SF)
        cols = sorted(df.columns)
        got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
        rel = con.sql(oracles[name])
        assert sorted(rel.columns) == cols, name
        idx = [rel.columns.index(c) for c in cols]
        exp = sorted((tuple(r[i] for i in idx) for r in rel.fetchall()), key=repr)
        assert got == exp, name


def test_nested_frames_plan_stays_linear(spark):
    """A child frame is read once by its parent: scans grow with the number of
    frame nodes, not exponentially with the depth."""
    plan = final_plan(entry.queries()["frame_nested"](spark, SF))
    assert scans(plan) == {"orders": 2, "customer": 2, "nation": 2, "region": 1}  # pairs and documents; the leaf once


#: Reads of each table: the documents for the pairs and for the join back (declared unique), or
#: once for both (the choice among repeated keys shuffles them anyway); each base once.
READS = {
    "basic_merge_object": {"orders": 2, "customer": 1},
    "basic_merge_partitioned": {"orders": 2, "customer": 1},  # a union of two copies
    "basic_merge_keyless": {"orders": 1, "customer": 1},
    "frame_nested": {"orders": 2, "customer": 2, "nation": 2, "region": 1},
    "frame_multi": {"orders": 1, "lineitem": 1, "customer": 1, "part": 1},
    "link_merge": {"customer": 1, "nation": 4},  # the nations are base, link source and link target
}


@pytest.mark.parametrize("broadcast", [True, False])
def test_reads_of_a_merge(spark, broadcast):
    """The input is read once or twice per merge, with or without broadcasting, and neither
    the pairs nor the documents are shuffled on a bare, unsalted key."""
    options = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    if not broadcast:
        for k in options:
            spark.conf.set(k, "-1")
    try:
        for name, reads in READS.items():
            plan = final_plan(entry.queries()[name](spark, SF))
            assert scans(plan) == reads, name
            joins = re.findall(r"SortMergeJoin (\[[^\]]*\])", re.sub(r"#\d+L?", "", plan))
            assert all("_salt" in j or "_key" in j or name == "link_merge" and j in ("[base_uri]",) or "orderkey" in j for j in joins), (name, joins)
            documents = [node for node in re.findall(r"SortAggregate[^\n]*", plan) if "doc#" in node]
            assert not documents, name
    finally:
        for k in options:
            spark.conf.unset(k)


def test_split_reads_each_table_once(spark, monkeypatch):
    from linkloom.operators import classes

    plans = []

    class Writer:
        def partitionBy(self, *_):
            return self

        def parquet(self, _path):
            raise StopIteration

    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "write", property(lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or Writer()))
    with pytest.raises(StopIteration):
        classes.split_by_classes(table_queries.typed_docs(spark, SF), table_queries.CLASSES)
    assert plans[0].count("FileScan") == 4
    monkeypatch.undo()
    assert final_plan(entry.queries()["type_split"](spark, SF)).count("FileScan") == len(table_queries.CLASSES)


def test_large_base_plan_shape(spark):
    """With broadcasting off (a base too large to broadcast, as at scale), the
    merge sort-merge joins on (base_uri, _salt) and has no Python in the plan."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry.queries()["basic_merge_object"](spark, SF)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    final = re.sub(r"#\d+L?", "", plan.split("== Initial Plan ==")[0])
    assert len(rows) > 0
    assert "SortMergeJoin [base_uri, _salt], [base_uri, _salt], Inner" in final
    assert "SortMergeJoin [_key], [_key], LeftOuter" in final
    assert "hashpartitioning(base_uri, 8)" not in final
    assert not any(n in plan for n in PYTHON_NODES)


@pytest.fixture
def no_broadcast(spark):
    """Tables count as too large to broadcast, as at scale."""
    options = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in options:
        spark.conf.set(k, "-1")
    yield
    for k in options:
        spark.conf.unset(k)


def planned(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?|plan_id=\d+", "", plan)


@pytest.mark.parametrize("name", ["clean_array", "basic_merge_array", "basic_merge_deep", "frame_multi"])
def test_hot_key_sketches_share_the_shuffles_of_a_merge(spark, no_broadcast, name):
    """The look for repeated and hot keys adds no filter of its own to the shuffles below, so
    Spark runs those of the documents and of the pairs once."""
    plan = planned(spark, name)
    wide = re.findall(r"FileScan parquet \[l_orderkey,l_partkey[^\n]*DataFilters: (\[[^\n]*?\]), Format", plan)
    assert len(wide) > 1 and len(set(wide)) == 1
    pairs = re.findall(r"REPARTITION_BY_COL[^\n]*\n\W*(Project[^\n]*\n\W*)?(Filter[^\n]*)\n", plan)
    assert len(pairs) > 1 and len(set(pairs)) == 1


def test_sorts_compare_without_a_lambda(spark):
    """Of the sorts, a plan shows those that are no part of an aggregate's result."""
    plan = planned(spark, "dedup_objects")
    assert "array_sort(" not in plan and "sort_array(" in plan
