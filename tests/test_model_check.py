"""Random documents: Spark expressions and the merge job against the model."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import model
from linkloom import basic_merge, deduplicate
from linkloom.functions import refs_at

REF = st.sampled_from(["r1", "r2", "r3", "zz"])
ID = st.one_of(st.none(), REF)
KEYS = ["a", "b", "c"]


def json_values():
    scalars = st.one_of(st.none(), st.booleans(), st.integers(-3, 3), REF, st.just("plain"))
    return st.recursive(
        scalars,
        lambda kids: st.one_of(
            st.lists(kids, max_size=4),
            st.fixed_dictionaries({}, optional={"uri": ID, "@id": ID, "a": kids, "b": kids, "c": kids}),
        ),
        max_leaves=12,
    )


DOCS = st.lists(st.fixed_dictionaries({}, optional={"a": json_values(), "b": json_values(), "uri": ID}), min_size=20, max_size=40)
PATHS = st.lists(st.sampled_from(KEYS), min_size=1, max_size=3)
BASE = {
    "r1": {"uri": "r1", "v": 1},
    "r2": {"name": "two", "a": [1, 2]},
    "r3": {},
}


def frame(spark, docs):
    rows = [(f"d{i}", json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "uri string, j string").select("uri", F.parse_json("j").alias("doc"))


def as_py(df):
    return {r.uri: json.loads(r.doc.toJson()) for r in df.collect()}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(docs=DOCS, steps=PATHS)
def test_refs_match_model(spark, docs, steps):
    df = frame(spark, docs).select("uri", refs_at(F.col("doc"), steps).alias("r"))
    got = {r.uri: r.r for r in df.collect()}
    for i, d in enumerate(docs):
        assert got[f"d{i}"] == model.refs_at(d, steps), (d, steps)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(docs=DOCS, steps=PATHS, cap=st.one_of(st.none(), st.integers(0, 3)))
def test_merge_matches_model(spark, docs, steps, cap):
    base = spark.createDataFrame([(k, json.dumps(v)) for k, v in BASE.items()], "uri string, j string").select(
        "uri", F.parse_json("j").alias("doc"))
    got = as_py(basic_merge(frame(spark, docs), steps, base, max_refs=cap))
    for i, d in enumerate(docs):
        assert got[f"d{i}"] == model.merge(d, steps, BASE, cap), (d, steps, cap)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(docs=DOCS, steps=PATHS)
def test_dedup_matches_model(spark, docs, steps):
    got = as_py(deduplicate(frame(spark, docs), steps))
    for i, d in enumerate(docs):
        assert got[f"d{i}"] == model.edit_at(d, steps, model.distinct_elements), (d, steps)


LINKS = {"r1": "r2", "zz": "r1", "r3": "r3"}  # r3 -> r3 is an identity link and is dropped


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(docs=DOCS, steps=PATHS)
def test_link_merge_and_clean_match_model(spark, docs, steps):
    from linkloom import clean, link_merge

    base = spark.createDataFrame([(k, json.dumps(v)) for k, v in BASE.items()], "uri string, j string").select(
        "uri", F.parse_json("j").alias("doc"))
    link_docs = spark.createDataFrame(
        [(s, json.dumps({"uri": s, "matches": [{"uri": b}]})) for s, b in LINKS.items()], "uri string, j string"
    ).select("uri", F.parse_json("j").alias("doc"))
    live = {s: b for s, b in LINKS.items() if s != b}
    got = as_py(link_merge(frame(spark, docs), steps, base, link_docs, remove=["a"]))
    cleaned = as_py(clean(frame(spark, docs), steps, base))
    for i, d in enumerate(docs):
        assert got[f"d{i}"] == model.link_merge(d, steps, live, BASE, remove=["a"]), (d, steps)
        assert cleaned[f"d{i}"] == model.clean(d, steps, BASE), (d, steps)
