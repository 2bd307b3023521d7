import json

import pytest
from pyspark.sql import functions as F

from linkloom.functions import edit_at, objects_at, parse_path, refs_at, replace_refs


def test_parse_path():
    assert parse_path("a.b") == ["a", "b"]
    assert parse_path("$.a") == ["a"]
    assert parse_path(r"x\.y.z") == ["x.y", "z"]
    assert parse_path(["a.b"]) == ["a.b"]
    with pytest.raises(ValueError):
        parse_path("a..b")


def _refs(spark, doc, path):
    df = spark.createDataFrame([(doc,)], "j string").select(refs_at(F.parse_json("j"), path).alias("r"))
    return df.first().r


# a step of one name inside another of the same name: object, inner array, outer array
CREW_OBJECT = {"crew": {"kind": "band", "crew": {"uri": "p:1", "plays": "oboe"}}}
CREW_INNER = {"crew": {"kind": "band", "crew": [{"uri": "p:1"}, {"@id": "p:2"}, "p:3"]}}
CREW_OUTER = {"crew": [{"crew": {"uri": "p:1"}}, {"kind": "solo"}, {"crew": ["p:2", "p:1"]}]}


def test_extract_refs_shapes(spark):
    assert _refs(spark, json.dumps(CREW_OBJECT), "crew.crew") == ["p:1"]
    assert _refs(spark, json.dumps(CREW_INNER), "crew.crew") == ["p:1", "p:2", "p:3"]
    assert _refs(spark, json.dumps(CREW_OUTER), "crew.crew") == ["p:1", "p:2", "p:1"]
    ticket = {"row": ["r:9"], "holder": "p:4"}
    assert _refs(spark, json.dumps(ticket), "holder") == ["p:4"]
    assert _refs(spark, json.dumps(ticket), "$.row") == ["r:9"]


def test_extract_dotted_keys(spark):
    doc = {"v1.2/seat.no": ["s:1", {"uri": "s:2"}], "v1": {"2/seat": {"no": "wrong"}}}
    assert _refs(spark, json.dumps(doc), r"v1\.2/seat\.no") == ["s:1", "s:2"]


def test_extract_hostile_values(spark):
    doc = {"x": [None, 1, [["nested"]], "s", {"uri": "u"}, {"no": 1}, True], "y": None, "z": {}}
    assert _refs(spark, json.dumps(doc), "x") == ["s", "u"]
    assert _refs(spark, json.dumps(doc), "y") == []
    assert _refs(spark, json.dumps(doc), "z") == []
    assert _refs(spark, json.dumps(doc), "missing.deeper") == []
    objs = spark.createDataFrame([(json.dumps(doc),)], "j string").select(objects_at(F.parse_json("j"), "x").alias("o"))
    assert len(objs.first().o) == 7


def test_replace_one_reference(spark):
    df = spark.createDataFrame(
        [('{"row": 3, "holder": "p:4"}', "p:4", '{"uri": "p:4", "member": true}')], "j string, k string, b string",
    ).select(F.parse_json("j").alias("doc"), F.struct(F.array(F.col("k")).alias("keys"), F.array(F.parse_json("b")).alias("vals")).alias("m"))
    out = df.select(edit_at(F.col("doc"), "holder", replace_refs(F.col("m"))).alias("d")).first().d
    assert json.loads(out.toJson()) == {"row": 3, "holder": {"uri": "p:4", "member": True}}


def test_edit_hostile_and_deep(spark):
    base = '{"uri":"u","v":1}'
    doc = {"p": {"q": [{"r": ["u", {"@id": "u", "w": 2}, 3, None, ["u"]]}, "str", {"r": "u"}, {"r": None}]}, "other": "u"}
    df = spark.createDataFrame([(json.dumps(doc), "u", base)], "j string, k string, b string").select(
        F.parse_json("j").alias("doc"), F.struct(F.array(F.col("k")).alias("keys"), F.array(F.parse_json("b")).alias("vals")).alias("m")
    )
    out = json.loads(df.select(edit_at(F.col("doc"), "p.q.r", replace_refs(F.col("m"))).alias("d")).first().d.toJson())
    q = out["p"]["q"]
    assert q[0]["r"][0] == {"uri": "u", "v": 1}
    assert q[0]["r"][1] == {"@id": "u", "w": 2, "uri": "u", "v": 1}
    assert q[0]["r"][2:] == [3, None, ["u"]]
    assert q[1] == "str" and q[2]["r"] == {"uri": "u", "v": 1} and q[3]["r"] is None
    assert out["other"] == "u"


def test_lookup(spark):
    from linkloom.functions import lookup, match_table

    keys = [f"k{i}" for i in [5, 1, 9, 3, 7, 100, 42, 8, 0]]
    df = spark.createDataFrame([("d", k, json.dumps({"k": k})) for k in keys], "uri string, r string, j string")
    table = df.groupBy("uri").agg(match_table(F.col("r"), F.parse_json("j")).alias("m"))
    probes = keys + ["", "a", "k", "k10", "k99", "zz"]
    probe = table.select("m", F.explode(F.array(*[F.lit(p) for p in probes])).alias("q"))
    got = {r.q: (r.v.toJson() if r.v is not None else None) for r in probe.select("q", lookup(F.col("m"), F.col("q")).alias("v")).collect()}
    assert all(got[k] == json.dumps({"k": k}, separators=(",", ":")) for k in keys)
    assert all(got[p] is None for p in probes if p not in keys)
