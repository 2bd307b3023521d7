from fixtures import CASTS, CODES, EMBEDDED, SHOWS, SHOWS_BY_CODE, VENUES

from linkloom import basic_merge, clean, deduplicate, link_merge

DOME = {"uri": "venue:dome", "a": "Venue", "name": "Dome", "town": "Graz", "seats": 1200}
CELLAR = {"uri": "venue:cellar", "a": "Venue", "name": "Cellar", "town": "Brno", "seats": 80}
BARGE = {"uri": "barge", "a": "Venue", "name": "Barge", "town": "Linz"}


def test_basic_merge(spark, docs, collect_docs):
    out = collect_docs(basic_merge(docs(spark, SHOWS), "held.venue", docs(spark, VENUES)))
    assert out["show:1"] == {"uri": "show:1", "a": "Show", "held": {"venue": DOME, "hour": 20}}
    assert out["show:2"]["held"]["venue"] == {"@id": "barge", "floor": 2, **BARGE}
    assert out["show:3"]["held"] == [{"venue": [CELLAR, DOME]}, {"venue": "venue:unknown"}]
    assert out["show:4"] == {"uri": "show:4", "a": "Show"} and len(out) == 4


def test_link_merge(spark, docs, collect_docs):
    args = docs(spark, SHOWS_BY_CODE), "held.venue", docs(spark, VENUES), docs(spark, CODES)
    out = collect_docs(link_merge(*args))
    assert out["show:1"]["held"]["venue"] == {"gate": "B", "phone": "old", **DOME}  # the first match, whose uri is taken over
    assert out["show:2"]["held"]["venue"] == BARGE
    assert out["show:3"]["held"]["venue"] == "office/79"  # linked to a venue that is not there
    assert collect_docs(link_merge(*args, remove=["phone"]))["show:1"]["held"]["venue"] == {"gate": "B", **DOME}


def test_clean(spark, docs, collect_docs):
    out = collect_docs(clean(docs(spark, EMBEDDED), "held.venue", docs(spark, VENUES)))
    assert out["show:1"]["held"]["venue"] == {"lift": True, **DOME}  # shallow: what the base lacks stays
    assert out["show:2"]["held"]["venue"] == [BARGE, CELLAR]
    assert collect_docs(clean(docs(spark, EMBEDDED), "held.venue", docs(spark, ["barge\t{}"])))["show:2"] == collect_docs(docs(spark, EMBEDDED))["show:2"]


def test_dedup(spark, docs, collect_docs):
    out = collect_docs(deduplicate(docs(spark, CASTS), "crew.cast"))
    assert out["show:1"]["crew"]["cast"] == [{"role": "Ada", "n": 1}, {"role": "Bo", "n": 2}]
    assert out["show:2"]["crew"]["cast"] == [{"role": "Cy"}, {"role": "Di"}]
    assert out["show:3"]["crew"] == [{"cast": ["Eve"]}, {"cast": "Eve"}]


def test_dedup_mixed_values(spark, docs, collect_docs):
    rows = ['a\t{"x":["m","n","m","1",1,1.0,{"p":1,"q":2},{"q":2,"p":1}]}', 'b\t{"x":"scalar"}', 'c\t{"y":[1,1]}',
            'd\t[{"x":[1,1]}, "s", {"x":[null,null,2]}]', 'e\t{"x":[]}']
    out = collect_docs(deduplicate(docs(spark, rows), "x"))
    assert out["a"]["x"] == ["m", "n", "1", 1, {"p": 1, "q": 2}]
    assert out["b"]["x"] == "scalar"
    assert out["c"]["y"] == [1, 1]
    assert out["d"] == [{"x": [1]}, "s", {"x": [None, 2]}]  # each element of a top-level array
    assert out["e"]["x"] == []
    again = collect_docs(deduplicate(deduplicate(docs(spark, rows), "x"), "x"))
    assert again == out


def test_dedup_keeps_typed_elements(spark):
    from pyspark.sql import functions as F

    typed = spark.sql("select 'k' as uri, to_variant_object(struct(array(date'2020-01-02', date'2020-01-02', date'2020-01-03') as d, array(date'2020-01-02') as one)) as doc")
    kinds = deduplicate(deduplicate(typed, "d"), "one").select(F.schema_of_variant("doc").alias("s")).first().s
    assert kinds == "OBJECT<d: ARRAY<DATE>, one: ARRAY<DATE>>"


def test_documents_without_a_key_pass_unchanged(spark, docs):
    from pyspark.sql import functions as F

    shows = docs(spark, SHOWS).withColumn("uri", F.when(F.col("uri") != "show:1", F.col("uri")))
    out = basic_merge(shows, "held.venue", docs(spark, VENUES)).collect()
    assert len(out) == 4
    lost, = (r.doc.toJson() for r in out if r.uri is None)
    assert '"venue":"venue:dome"' in lost


def test_only_string_uris_match(spark, docs, collect_docs):
    rows = ['a\t{"r":{"uri":5}}', 'b\t{"r":{"@id":true}}', 'c\t{"r":5}', 'd\t{"r":{"uri":5,"@id":"5"}}']
    out = collect_docs(basic_merge(docs(spark, rows), "r", docs(spark, ['5\t{"v":1}', 'true\t{"v":2}'])))
    assert out == {"a": {"r": {"uri": 5}}, "b": {"r": {"@id": True}}, "c": {"r": 5}, "d": {"r": {"uri": 5, "@id": "5", "v": 1}}}
