import json
import tempfile

import pytest
from pyspark.sql import functions as F

from linkloom.sources import (
    format_keyed_lines, load_catalogue, load_table_documents, parse_delimited_base, parse_keyed_lines,
    read_delimited_base, read_json_config, read_keyed_json, read_sequence_documents, split_keyed_lines, text_to_sequence,
    write_keyed_json, write_sequence_documents,
)


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_hostile_lines(spark, collect_docs):
    rows = [
        "",
        "   ",
        'k1\t{"a": 1}',
        '  k2\t{"b":\t2}  ',  # TAB inside the JSON part: split once only
        '{"uri": "from-doc", "c": 3}',  # keyless: key from the document
        'k5\t{"d": 1, "d": 2}',  # duplicate key: the last wins, in any session
    ]
    spark.conf.unset("spark.sql.variant.allowDuplicateKeys")
    out = collect_docs(parse_keyed_lines(lines(spark, rows)))
    assert out == {"k1": {"a": 1}, "k2": {"b": 2}, "from-doc": {"uri": "from-doc", "c": 3}, "k5": {"d": 2}}


def test_lines_are_documents_or_handed_back(spark):
    rows = ['k\t{"ok": 1}', "bad\t{not json", '{"c": 4}', '{"c": 5}', "", '{"uri": 7}', 'k5\t{"d": 1, "d": 2}']
    spark.conf.unset("spark.sql.variant.allowDuplicateKeys")
    good, rejected = split_keyed_lines(lines(spark, rows))
    assert sorted(r.uri for r in good.collect()) == ["k", "k5"]
    assert sorted((r.reason, r.value) for r in rejected.collect()) == [
        ("malformed JSON", "bad\t{not json"), ("no key", '{"c": 4}'), ("no key", '{"c": 5}'), ("no key", '{"uri": 7}')]
    for one in rows[1:3]:
        with pytest.raises(Exception):
            parse_keyed_lines(lines(spark, [one])).collect()


def test_documents_without_a_key_are_not_written(spark):
    df = spark.sql("select cast(null as string) as uri, parse_json('{}') as doc")
    with pytest.raises(Exception, match="without a key"):
        format_keyed_lines(df).collect()


def test_text_round_trip(spark, docs, collect_docs):
    src = docs(spark, ['u1\t{"x": [1, "two", {"y": null}]}', 'u2\t{"é": "ü"}'])
    path = tempfile.mkdtemp(prefix="ll-text-") + "/out"
    write_keyed_json(src, path)
    back = collect_docs(read_keyed_json(spark, path))
    assert back == collect_docs(src)
    line = format_keyed_lines(src).where(F.col("value").startswith("u1")).first().value
    assert line.split("\t", 1)[0] == "u1" and json.loads(line.split("\t", 1)[1]) == {"x": [1, "two", {"y": None}]}


def test_sequence_round_trip(spark, docs, collect_docs):
    src = docs(spark, ['u1\t{"x": 1}', 'u2\t{"y": [true, null]}'])
    path = tempfile.mkdtemp(prefix="ll-seq-") + "/seq"
    write_sequence_documents(src, path)
    assert collect_docs(read_sequence_documents(spark, path)) == collect_docs(src)
    text_dir = tempfile.mkdtemp(prefix="ll-t2s-")
    write_keyed_json(src, text_dir + "/in")
    text_to_sequence(spark, text_dir + "/in", text_dir + "/out")
    assert collect_docs(read_sequence_documents(spark, text_dir + "/out")) == collect_docs(src)


def test_delimited_base(spark, collect_docs):
    rows = ["u1\tName One\textra", "u2\tName Two", "lonely"]
    good, bad = parse_delimited_base(lines(spark, rows))
    assert collect_docs(good) == {"u1": {"uri": "u1", "name": "Name One"}, "u2": {"uri": "u2", "name": "Name Two"}}
    assert [r.value for r in bad.collect()] == ["lonely"]
    path = tempfile.mkdtemp(prefix="ll-delim-") + "/d.tsv"
    lines(spark, rows).coalesce(1).write.text(path)
    good2, bad2 = read_delimited_base(spark, path)
    assert good2.count() == 2 and bad2.count() == 1


def test_table_documents(spark, collect_docs):
    df = spark.createDataFrame(
        [(1, '{"k": 5, "s": "\\u00e9"}', json.dumps('{"k": 6}')), (2, '{"k": 7}', json.dumps('{"k": 8}'))],
        "id long, v string, vv string",
    )
    out = collect_docs(load_table_documents(spark, df, "id", "v"))
    assert out == {"1": {"k": 5, "s": "é"}, "2": {"k": 7}}
    twice = collect_docs(load_table_documents(spark, df, "id", "vv", escaped=True))
    assert twice == {"1": {"k": 6}, "2": {"k": 8}}
    raw = collect_docs(load_table_documents(spark, df, "id", "v", is_json=False))
    assert raw["2"] == '{"k": 7}'


def test_stored_text_escapes(spark, collect_docs):
    stored = {
        "x": r'{"a": "\xe9\x41", "b": "\\\\x41"}',  # \xNN is a character; the pair of backslashes is one
        "quotes": r'{\"a\": \"it\'s\"}',
        "wrapped": json.dumps('{"a": [1, "two"]}'),
        "plain": '{"a": "\\u00fc", "b": 1}',
    }
    df = spark.createDataFrame(list(stored.items()), "k string, v string")
    out = collect_docs(load_table_documents(spark, df, "k", "v", escaped=True))
    assert out["x"] == {"a": "éA", "b": "\\x41"}
    assert out["quotes"] == {"a": "it's"}
    assert out["wrapped"] == {"a": [1, "two"]}
    assert out["plain"] == {"a": "ü", "b": 1}


def test_catalogue_and_config(spark, docs, collect_docs):
    base = tempfile.mkdtemp(prefix="ll-cat-")
    write_keyed_json(docs(spark, ['s1\t{"a": "Sponsor"}']), base + "/sponsors")
    docs(spark, ['o1\t{"a": "Festival"}']).write.parquet(base + "/festivals")
    manifest = {"Sponsor": {"path": base + "/sponsors", "format": "text"}, "Festival": {"path": base + "/festivals", "format": "parquet"}}
    lines(spark, [json.dumps(manifest)]).coalesce(1).write.text(base + "/manifest")
    cfg = read_json_config(spark, base + "/manifest")
    assert cfg == manifest
    cat = load_catalogue(spark, base + "/manifest")
    assert collect_docs(cat["Sponsor"]) == {"s1": {"a": "Sponsor"}}
    assert collect_docs(cat["Festival"]) == {"o1": {"a": "Festival"}}


def test_table_documents_from_path(spark, collect_docs):
    path = tempfile.mkdtemp(prefix="ll-kv-") + "/kv"
    spark.createDataFrame([("u1", '{"a": [1, 2]}'), ("u2", '{"b": null}')], "k string, v string").write.parquet(path)
    out = collect_docs(load_table_documents(spark, path, "k", "v", fmt="parquet"))
    assert out == {"u1": {"a": [1, 2]}, "u2": {"b": None}}


def test_keys_that_cannot_be_read_back_are_an_error(spark, docs):
    import pytest
    from pyspark.sql import functions as F

    from linkloom.sources import format_keyed_lines

    good = docs(spark, ['a b\t{"x": "tab\\tand line\\nend"}'])
    assert format_keyed_lines(good).count() == 1
    for bad, sep in (("a\tb", "\t"), ("a\nb", "\t"), ("a\rb", "\t"), ("a|b", "|")):
        lines = format_keyed_lines(good.withColumn("uri", F.lit(bad)), sep)
        with pytest.raises(Exception, match="separator or line end"):
            lines.collect()
    assert format_keyed_lines(good.withColumn("uri", F.lit("a|b"))).count() == 1


def test_sequence_files_stay_in_the_jvm(spark, docs):
    import tempfile

    from linkloom.sources import read_sequence_documents, write_sequence_documents

    d = tempfile.mkdtemp(prefix="ll-sequence-")
    some = docs(spark, ['é/1\t{"x": "ä€", "n": [1, 2]}', 'b\t{"y": null}'])
    for name, rows in (("some", some), ("none", some.where("false"))):
        write_sequence_documents(rows, f"{d}/{name}")
        back = read_sequence_documents(spark, f"{d}/{name}")
        assert sorted((r.uri, r.doc.toJson()) for r in back.collect()) == sorted((r.uri, r.doc.toJson()) for r in rows.collect())
        lineage = back._jdf.queryExecution().toRdd().toDebugString()
        assert "PythonRDD[" not in lineage and "HadoopRDD" in lineage
