import json
import os
import tempfile

from fixtures import CASTS, CODES, EMBEDDED, FRAME, SETS, SHOWS, SHOWS_BY_CODE, VENUES

from linkloom import jobs


def write_lines(spark, path, rows):
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)


def read_out(spark, path):
    return {r.uri: json.loads(r.doc.toJson()) for r in jobs.read_set(spark, path, "text").collect()}


def test_file_jobs(spark):
    d = tempfile.mkdtemp(prefix="ll-jobs-")
    write_lines(spark, f"{d}/shows", SHOWS)
    write_lines(spark, f"{d}/venues", VENUES)
    jobs.main(["--unique", "merge", f"{d}/shows", "text", "held.venue", f"{d}/venues", "text", f"{d}/merged"])
    assert read_out(spark, f"{d}/merged")["show:1"]["held"]["venue"]["town"] == "Graz"

    write_lines(spark, f"{d}/casts", CASTS)
    jobs.dedup_job(spark, f"{d}/casts", "text", "crew.cast", f"{d}/dedup", "parquet")
    dedup = {r.uri: json.loads(r.doc.toJson()) for r in jobs.read_set(spark, f"{d}/dedup", "parquet").collect()}
    assert len(dedup["show:1"]["crew"]["cast"]) == 2

    manifest = {}
    for name, rows in SETS.items():
        write_lines(spark, f"{d}/{name}", rows)
        manifest[name] = {"path": f"{d}/{name}", "format": "text", "unique": name == "Venue"}
    write_lines(spark, f"{d}/frame.json", [json.dumps(FRAME)])
    write_lines(spark, f"{d}/manifest.json", [json.dumps(manifest)])
    jobs.frame_job(spark, f"{d}/frame.json", f"{d}/manifest.json", f"{d}/framed")
    framed = read_out(spark, f"{d}/framed")
    assert len(framed) == 5 and framed["fest:array"]["sponsor"]["label"] == "Baker & sons"

    jobs.self_links_job(spark, f"{d}/shows", "text", f"{d}/links")
    link_rows = [json.loads(r.value) for r in spark.read.text(f"{d}/links").collect()]
    assert {x["uri"] for x in link_rows} == {x["matches"][0]["uri"] for x in link_rows}

    write_lines(spark, f"{d}/names.tsv", ["u1\tOne\textra", "bad"])
    jobs.base_file_job(spark, f"{d}/names.tsv", f"{d}/base", rejected_path=f"{d}/rejected")
    assert read_out(spark, f"{d}/base") == {"u1": {"uri": "u1", "name": "One"}}
    jobs.convert_job(spark, f"{d}/base", "text", f"{d}/base.seq", "sequence")
    assert jobs.read_set(spark, f"{d}/base.seq", "sequence").count() == 1
    assert os.path.exists(f"{d}/rejected")


def test_link_clean_increment_jobs(spark):
    d = tempfile.mkdtemp(prefix="ll-jobs2-")
    write_lines(spark, f"{d}/shows", SHOWS_BY_CODE)
    write_lines(spark, f"{d}/venues", VENUES)
    write_lines(spark, f"{d}/codes", CODES)
    jobs.main(["--remove", "phone", "link-merge", f"{d}/shows", "text", "held.venue", f"{d}/venues", "text",
               f"{d}/codes", "text", f"{d}/linked"])
    linked = read_out(spark, f"{d}/linked")["show:1"]["held"]["venue"]
    assert linked["uri"] == "venue:dome" and linked["gate"] == "B" and "phone" not in linked

    write_lines(spark, f"{d}/embedded", EMBEDDED)
    jobs.main(["clean", f"{d}/embedded", "text", "held.venue", f"{d}/venues", "text", f"{d}/cleaned"])
    assert read_out(spark, f"{d}/cleaned")["show:1"]["held"]["venue"]["seats"] == 1200

    jobs.main(["increment", f"{d}/cleaned", "text", f"{d}/state", f"{d}/inc1"])
    jobs.main(["increment", f"{d}/cleaned", "text", f"{d}/state", f"{d}/inc2"])
    assert len(read_out(spark, f"{d}/inc1")) == 2
    assert read_out(spark, f"{d}/inc2") == {}


def test_a_job_leaves_its_output_only(spark):
    """Checkpointed children and class splits are deleted with the scope that made them."""
    import __spark_entry__ as entry
    from linkloom.session import checkpoint_dir, scratch_scope

    def folders():
        return {f for f in os.listdir(checkpoint_dir(spark).removeprefix("file:")) if f.startswith("linkloom-")}

    before, d = folders(), tempfile.mkdtemp(prefix="ll-scope-")
    with scratch_scope(spark):
        entry.queries()["frame_checkpointed"](spark, entry.SMOKE_DIR).write.parquet(f"{d}/frame")
        inside = folders() - before
        with scratch_scope(spark):
            entry.queries()["frame_from_split"](spark, entry.SMOKE_DIR).write.parquet(f"{d}/split")
            assert folders() - before > inside
        assert folders() - before == inside and inside
    assert folders() == before
    assert spark.read.parquet(f"{d}/frame").count() == spark.read.parquet(f"{d}/split").count() > 0


def test_uniqueness_by_set(spark):
    d = tempfile.mkdtemp(prefix="ll-unique-")
    write_lines(spark, f"{d}/docs", ['a\t{"r": {"uri": "b"}}'] * 2 + ['c\t{"r": {"uri": "b"}}'])
    write_lines(spark, f"{d}/base", ['b\t{"uri": "b", "x": 1}'])
    jobs.main(["--unique-base", "clean", f"{d}/docs", "text", "r", f"{d}/base", "text", f"{d}/cleaned"])
    rows = [r.uri for r in jobs.read_set(spark, f"{d}/cleaned", "text").collect()]
    assert sorted(rows) == ["a", "c"]  # the input is not declared unique


def test_entry_without_a_package_of_the_corpus_operators():
    """The core queries stay when only a package of the optional part is absent."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys, warnings; sys.modules['zstandard'] = None; sys.modules['tokenizers'] = None\n"
        "with warnings.catch_warnings(record=True) as said:\n    warnings.simplefilter('always')\n    import __spark_entry__ as e\n"
        "assert 'basic_merge_object' in e.queries() and set(e.oracle_sql()) <= set(e.queries())\n"
        "import table_queries\n"
        "llm = set(e.queries()) - set(table_queries.QUERIES)\n"
        "assert not llm and (said or not __import__('os').path.isdir('linkloom/llm')), (llm, said)\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
