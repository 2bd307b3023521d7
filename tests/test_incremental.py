import tempfile

from pyspark.sql import functions as F

from linkloom import compute_frames_increment, increment_plan
from linkloom.plans import committed_versions, read_state


def test_increment_rounds(spark, docs, collect_docs):
    root = tempfile.mkdtemp(prefix="ll-state-") + "/frames"
    first = docs(spark, ['a\t{"v": 1}', 'b\t{"v": 2}', 'é/ü\t{"v": 3}'])
    out1 = collect_docs(compute_frames_increment(spark, first, root))
    assert out1 == {"a": {"v": 1}, "b": {"v": 2}, "é/ü": {"v": 3}}
    assert compute_frames_increment(spark, first, root).count() == 0  # nothing changed
    third = docs(spark, ['a\t{"v": 1}', 'b\t{"v": 20}', 'c\t{"v": 4}'])
    out3 = collect_docs(compute_frames_increment(spark, third, root))
    assert out3 == {"b": {"v": 20}, "c": {"v": 4}}
    assert committed_versions(spark, root) == [1, 2, 3]
    state = {r.uri_hex: r.hash for r in read_state(spark, root).collect()}
    assert len(state) == 4  # é/ü stays in the state although absent from the last frames
    assert "c3a92fc3bc" in state  # hex of the UTF-8 key


def test_increment_plan_statuses(spark, docs):
    old = docs(spark, ['a\t{"v": 1}', 'b\t{"v": 2}', 'gone\t{"v": 0}'])
    from linkloom.functions import fingerprint, key_hex

    state = old.select(key_hex(F.col("uri")).alias("uri_hex"), fingerprint(F.col("doc")).alias("hash"))
    inc, new_state = increment_plan(docs(spark, ['a\t{"v": 1}', 'b\t{"v": 3}', 'n\t{"v": 9}']), state)
    assert {(r.uri, r.status) for r in inc.collect()} == {("b", "changed"), ("n", "new")}
    assert new_state.count() == 4


def test_failed_write_and_replay(spark, docs, collect_docs):
    import pytest

    root = tempfile.mkdtemp(prefix="ll-state2-") + "/frames"
    compute_frames_increment(spark, docs(spark, ['a\t{"v": 1}', 'b\t{"v": 2}']), root).count()
    # a round that crashed while it wrote leaves its start record and some files
    with pytest.raises(Exception):
        compute_frames_increment(spark, docs(spark, ['c\t{"v": 1}']).withColumn("uri", F.lit(None).cast("string")), root)
    assert compute_frames_increment(spark, docs(spark, ['a\t{"v": 1}', 'b\t{"v": 3}']), root).count() == 1
    assert committed_versions(spark, root) == [1, 3]
    # a batch of a run is replayable; another run's batch of the same number is its own
    third = docs(spark, ['a\t{"v": 5}'])
    once = collect_docs(compute_frames_increment(spark, third, root, run_id="r", batch_id=0))
    again = collect_docs(compute_frames_increment(spark, docs(spark, ['a\t{"v": 6}']), root, run_id="r", batch_id=0))
    other = collect_docs(compute_frames_increment(spark, docs(spark, ['z\t{"v": 7}']), root, run_id="q", batch_id=0))
    assert once == again == {"a": {"v": 5}} and other == {"z": {"v": 7}}
    # a round folder that nobody recorded is not ignored
    spark.createDataFrame([("x", "y")], "uri_hex string, hash string").write.parquet(root + "/version=99")
    with pytest.raises(ValueError, match="version=99"):
        read_state(spark, root)


def test_repeated_keys_do_not_multiply(spark, docs):
    root = tempfile.mkdtemp(prefix="ll-state3-") + "/frames"
    twice = docs(spark, ['a\t{"v": 1}', 'a\t{"v": 2}', 'b\t{"v": 1}'])
    sizes = [compute_frames_increment(spark, twice, root).count() for _ in range(5)]
    assert sizes == [2, 0, 0, 0, 0] and read_state(spark, root).count() == 2


def test_without_success_files_and_with_snapshots(spark, docs, collect_docs, monkeypatch):
    import linkloom.plans.incremental as incremental

    monkeypatch.setattr(incremental, "COMPACT_EVERY", 2)
    root = tempfile.mkdtemp(prefix="ll-state4-") + "/frames"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        for i in range(5):
            out = collect_docs(compute_frames_increment(spark, docs(spark, ['same\t{"v": 0}', f'k{i % 2}\t{{"v": {i}}}']), root))
            assert out == ({"same": {"v": 0}} if i == 0 else {}) | {f"k{i % 2}": {"v": i}}
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert read_state(spark, root).count() == 3


def test_fingerprint_of_numbers(spark, docs):
    from linkloom.functions import fingerprint, with_variant

    text = docs(spark, ['t\t{"x": 1.0, "y": 12345678.9, "z": 3, "s": "1.0", "n": [0.1, 2.50]}'])
    typed = with_variant(spark.sql("select 'c' as uri, 1.0D as x, 12345678.9D as y, 3 as z, '1.0' as s, array(0.1D, 2.5D) as n"),
                         F.struct("x", "y", "z", "s", "n"))
    hashes = {r[0] for df in (text, typed) for r in df.select(fingerprint(F.col("doc"))).collect()}
    assert len(hashes) == 1


def test_overlapping_rounds_lose_nothing(spark, docs, collect_docs):
    from linkloom.plans import begin_increment

    root = tempfile.mkdtemp(prefix="ll-state5-") + "/frames"
    compute_frames_increment(spark, docs(spark, ['a\t{"v": 1}']), root)
    first = begin_increment(spark, docs(spark, ['a\t{"v": 2}', 'x\t{"v": 1}']), root)
    second = begin_increment(spark, docs(spark, ['a\t{"v": 1}', 'y\t{"v": 1}']), root)
    third = begin_increment(spark, docs(spark, ['z\t{"v": 1}']), root)  # and this one ends in between
    assert collect_docs(second.commit()) == {"y": {"v": 1}}
    assert first.commit() is None and third.commit() is None  # both have missed the second
    assert collect_docs(compute_frames_increment(spark, docs(spark, ['a\t{"v": 2}', 'x\t{"v": 1}']), root)) == {"a": {"v": 2}, "x": {"v": 1}}
    # a is 2 by now: the same documents are another increment than before
    again = collect_docs(compute_frames_increment(spark, docs(spark, ['a\t{"v": 1}', 'y\t{"v": 1}']), root))
    assert again == {"a": {"v": 1}}
    assert {bytes.fromhex(r.uri_hex).decode() for r in read_state(spark, root).collect()} == {"a", "x", "y"}
    versions = committed_versions(spark, root)
    assert versions[:2] == [1, 3] and len(versions) == 4


def test_rounds_of_many_threads(spark, docs):
    from concurrent.futures import ThreadPoolExecutor

    root = tempfile.mkdtemp(prefix="ll-state6-") + "/frames"

    def write(i):
        return compute_frames_increment(spark, docs(spark, [f'k{i}\t{{"v": {i}}}', f'all\t{{"v": {i}}}']), root, attempts=50).count()

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(write, range(6))) == [2] * 6  # every writer's value of the common key is a change
    assert read_state(spark, root).count() == 7 and len(committed_versions(spark, root)) == 6


def test_a_number_that_was_ended_is_lost_however_late(spark, docs, monkeypatch):
    import linkloom.plans.incremental as incremental

    monkeypatch.setattr(incremental, "COMPACT_EVERY", 2)
    monkeypatch.setattr(incremental, "RETAIN_ROUNDS", 2)
    root = tempfile.mkdtemp(prefix="ll-state7-") + "/frames"
    late = incremental.begin_increment(spark, docs(spark, ['late\t{"v": 0}']), root)
    for i in range(8):
        compute_frames_increment(spark, docs(spark, [f'k{i}\t{{"v": {i}}}']), root)
    assert min(committed_versions(spark, root)) > 1  # the late round's record is gone by now
    assert late.commit() is None
    assert read_state(spark, root).count() == 8


def test_many_rounds_open_few_records(spark, docs, monkeypatch):
    """The log is read in one record a round, old rounds go, and a replay still finds its batch."""
    import linkloom.plans.incremental as incremental
    from linkloom.plans.state_log import StateLog

    monkeypatch.setattr(incremental, "COMPACT_EVERY", 4)
    monkeypatch.setattr(incremental, "RETAIN_ROUNDS", 10)
    monkeypatch.setattr(incremental, "BUCKET_ROWS", 10)
    opened = []
    read = StateLog.read
    monkeypatch.setattr(StateLog, "read", lambda self, name: opened.append(name) or read(self, name))
    root = tempfile.mkdtemp(prefix="ll-state8-") + "/frames"
    rounds = 100
    for i in range(rounds):
        out = compute_frames_increment(spark, docs(spark, [f'k{i}\t{{"v": 1}}', 'same\t{"v": 1}']), root, num_partitions=2, run_id="r", batch_id=i)
    assert out.count() == 1 and len(opened) < 1.1 * rounds
    opened.clear()
    assert compute_frames_increment(spark, docs(spark, ['other\t{"v": 1}']), root, run_id="r", batch_id=rounds - 5).count() == 1
    assert len(opened) == 1
    log = StateLog(spark, root)
    assert len(log.numbers()) <= 10 + 4 + 1 and len([n for n in log.names("") if n.startswith("version=")]) <= 10 + 4 + 1
    assert read_state(spark, root).count() == rounds + 1 and log.head()["buckets"] > 2


def test_state_side_is_not_shuffled(spark, docs):
    from linkloom.plans.buckets import bucketed_reader, write_bucketed
    from linkloom.plans.incremental import STATE_SCHEMA, changed_frames, hashed_frames

    root = tempfile.mkdtemp(prefix="ll-state9-")
    frames = docs(spark, [f'k{i}\t{{"v": {i}}}' for i in range(50)])
    hashed = hashed_frames(frames, unique_uris=True)
    for name, rows in (("snapshot", hashed.limit(30)), ("delta", hashed.limit(5))):
        write_bucketed(rows.select("uri_hex", "hash"), f"{root}/{name}", "uri_hex", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed_reader(spark, "uri_hex") as read:
            state = [read(f"{root}/{name}", STATE_SCHEMA, 4) for name in ("snapshot", "delta")]
            found = changed_frames(hashed, state, 4)
            assert found.count() == 20
            plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Bucketed: true") == 2 and plan.count("SortMergeJoin") == 2
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan  # of the frames
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("linkloom_")]


def test_many_rounds_read_the_events_once(spark, tmp_path, monkeypatch):
    import table_queries

    ids = [*range(95), -1, -41, None]
    rows = [(i, "click", 1, 0.5, "{}") for i in ids]
    spark.createDataFrame(rows, "event_id long, event_type string, user_id long, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    rounds = []

    def recorded(_spark, frames, _root, **_):
        rounds.append(frames)
        return frames

    monkeypatch.setattr(table_queries, "compute_frames_increment", recorded)
    monkeypatch.setattr(table_queries, "_state_rows", lambda spark, root, **_: spark.createDataFrame([], "uri string, round int"))
    table_queries.q_increment_many_rounds(spark, str(tmp_path))
    assert len(rounds) == 40
    assert not any("events.parquet" in f for r in rounds for f in r.inputFiles())
    assert {r.uri for r in rounds[0].collect()} == {"event/0", "event/40", "event/80", "event/-1", "event/-41"}
    assert {r.uri for r in rounds[15].collect()} == {f"event/{i}" for i in ids if i is not None and i % 40 in (14, 15) and i >= 0}
