import tempfile

from linkloom.streaming import start_increment_stream


def test_increment_stream(spark, docs):
    root = tempfile.mkdtemp(prefix="ll-stream-")
    src = root + "/in"
    docs(spark, ['a\t{"v": 1}', 'b\t{"v": 2}']).write.parquet(src + "/p1")
    schema = spark.read.parquet(src + "/p1").schema
    seen = []

    def sink(df, batch_id):
        seen.extend((batch_id, r.uri) for r in df.collect())

    stream = spark.readStream.schema(schema).parquet(src + "/*")
    q = start_increment_stream(stream, root + "/state", sink, root + "/ckpt")
    try:
        q.processAllAvailable()
        docs(spark, ['a\t{"v": 1}', 'b\t{"v": 5}', 'c\t{"v": 3}']).write.parquet(src + "/p2")
        q.processAllAvailable()
    finally:
        q.stop()
    first = sorted(u for b, u in seen if b == 0)
    later = sorted(u for b, u in seen if b > 0)
    assert first == ["a", "b"] and later == ["b", "c"]


def test_new_checkpoint_goes_on_from_the_state(spark, docs):
    root = tempfile.mkdtemp(prefix="ll-stream2-")
    seen = []

    def sink(df, batch_id):
        seen.append(sorted(r.uri for r in df.collect()))

    for name, rows in (("one", ['a\t{"v": 1}']), ("two", ['a\t{"v": 1}', 'z\t{"v": 2}'])):
        docs(spark, rows).write.parquet(f"{root}/{name}")
        stream = spark.readStream.schema("uri string, doc variant").parquet(f"{root}/{name}")
        q = start_increment_stream(stream, root + "/state", sink, f"{root}/ckpt-{name}")
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    assert seen == [["a"], ["z"]]


def test_merge_stream(spark, docs):
    import json

    from linkloom.streaming import start_merge_stream

    root = tempfile.mkdtemp(prefix="ll-mstream-")
    docs(spark, ['a\t{"r": "b1"}', 'c\t{"r": ["b1", "zz"]}']).write.parquet(root + "/in/p1")
    schema = spark.read.parquet(root + "/in/p1").schema
    base = docs(spark, ['b1\t{"uri": "b1", "n": 1}'])
    seen = {}

    def sink(df, batch_id):
        seen.update({r.uri: json.loads(r.doc.toJson()) for r in df.collect()})

    q = start_merge_stream(spark.readStream.schema(schema).parquet(root + "/in/*"), "r", base, sink, root + "/ckpt")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert seen == {"a": {"r": {"uri": "b1", "n": 1}}, "c": {"r": [{"uri": "b1", "n": 1}, "zz"]}}
