from linkloom import (
    expand_lists, filter_by_class, link_merge, links_from_documents, project_keys, resolve_links, self_links,
    split_by_classes,
)
from linkloom.sources import split_link_documents


def test_links_identity_and_first_match(spark, docs):
    import pytest

    good = [
        '{"uri": "s1", "matches": [{"uri": "b1", "score": 0.1}, {"uri": "b9", "score": 0.9}]}',
        '{"uri": "same", "matches": [{"uri": "same"}]}',
    ]
    bad = ['{"uri": "nomatch", "matches": []}', 'k\t{"matches": [{"uri": "x"}]}', '{"uri": "number", "matches": [{"uri": 5}]}']
    rows = {(r.source_uri, r.base_uri) for r in links_from_documents(docs(spark, good)).collect()}
    assert rows == {("s1", "b1")}
    kept = {(r.source_uri, r.base_uri) for r in links_from_documents(docs(spark, good), keep_identity=True).collect()}
    assert kept == {("s1", "b1"), ("same", "same")}
    links, rejected = split_link_documents(docs(spark, good + bad))
    assert [r.source_uri for r in links.collect()] == ["s1"] and sorted(r.uri for r in rejected.collect()) == ["k", "nomatch", "number"]
    with pytest.raises(Exception, match="both ends"):
        links_from_documents(docs(spark, bad[:1])).collect()


def test_one_source_several_bases(spark, docs, collect_docs):
    link_docs = docs(spark, ['{"uri": "s", "matches": [{"uri": "%s"}]}' % b for b in ("b2", "b1", "a-absent", "b2")])
    base = docs(spark, ['b1\t{"uri": "b1", "n": 1}', 'b2\t{"uri": "b2", "n": 2}'])
    resolved = sorted((r.uri, r.doc.toJson()) for r in resolve_links(links_from_documents(link_docs), base).collect())
    assert resolved == [("s", '{"n":1,"uri":"b1"}'), ("s", '{"n":2,"uri":"b2"}')]  # every link to an existing base
    merged = collect_docs(link_merge(docs(spark, ['d\t{"r": "s"}']), "r", base, link_docs))
    assert merged["d"]["r"] == {"uri": "b1", "n": 1}  # the smallest of those that exist


def test_self_links(spark, docs, collect_docs):
    src = docs(spark, ['u1\t{"a": 1}', 'u2\t{"a": 2}'])
    out = collect_docs(self_links(src))
    assert out == {"u1": {"uri": "u1", "matches": [{"uri": "u1"}]}, "u2": {"uri": "u2", "matches": [{"uri": "u2"}]}}
    # identity links are dropped by default, so they merge nothing ...
    assert links_from_documents(self_links(src)).count() == 0
    # ... but kept on request they resolve each uri to itself
    links = links_from_documents(self_links(src), keep_identity=True)
    merged = collect_docs(link_merge(docs(spark, ['d\t{"r": ["u1", "u2"]}']), "r", src, links))
    assert merged["d"]["r"] == [{"a": 1}, {"a": 2}]


TYPED = [
    'c1\t{"a": "Customer"}',
    'c2\t{"a": ["Agent", "schema:Customer"]}',
    'c3\t{"@type": "Customer"}',
    'c4\t{"a": "Other", "@type": "Customer"}',  # a wins over @type
    'c5\t{"name": "none"}',
    'c6\t"just a string"',
    'c7\t{"a": 5}',
    'c8\t{"a": [{"x": 1}, "Customer"]}',
]


def test_filter_by_class(spark, docs):
    got = {r.uri for r in filter_by_class(docs(spark, TYPED), "Customer", "schema:Customer").collect()}
    assert got == {"c1", "c2", "c3", "c8"}
    short_only = {r.uri for r in filter_by_class(docs(spark, TYPED), "Customer").collect()}
    assert short_only == {"c1", "c3", "c8"}


def test_split_by_classes(spark, docs):
    parts = split_by_classes(docs(spark, TYPED), [{"name": "Customer", "uri": "schema:Customer"}, {"name": "Agent", "uri": "x:Agent"}])
    assert {r.uri for r in parts["Agent"].collect()} == {"c2"}
    assert "c2" in {r.uri for r in parts["Customer"].collect()}


def test_project_and_expand(spark, docs, collect_docs):
    src = docs(spark, ['u\t{"a": "T", "uri": "u", "keep": 1, "drop": 2}', 'v\t[{"x": 1}, {"x": 2}]', 'w\t[]', 'z\t"s"'])
    proj = collect_docs(project_keys(src, ["keep", "@type"]))
    assert proj["u"] == {"keep": 1} and proj["v"] == [{"x": 1}, {"x": 2}]
    rows = sorted((r.uri, r.doc.toJson()) for r in expand_lists(src).collect())
    assert rows == [("u", '{"a":"T","drop":2,"keep":1,"uri":"u"}'), ("v", '{"x":1}'), ("v", '{"x":2}'), ("z", '"s"')]
