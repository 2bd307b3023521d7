import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linkloom.session import checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="linkloom-tests")
    checkpoint_dir(s)
    yield s


def docs_of(spark, lines):
    from linkloom.sources import parse_keyed_lines

    return parse_keyed_lines(spark.createDataFrame([(line,) for line in lines], "value string"))


def as_dict(df):
    out = {}
    for row in df.collect():
        assert row.uri not in out, f"duplicate uri {row.uri}"
        out[row.uri] = json.loads(row.doc.toJson()) if row.doc is not None else None
    return out


@pytest.fixture
def docs():
    return docs_of


@pytest.fixture
def collect_docs():
    return as_dict
