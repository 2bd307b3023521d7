import pytest
from fixtures import FRAME, SETS

from linkloom import frame_documents

DOME = {"uri": "venue:dome", "a": "Venue", "name": "Dome", "town": "Graz", "seats": 1200}


@pytest.fixture
def catalogue(spark, docs):
    return {name: docs(spark, rows) for name, rows in SETS.items()}


def test_frame(catalogue, collect_docs):
    out = collect_docs(frame_documents(FRAME, catalogue))
    assert len(out) == 5
    main = {"uri": "stage:main", "a": "Stage", "venue": DOME}
    # explicit framing dropped a, uri and x:private before the show was embedded
    assert out["fest:array"]["act"] == [{"stage": main, "x:public": "yes"}]
    assert out["fest:array"]["sponsor"] == {"uri": "sponsor:b", "a": "Sponsor", "label": "Baker & sons"}
    string = out["fest:string"]
    assert [s["venue"]["name"] for s in string["act"]["stage"]] == ["Cellar", "Dome"]
    assert string["sponsor"] == {"@id": "sponsor:a", "uri": "sponsor:a", "a": "Sponsor"}
    # an object reference is overlaid, so it keeps its own uri and attributes
    assert out["fest:object"]["act"] == {"uri": "show:1", "slot": 3, "stage": main, "x:public": "yes"}
    assert len(out["fest:object"]["sponsor"]) == 2
    mixed = out["fest:two"]["act"][1]["stage"]
    assert mixed["@id"] == "stage:mixed" and [v["name"] for v in mixed["venue"]] == ["Dome", "Barge"]
    assert mixed["venue"][0]["door"] == "north" and "sponsor" not in out["fest:two"]
    assert out["fest:none"] == {"uri": "fest:none", "a": "Festival", "sponsor": "sponsor:lost"}


def test_frame_type_only_and_no_embed(catalogue, collect_docs):
    assert len(collect_docs(frame_documents({"@type": "Sponsor"}, catalogue))) == 2
    kept = collect_docs(frame_documents({"@type": "Festival", "sponsor": {"@type": "Sponsor", "@embed": False}}, catalogue))
    assert kept["fest:array"]["sponsor"] == "sponsor:b"


def test_frame_bad_nodes(catalogue):
    with pytest.raises(ValueError):
        frame_documents({"@type": "Festival", "sponsor": "Sponsor"}, catalogue)
    with pytest.raises(KeyError):
        frame_documents({"@type": "Nope"}, catalogue)


def test_frame_variants_agree(catalogue, collect_docs):
    plain = collect_docs(frame_documents(FRAME, catalogue))
    assert collect_docs(frame_documents(FRAME, catalogue, checkpoint_children=True)) == plain
    assert collect_docs(frame_documents(FRAME, catalogue, unique_uris=True)) == plain
    assert collect_docs(frame_documents(FRAME, catalogue, unique_types=["Show", "Venue"])) == plain
