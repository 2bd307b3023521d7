"""Own sample documents: a concert programme (keyed JSON lines, TAB separated).

They cover a reference given as a string, as an object with ``uri`` or ``@id``, in an
array, in an array of both kinds and not at all; uris without a scheme; documents
that embed what the base describes anew; repeated list elements; explicit framing.
"""

import json


def keyed(*documents):
    return [f"{d['uri']}\t{json.dumps(d)}" for d in documents]


VENUES = keyed(
    {"uri": "venue:cellar", "a": "Venue", "name": "Cellar", "town": "Brno", "seats": 80},
    {"uri": "venue:dome", "a": "Venue", "name": "Dome", "town": "Graz", "seats": 1200},
    {"uri": "barge", "a": "Venue", "name": "Barge", "town": "Linz"},
)

SHOWS = keyed(
    {"uri": "show:1", "a": "Show", "held": {"venue": "venue:dome", "hour": 20}},
    {"uri": "show:2", "a": "Show", "held": {"venue": {"@id": "barge", "floor": 2}}},
    {"uri": "show:3", "a": "Show", "held": [{"venue": ["venue:cellar", {"uri": "venue:dome"}]}, {"venue": "venue:unknown"}]},
    {"uri": "show:4", "a": "Show"},
)

# shows that name venues by the ticket office's own codes, and what those codes mean
SHOWS_BY_CODE = keyed(
    {"uri": "show:1", "held": {"venue": {"uri": "office/77", "gate": "B", "phone": "old"}}},
    {"uri": "show:2", "held": {"venue": "office/78"}},
    {"uri": "show:3", "held": {"venue": "office/79"}},
)
CODES = [
    json.dumps({"uri": "office/77", "matches": [{"uri": "venue:dome", "score": 0.8}, {"uri": "venue:cellar", "score": 0.1}]}),
    json.dumps({"uri": "office/78", "matches": [{"uri": "barge"}]}),
    json.dumps({"uri": "office/79", "matches": [{"uri": "venue:closed"}]}),
]

EMBEDDED = keyed(
    {"uri": "show:1", "held": {"venue": {"uri": "venue:dome", "name": "Dom", "seats": 900, "lift": True}}},
    {"uri": "show:2", "held": {"venue": [{"uri": "barge", "name": "Barge"}, {"uri": "venue:cellar", "name": "Celar"}]}},
)

CASTS = keyed(
    {"uri": "show:1", "crew": {"cast": [{"role": "Ada", "n": 1}, {"role": "Bo", "n": 2}, {"n": 1, "role": "Ada"}]}},
    {"uri": "show:2", "crew": {"cast": [{"role": "Cy"}, {"role": "Di"}]}},
    {"uri": "show:3", "crew": [{"cast": ["Eve", "Eve"]}, {"cast": "Eve"}]},
)

FRAME = {
    "@type": "Festival",
    "act": {"@type": "Show", "@explicit": True, "stage": {"@type": "Stage", "venue": {"@type": "Venue"}}, "x:public": {}},
    "sponsor": {"@type": "Sponsor"},
}
FESTIVALS = keyed(
    {"uri": "fest:array", "a": "Festival", "act": ["show:1"], "sponsor": "sponsor:b"},
    {"uri": "fest:string", "a": "Festival", "act": "show:2", "sponsor": {"@id": "sponsor:a"}},
    {"uri": "fest:object", "a": "Festival", "act": {"uri": "show:1", "slot": 3}, "sponsor": ["sponsor:a", "sponsor:b"]},
    {"uri": "fest:two", "a": "Festival", "act": ["show:2", "show:3"]},
    {"uri": "fest:none", "a": "Festival", "sponsor": "sponsor:lost"},
)
FRAME_SHOWS = keyed(
    {"uri": "show:1", "a": "Show", "stage": "stage:main", "x:public": "yes", "x:private": "no"},
    {"uri": "show:2", "a": "Show", "stage": ["stage:side", {"uri": "stage:main"}], "x:public": "yes", "x:private": "no"},
    {"uri": "show:3", "a": "Show", "stage": {"@id": "stage:mixed"}, "x:public": "yes", "x:private": "no"},
)
STAGES = keyed(
    {"uri": "stage:main", "a": "Stage", "venue": {"uri": "venue:dome"}},
    {"uri": "stage:side", "a": "Stage", "venue": "venue:cellar"},
    {"uri": "stage:mixed", "a": "Stage", "venue": [{"uri": "venue:dome", "door": "north"}, "barge"]},
)
SPONSORS = keyed({"uri": "sponsor:a", "a": "Sponsor"}, {"uri": "sponsor:b", "a": "Sponsor", "label": "Baker & sons"})

SETS = {"Festival": FESTIVALS, "Show": FRAME_SHOWS, "Stage": STAGES, "Venue": VENUES, "Sponsor": SPONSORS}
