"""The schema compiler: each keyword with what it lets through and what it doesn't, and every schema of the contract."""

import json

import pytest
from pyspark.sql import functions as F

from feedloom.functions.schema import Contract
from feedloom.plans import contract

A = {"$id": "a.json", "$defs": {"name": {"type": "string", "minLength": 2}}, "type": "object", "required": ["n"], "additionalProperties": {"type": "integer"}, "properties": {
    "n": {"$ref": "#/$defs/name"}, "l": {"type": "array", "minItems": 1, "maxItems": 3, "uniqueItems": True, "items": {"$ref": "b.json"}}, "e": {"enum": ["x", 1, None, [2]]}, "c": {"const": True},
    "d": {"format": "date-time"}, "u": {"type": ["string", "null"], "format": "uri", "maxLength": 8}, "k": {"minimum": 1, "exclusiveMaximum": 2.5}, "o": {"oneOf": [{"type": "string"}, {"minimum": 3}]},
    "i": {"if": {"required": ["p"]}, "then": {"required": ["q"]}, "else": {"not": {"required": ["q"]}}}, "a": {"allOf": [{"minimum": 1}, {"maximum": 4}], "anyOf": [{"type": "integer"}, {"type": "null"}]}, "f": False,
}}
B = {"$id": "http://x/b.json", "type": ["string", "number"], "pattern": "b$"}
CASES = [
    ({"n": "ab"}, []), ({"n": "a"}, ["$.n: minLength"]), ({}, ["$.n: required"]), ([], ["$: type"]), ({"n": 3}, ["$.n: type"]), ({"n": "ab", "z": 1, "y": "1"}, ["$.y: type"]),
    ({"n": "ab", "l": ["b", "ab", 4]}, []), ({"n": "ab", "l": []}, ["$.l: minItems"]), ({"n": "ab", "l": ["b", "b", 1, 2]}, ["$.l: maxItems", "$.l: uniqueItems"]), ({"n": "ab", "l": ["c", True]}, ["$.l[]: pattern", "$.l[]: type"]),
    ({"n": "ab", "e": "x"}, []), ({"n": "ab", "e": 1}, []), ({"n": "ab", "e": None}, []), ({"n": "ab", "e": [2]}, []), ({"n": "ab", "e": "1"}, ["$.e: enum"]), ({"n": "ab", "c": True}, []), ({"n": "ab", "c": False}, ["$.c: const"]),
    ({"n": "ab", "d": "2026-01-02T03:04:05Z"}, []), ({"n": "ab", "d": "2026-13-02T03:04:05Z"}, ["$.d: format"]), ({"n": "ab", "d": 7}, []), ({"n": "ab", "u": None}, []), ({"n": "ab", "u": "a:b c"}, ["$.u: format"]), ({"n": "ab", "u": "http://long"}, ["$.u: maxLength"]),
    ({"n": "ab", "k": 1}, []), ({"n": "ab", "k": 2.4}, []), ({"n": "ab", "k": 0.5}, ["$.k: minimum"]), ({"n": "ab", "k": 2.5}, ["$.k: exclusiveMaximum"]), ({"n": "ab", "o": 4}, []), ({"n": "ab", "o": 1}, ["$.o: oneOf"]), ({"n": "ab", "o": "t"}, ["$.o: oneOf"]),
    ({"n": "ab", "i": {"p": 1, "q": 2}}, []), ({"n": "ab", "i": {"p": 1}}, ["$.i.q: required"]), ({"n": "ab", "i": {"q": 1}}, ["$.i: not"]), ({"n": "ab", "i": {}}, []), ({"n": "ab", "a": 2}, []), ({"n": "ab", "a": 2.5}, ["$.a: anyOf"]), ({"n": "ab", "a": 7}, ["$.a: maximum"]),
    ({"n": "ab", "f": 1}, ["$.f: false"]),
]


def test_keywords(spark):
    rows = [(i, json.dumps(v)) for i, (v, _) in enumerate(CASES)] + [(98, "{broken"), (99, None)]
    df = spark.createDataFrame(rows, "i int, j string")
    got = {r.i: r.e for r in df.select("i", Contract(A, B).errors("a.json", F.try_parse_json("j")).alias("e")).collect()}
    assert got.pop(98) == got.pop(99) == ["$: json"]
    assert {i: (v, got[i]) for i, (v, want) in enumerate(CASES) if got[i] != want} == {}


def test_what_cannot_be_compiled_is_refused(spark):
    v = F.lit(None).cast("variant")
    for bad in ({"patternProperties": {}}, {"$ref": "none.json"}, {"$ref": "#/$defs/none"}, {"items": {"$ref": "#"}}):
        with pytest.raises(ValueError):
            Contract({"$id": "x.json", **bad}).errors("x.json", v)


def test_the_contract(spark):
    """Each schema with a passing and a failing text."""
    event = dict.fromkeys(contract.WIRE, "") | {"id": "a:1", "guid": "1", "sources": ["a"], "startsAt": "2026-01-01T00:00:00Z", "endsAt": "2026-01-01T00:00:00Z", "startTime": "2026-01-01T00:00:00", "endTime": "2026-01-01T00:00:00", "timezone": "UTC", "title": "T", "speakers": [{"name": "n", "affiliation": ""}], "tags": ["x"], "purposes": [], "rawCategories": [], "unmappedTags": [], "location": {"name": "", "id": "", "detail": ""}, "urlRef": "http://u", "itemType": "advertisement", "mappingRules": ["a:r"], "titleSource": None, "titleIsPlaceholder": False, "mappingConflict": False}
    bad = event | {"tags": ["x", "x", "No"], "titleSource": "guess", "speakers": [{"name": "n"}], "location": {"name": "", "id": "", "detail": "", "z": ""}}
    del bad["guid"]
    made = Contract(contract.event_schema(), contract.feed_schema())
    rows = [("event.schema.json", event), ("event.schema.json", bad), ("events.schema.json", [event]), ("events.schema.json", [event, bad]), ("events.schema.json", event)]
    got = [spark.createDataFrame([(json.dumps(v),)], "j string").select(made.errors(i, F.parse_json("j")).alias("e")).first().e for i, v in rows]
    broken = sorted(["$.guid: required", "$.location.z: additionalProperties", "$.speakers[].affiliation: required", "$.tags: uniqueItems", "$.tags[]: pattern", "$.titleSource: enum"])
    assert got == [[], broken, [], sorted(x.replace("$", "$[]", 1) for x in broken), ["$: type"]]
    assert {json.loads(v)["$id"] for v in contract.files().values()} == {"event.schema.json", "events.schema.json"}
