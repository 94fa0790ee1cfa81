"""The published contract: schemas of an event and of a feed, made from the names on the wire, and their validation."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.schema import Contract
from feedloom.plans.publish import WIRE

#: Patterns, enumerations and requirements of the published contract.
SLUG, IDENT, INSTANT, WALL = r"^[a-z0-9][a-z0-9-]*$", r"^[a-z0-9][a-z0-9-]*:.+$", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"
REQUIRED = "id guid sources platform startsAt endsAt startTime endTime timezone title location urlRef cancelled bannerImage itemType".split()
TITLE_SOURCES = ["ics", "enriched", "fallback-speaker", "fallback-template", "fallback-series", None]
_TEXT, _SLUGS = {"type": "string"}, {"type": "array", "uniqueItems": True, "items": {"type": "string", "pattern": SLUG}}


def _closed(*names: str) -> dict:
    return {"type": "object", "additionalProperties": False, "required": list(names), "properties": dict.fromkeys(names, _TEXT)}


def event_schema(base: str = "", platforms: list[str] | None = None) -> dict:
    """The schema of an event. Fields are texts unless said otherwise."""
    own = {
        "id": {"type": "string", "pattern": IDENT}, "guid": {"type": "string", "minLength": 1}, "sources": _SLUGS | {"minItems": 1}, "timezone": {"type": "string", "minLength": 1}, "title": {"type": "string", "minLength": 1},
        "platform": {"type": "string", "enum": platforms} if platforms else _TEXT, "startsAt": {"type": "string", "pattern": INSTANT}, "endsAt": {"type": "string", "pattern": INSTANT},
        "startTime": {"type": "string", "pattern": WALL}, "endTime": {"type": "string", "pattern": WALL}, "speakers": {"type": "array", "items": _closed("name", "affiliation")}, "tags": _SLUGS, "purposes": _SLUGS,
        "rawCategories": {"type": "array", "items": _TEXT}, "unmappedTags": {"type": "array", "items": _TEXT}, "location": _closed("name", "id", "detail"), "urlRef": {"type": "string", "format": "uri"},
        "itemType": {"type": "string", "enum": ["advertisement"]}, "mappingRules": {"type": "array", "items": _TEXT}, "titleSource": {"type": ["string", "null"], "enum": TITLE_SOURCES},
        "titleIsPlaceholder": {"type": "boolean"}, "mappingConflict": {"type": "boolean"},
    }
    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "$id": f"{base}event.schema.json", "type": "object", "additionalProperties": False, "required": REQUIRED, "properties": {n: own.get(n, _TEXT) for n in WIRE}}


def feed_schema(base: str = "") -> dict:
    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "$id": f"{base}events.schema.json", "type": "array", "items": {"$ref": f"{base}event.schema.json"}}


def files(base: str = "") -> dict[str, str]:
    """The schemas as they are published beside the feeds."""
    return {f"schema/{s['$id'].rsplit('/', 1)[-1]}": json.dumps(s, indent=2) + "\n" for s in (event_schema(base), feed_schema(base))}


def broken(wires: DataFrame, wire: str = "wire", contract: Contract | None = None, ident: str = "event.schema.json") -> DataFrame:
    """wires with `errors`, the rules that the JSON of a column breaks; those that break none are left out."""
    contract = contract or Contract(event_schema(), feed_schema())
    got = wires.withColumn("errors", contract.errors(ident, F.try_parse_json(wire)))
    return got.filter(F.size("errors") > 0)


def errors_by_rule(wires: DataFrame, by: list[str], wire: str = "wire", contract: Contract | None = None) -> DataFrame:
    """(by, rule, errors): only what is broken is taken apart."""
    each = broken(wires, wire, contract).select(*by, F.explode("errors").alias("rule"))
    return each.groupBy(*by, "rule").agg(F.count("*").alias("errors"))
