"""JSON Schema compiled to expressions over parsed JSON (variants): every broken rule by its place, no row leaves the engine."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import let

#: Names of kinds as schemas have them, and how the engine names those of a parsed value.
KINDS = {"string": "^STRING$", "boolean": "^BOOLEAN$", "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$", "number": "^(BIGINT|DECIMAL|DOUBLE|FLOAT)", "null": "^VOID$", "array": "^ARRAY<", "object": "^OBJECT<"}
#: Formats that are checked; others are notes.
FORMATS = {
    "uri": r"^[A-Za-z][A-Za-z0-9+.-]*:\S*$", "date": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$", "email": r"^[^@\s]+@[^@\s]+$",
    "date-time": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])[Tt]([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$",
}
NOTES = {"$schema", "$id", "$defs", "$comment", "title", "description", "examples", "default"}
_NONE = "array<string>"


def _is(v: Column, kind: str) -> Column:
    return F.schema_of_variant(v).rlike(KINDS[kind])


def _as(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _property(name: str, each: Callable) -> Callable:
    return lambda m, at: F.when(F.map_contains_key(m, F.lit(name)), let(F.element_at(m, name), lambda y: each(y, F.concat(at, F.lit(f".{name}"))))).otherwise(F.array().cast(_NONE))


def _additional(known: list[str], each: Callable | None) -> Callable:
    def one(e: Column, at: Column) -> Column:
        place = F.concat(at, F.lit("."), e["key"])
        return F.array(F.concat(place, F.lit(": additionalProperties"))) if each is None else each(e["value"], place)

    return lambda m, at: F.flatten(F.transform(F.filter(F.map_entries(m), lambda e: ~e["key"].isin(known) if known else F.lit(True)), lambda e: one(e, at)))


class Contract:
    """Schemas by their $id; `errors` compiles one of them. What can't be compiled is refused before any plan is built."""

    def __init__(self, *documents: dict):
        self.documents = {d["$id"]: d for d in documents}

    def _found(self, ref: str, base: str) -> tuple[dict, str]:
        name, _, place = ref.partition("#")
        name = name or base
        if name not in self.documents:
            short = [k for k in self.documents if k.rsplit("/", 1)[-1] == name.rsplit("/", 1)[-1]]
            if len(short) != 1:
                raise ValueError(f"no schema {ref!r}")
            name = short[0]
        node = self.documents[name]
        for step in filter(None, place.split("/")):
            if step not in node:
                raise ValueError(f"no schema {ref!r}")
            node = node[step]
        return node, name

    def errors(self, ident: str, value: Column) -> Column:
        """The rules that a value (a variant) breaks, as 'place: keyword', sorted; a null value (no JSON) breaks `json`."""
        node, base = self._found(ident, ident)
        rules = self._compiled(node, base, (), ())
        return let(value, lambda v: F.when(v.isNull(), F.array(F.lit("$: json"))).otherwise(F.array_sort(F.array_distinct(rules(v, F.lit("$"))))))

    def _compiled(self, node: dict | bool, base: str, seen: tuple, path: tuple) -> Callable[[Column, Column], Column]:
        """(value, place) to an array of what is broken."""
        if node is True or node is False:
            return lambda v, at: F.array(F.concat(at, F.lit(": false"))) if node is False else F.array().cast(_NONE)
        parts: list[Callable[[Column, Column], Column]] = []
        of_fields: list[Callable[[Column, Column], Column]] = []  # of an object's fields as a map, which is made once

        def rule(keyword: str, kind: str | None, ok: Callable[[Column], Column]) -> None:
            def one(v, at):
                bad = ~F.coalesce(ok(v), F.lit(False))
                bad = bad & _is(v, kind) if kind else bad
                return F.when(bad, F.array(F.concat(at, F.lit(f": {keyword}")))).otherwise(F.array().cast(_NONE))

            parts.append(one)

        def inner(sub, more=()) -> Callable:
            return self._compiled(sub, base, seen, (*path, *more))

        holds = lambda sub: (lambda f: lambda v: F.size(f(v, F.lit(""))) == 0)(inner(sub))
        text, items, fields = (lambda v, k=k: _as(v, k) for k in ("string", "array<variant>", "map<string,variant>"))
        for key, x in node.items():
            if key in NOTES or key in ("then", "else"):
                continue
            if key == "$ref":
                sub, name = self._found(x, base)
                if (x, base) in seen:
                    raise ValueError(f"the schema {x!r} holds itself")
                parts.append(self._compiled(sub, name, (*seen, (x, base)), path))
            elif key == "type":
                kinds = x if isinstance(x, list) else [x]
                rule(key, None, lambda v, kinds=kinds: reduce(or_, [_is(v, k) for k in kinds]))
            elif key in ("enum", "const"):
                given = x if key == "enum" else [x]
                texts = [y for y in given if isinstance(y, str)]
                rest = [F.to_json(F.parse_json(F.lit(json.dumps(y)))) for y in given if not isinstance(y, str)]
                rule(key, None, lambda v, texts=texts, rest=rest: F.when(_is(v, "string"), _as(v, "string").isin(texts or [None])).otherwise(reduce(or_, [F.to_json(v) == r for r in rest], F.lit(False))))
            elif key == "pattern":
                rule(key, "string", lambda v, x=x: text(v).rlike(x))
            elif key == "format":
                if x in FORMATS:
                    rule(key, "string", lambda v, x=x: text(v).rlike(FORMATS[x]))
            elif key in ("minLength", "maxLength"):
                rule(key, "string", lambda v, x=x, key=key: F.length(text(v)) >= x if key == "minLength" else F.length(text(v)) <= x)
            elif key in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
                test = {"minimum": lambda n, x: n >= x, "maximum": lambda n, x: n <= x, "exclusiveMinimum": lambda n, x: n > x, "exclusiveMaximum": lambda n, x: n < x}[key]
                rule(key, "number", lambda v, x=x, test=test: test(_as(v, "double"), x))
            elif key in ("minItems", "maxItems"):
                rule(key, "array", lambda v, x=x, key=key: F.size(items(v)) >= x if key == "minItems" else F.size(items(v)) <= x)
            elif key == "uniqueItems":
                if x:
                    rule(key, "array", lambda v: F.size(F.array_distinct(F.transform(items(v), lambda y: F.to_json(y)))) == F.size(items(v)))
            elif key == "items":
                each = inner(x)
                parts.append(lambda v, at, each=each: F.when(_is(v, "array"), F.flatten(F.transform(items(v), lambda y: each(y, F.concat(at, F.lit("[]")))))).otherwise(F.array().cast(_NONE)))
            elif key == "required":
                for name in x:
                    of_fields.append(lambda m, at, name=name: F.when(~F.map_contains_key(m, F.lit(name)), F.array(F.concat(at, F.lit(f".{name}: required")))).otherwise(F.array().cast(_NONE)))
            elif key == "properties":
                for name, sub in x.items():
                    of_fields.append(_property(name, inner(sub, (name,))))
            elif key == "additionalProperties":
                if x is not True:
                    of_fields.append(_additional(sorted(node.get("properties", {})), None if x is False else inner(x)))
            elif key == "allOf":
                parts.extend(inner(sub) for sub in x)
            elif key == "anyOf":
                tests = [holds(sub) for sub in x]
                rule(key, None, lambda v, tests=tests: reduce(or_, [t(v) for t in tests]))
            elif key == "oneOf":
                tests = [holds(sub) for sub in x]
                rule(key, None, lambda v, tests=tests: reduce(lambda a, b: a + b, [t(v).cast("int") for t in tests]) == 1)
            elif key == "not":
                test = holds(x)
                rule(key, None, lambda v, test=test: ~test(v))
            elif key == "if":
                test, yes, no = holds(x), inner(node.get("then", True)), inner(node.get("else", True))
                parts.append(lambda v, at, test=test, yes=yes, no=no: F.when(test(v), yes(v, at)).otherwise(no(v, at)))
            else:
                raise ValueError(f"the keyword {key!r} at {'/'.join(path) or '/'} is not compiled")
        if of_fields:
            whole = lambda m, at: F.flatten(F.array(*(p(m, at) for p in of_fields)))
            parts.append(lambda v, at: F.when(_is(v, "object"), let(fields(v), lambda m: whole(m, at))).otherwise(F.array().cast(_NONE)))
        return lambda v, at: F.flatten(F.array(*(p(v, at) for p in parts))) if parts else F.array().cast(_NONE)
