"""Where clauses (mappings) compiled to one Column; names are checked before any plan is built."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import compare_form, compare_text

OPS = ("contains", "not_contains", "equals", "not_equals", "in", "not_in", "matches", "before", "after")


def validate(where: dict, df: DataFrame) -> None:
    for field, tests in where.items():
        if field.split(".")[0] not in df.columns:
            raise ValueError(f"unknown field {field!r}")
        for op in tests:
            if op not in OPS:
                raise ValueError(f"unknown operation {op!r}")


def check(where: dict | None, tags: set[str] | None = None, purposes: set[str] | None = None) -> None:
    """Refuses, before any table is there, tests that don't exist, and tags and purposes that nobody declared."""
    for field, tests in (where or {}).items():
        for op, value in tests.items():
            if op not in OPS:
                raise ValueError(f"unknown operation {op!r}")
            known = {"tags": tags, "purposes": purposes}.get(field)
            if known is not None and op != "matches":
                unknown = sorted(set(value if isinstance(value, (list, tuple)) else [value]) - known)
                if unknown:
                    raise ValueError(f"unknown {field} {unknown}")


def _one(c: Column, many: bool, op: str, value) -> Column:
    if op.startswith("not_"):
        return ~_one(c, many, op[4:], value)
    if op == "contains":
        return F.array_contains(c, value) if many else c.contains(value)
    if op == "equals":
        return compare_form(c) == F.lit(compare_text(value))
    if op == "in":
        return F.arrays_overlap(c, F.array(*(F.lit(v) for v in value))) if many else c.isin(list(value))
    if op == "matches":
        return c.rlike(f"(?iu){value}")
    return (c != "") & ((c < value) if op == "before" else (c > value))


def compiled(where: dict | None, df: DataFrame) -> Column:
    """All tests of all fields hold. An empty clause holds always."""
    validate(where or {}, df)
    tests = []
    for field, ops in (where or {}).items():
        many = isinstance(df.schema[field.split(".")[0]].dataType, T.ArrayType)
        c = F.col(field) if many else F.coalesce(F.col(field).cast("string"), F.lit(""))
        tests += [F.coalesce(_one(c, many, op, v), F.lit(False)) for op, v in ops.items()]
    return reduce(and_, tests, F.lit(True))


def selected(df: DataFrame, where: dict | None = None, unless: dict | None = None) -> Column:
    """Kept by a feed's own clauses: where holds, and unless (if there is one) doesn't."""
    keep = compiled(where, df)
    return keep & ~compiled(unless, df) if unless else keep
