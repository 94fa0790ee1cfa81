"""Location chains: a place text to name, detail and the rule that split it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import ROOM, collapse, is_missing

_ALONE = f"^{ROOM}$"


def _got(name: Column, detail: Column, rule: str) -> Column:
    return F.struct(F.trim(name).alias("name"), F.trim(detail).alias("detail"), F.lit(rule).alias("rule"))


def _sentinel(v: Column) -> Column:
    return F.when(is_missing(v), _got(F.lit(""), F.lit(""), "sentinel"))


def _detail_dash_name(v: Column) -> Column:
    p = r"^(.+?)\s+[-–—]\s+(.+)$"
    return F.when(v.rlike(p), _got(F.regexp_extract(v, p, 2), F.regexp_extract(v, p, 1), "detail_dash_name"))


def _slash_room(v: Column) -> Column:
    p = r"^(.*)/([^/]*)$"
    tail = F.trim(F.regexp_extract(v, p, 2))
    return F.when(tail.rlike(_ALONE) & (F.trim(F.regexp_extract(v, p, 1)) != ""), _got(F.regexp_extract(v, p, 1), tail, "slash_room"))


def _parenthetical(v: Column) -> Column:
    p = r"^(.*\S)\s*\(([^()]+)\)$"
    return F.when(v.rlike(p), _got(F.regexp_extract(v, p, 1), F.regexp_extract(v, p, 2), "parenthetical"))


def _comma_room(v: Column) -> Column:
    p = rf"(?i)^(.*\S)\s*,\s*(?:room|rm\.?|suite|ste\.?)?\s*({ROOM})$"
    return F.when(v.rlike(p), _got(F.regexp_extract(v, p, 1), F.regexp_extract(v, p, 2), "comma_room"))


def _unambiguous_room(v: Column) -> Column:
    """A room token at exactly one end; separators that are left at the cut go too; declines if nothing is left."""
    t = F.split(v, " ")
    first, last = F.element_at(t, 1).rlike(_ALONE), F.element_at(t, -1).rlike(_ALONE)
    clean = lambda x: F.regexp_replace(F.array_join(x, " "), r"^(?:[-–—,/]+(?: |$))+|(?:(?:^| )[-–—,/]+)+$", "")
    rest = F.when(first, clean(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))))).otherwise(clean(F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0)))))
    return F.when((first != last) & (F.trim(rest) != ""), _got(rest, F.when(first, F.element_at(t, 1)).otherwise(F.element_at(t, -1)), "unambiguous_room"))


RULES = {"sentinel": _sentinel, "detail_dash_name": _detail_dash_name, "slash_room": _slash_room, "parenthetical": _parenthetical, "comma_room": _comma_room, "unambiguous_room": _unambiguous_room}
DEFAULT = (*RULES, "whole")


def validate(chain: tuple[str, ...]) -> None:
    """'whole' comes last; what reads a room more surely comes before the rule for bare room tokens."""
    if not chain or chain[-1] != "whole" or set(chain) - {*RULES, "whole"}:
        raise ValueError("a chain ends with 'whole' and names known rules")
    if "unambiguous_room" in chain:
        before = chain[: chain.index("unambiguous_room")]
        if any(r in chain and r not in before for r in ("detail_dash_name", "slash_room", "parenthetical", "comma_room")):
            raise ValueError("'unambiguous_room' stands after the surer rules")


def parsed(raw: Column, chain: tuple[str, ...] = DEFAULT) -> Column:
    validate(chain)
    v = collapse(F.coalesce(raw, F.lit("")))
    return F.coalesce(F.when(v == "", _got(F.lit(""), F.lit(""), "declined")), *(RULES[r](v) for r in chain[:-1]), _got(v, F.lit(""), "whole"))
