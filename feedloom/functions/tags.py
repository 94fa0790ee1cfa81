"""Tags by a vocabulary of spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import tag_key


def aliases(vocabulary: dict[str, list[str]]) -> dict[str, str]:
    """Spelling to tag; a spelling of two tags is refused."""
    out: dict[str, str] = {}
    for tag, spellings in vocabulary.items():
        for s in (tag, *spellings):
            if out.setdefault(s.lower(), tag) != tag:
                raise ValueError(f"{s!r} is a spelling of {out[s.lower()]!r} and of {tag!r}")
    return out


def normalized(candidates: Column, alias: dict[str, str]) -> Column:
    """struct(tags, unmapped): sorted distinct tags, and what has none, in order and with repeats."""
    names = F.create_map(*(F.lit(x) for kv in alias.items() for x in kv)) if alias else F.lit(None).cast("map<string,string>")
    tag = lambda c: F.try_element_at(names, tag_key(c))
    known = F.array_sort(F.array_distinct(F.filter(F.transform(candidates, tag), lambda x: x.isNotNull())))
    rest = F.filter(F.transform(candidates, lambda c: F.trim(c)), lambda c: (c != "") & tag(c).isNull())
    return F.struct(known.alias("tags"), rest.alias("unmapped"))
