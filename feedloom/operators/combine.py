"""Combined views over sources: set algebra, exact-match merge, divergences."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.predicate import compiled
from feedloom.functions.text import compare_form

REFUSED_KEYS = {"guid", "id"}
#: The fields of an event that are compared, in their order; instants as they are, the rest in compare form.
COMPARED = ("starts_at", "ends_at", "title", "speaker", "series", "location", "url", "content")
KEYS = {"starts_at", "ends_at", "title", "url", "location", "speaker"}


def compared(name: str) -> Column:
    """A field of an event as it is compared; the location is its name and detail."""
    if name in ("starts_at", "ends_at"):
        return F.col(name)
    place = F.concat(F.coalesce("location.name", F.lit("")), F.lit("|"), F.coalesce("location.detail", F.lit("")))
    return compare_form(place if name == "location" else F.coalesce(F.col(name).cast("string"), F.lit("")))


def details() -> dict[str, Column]:
    """What decides whether two events are the same: only what the feed says, nothing that was scraped at some time."""
    return {name: compared(name) for name in COMPARED}


def keyed_names(fields: Iterable[str]) -> list[str]:
    """The fields that bring events together for comparison; identifiers are refused, as is none at all."""
    if (wrong := sorted(set(fields) - KEYS)) or not list(fields):
        raise ValueError(f"{wrong} are no keys to merge by")
    return list(fields)


def keyed(fields: Iterable[str]) -> dict[str, Column]:
    return {name: compared(name) for name in keyed_names(fields)}


def chosen(df: DataFrame, include: Iterable[str] | str = "*", exclude: Iterable[str] = (), where: dict | None = None, exclude_where: dict | None = None) -> DataFrame:
    """Records of the included sources less the excluded ones that the clauses keep: filters only, so they reach the scan."""
    out = df if include == "*" else df.filter(F.col("source").isin(list(include)))
    if list(exclude):
        out = out.filter(~F.col("source").isin(list(exclude)))
    out = out.filter(compiled(where, df))
    return out.filter(~compiled(exclude_where, df)) if exclude_where else out


def merged(df: DataFrame, key: dict[str, Column], details: dict[str, Column], order: list[str], sets: tuple[str, ...] = ("sources",)) -> DataFrame:
    """One record for records whose key and all details are alike: the first in `order`, with the sorted union of each
    of the set columns and `n` records. One shuffle, partial before it; the survivor is a minimum, not a sort."""
    if set(key) & REFUSED_KEYS:
        raise ValueError("an identifier is no key to merge by")
    named = df.select("*", *(c.alias(f"_k_{n}") for n, c in key.items()), *(c.alias(f"_d_{n}") for n, c in details.items()))
    digest = F.sha2(F.to_json(F.struct(*(F.col(f"_d_{n}") for n in details)), {"ignoreNullFields": "false"}), 256)
    by = [f"_k_{n}" for n in key]
    columns = [c for c in df.columns if c not in sets]
    out = named.withColumn("_digest", digest).groupBy(*by, "_digest").agg(
        F.min_by(F.struct(*columns), F.struct(*order)).alias("_first"),
        *(F.array_sort(F.array_distinct(F.flatten(F.collect_set(s)))).alias(s) for s in sets),
        F.count("*").alias("n"),
    )
    return out.select("_first.*", *sets, "n", *(F.col(f"_k_{n}").alias(f"key_{n}") for n in key), "_digest")


def divergences(df: DataFrame, key: dict[str, Column], details: dict[str, Column], ident: str = "id") -> DataFrame:
    """Key groups whose details differ: the number of records, sorted ids, names of the differing fields. Counts of
    distinct values are sums over the distinct details of a key, so copies add nothing to a hot key."""
    named = df.select(F.col(ident).alias("_id"), *(c.alias(f"_k_{n}") for n, c in key.items()), *(c.alias(f"_d_{n}") for n, c in details.items()))
    by = [f"_k_{n}" for n in key]
    each = named.groupBy(*by, *(f"_d_{n}" for n in details)).agg(F.collect_list("_id").alias("ids"))
    differs = [F.when(F.min(f"_d_{n}").isNull() | (F.min(f"_d_{n}") != F.max(f"_d_{n}")) | (F.count(f"_d_{n}") < F.count("*")), F.lit(n)) for n in details]
    out = each.groupBy(*by).agg(F.count("*").alias("variants"), F.array_sort(F.flatten(F.collect_list("ids"))).alias("ids"), F.filter(F.array(*differs), lambda x: x.isNotNull()).alias("differing"))
    return out.filter("variants > 1").select(*(F.col(f"_k_{n}").alias(f"key_{n}") for n in key), "variants", "ids", "differing")
