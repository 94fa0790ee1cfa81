"""The edition query: a calendar window, purposes, readiness, collisions, days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import timex
from feedloom.functions.text import fold


def resolved(publication: Column, start: tuple[str, int], end: tuple[str, int], weekday: int, time: str = "12:00:00", deadline: tuple[str, int, str] | None = None) -> dict[str, Column]:
    """Coverage bounds, publication and deadline as wall-clock texts, and whether the publication day is off schedule. A
    window that ends before it starts is an error. deadline: anchor, offset, time; without one it is null."""
    first, last = timex.anchor(start[0], publication, start[1]), timex.anchor(end[0], publication, end[1])
    day = lambda d: F.date_format(d, "yyyy-MM-dd")
    last = F.when(last >= first, last).otherwise(F.raise_error(F.lit("the coverage window ends before it starts")).cast("date"))
    return {
        "coverage_start": F.concat(day(first), F.lit("T00:00:00")),
        "coverage_end": F.concat(day(last), F.lit("T23:59:59")),
        "publication_at": F.concat(day(publication), F.lit(f"T{time}")),
        "deadline_at": F.concat(day(timex.anchor(deadline[0], publication, deadline[1])), F.lit(f"T{deadline[2]}")) if deadline else F.lit(None).cast("string"),
        "shifted": publication != F.date_add(timex.week_start(publication), weekday),
    }


def dropped(included: DataFrame, drop: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """What an editor keeps and what they took out by hand (drop: the key)."""
    ids = drop.select(key).distinct()
    return included.join(ids, key, "left_anti"), included.join(ids, key, "left_semi")


def bucket(start_time: Column, purposes: Column, purpose: str | None, lo: Column, hi: Column) -> Column:
    """struct(bucket, reason): malformed starts, then purposes, then the window (both ends inside)."""
    pair = lambda b, r: F.struct(F.lit(b).alias("bucket"), F.lit(r).alias("reason"))
    out = F.when(~F.coalesce(start_time.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"), F.lit(False)), pair("malformed", "Has no readable start"))
    if purpose:
        out = out.when(~F.coalesce(F.array_contains(purposes, purpose), F.lit(False)), pair("excluded", f"Does not serve {purpose}"))
    return out.when(start_time.between(lo, hi), pair("included", "")).when(start_time < lo, pair("excluded", "Starts before the window")).otherwise(pair("excluded", "Starts after the window"))


def in_editions(events: DataFrame, editions: DataFrame, start: str = "start_time", days: int = 7) -> DataFrame:
    """Every event with every edition (edition, coverage_start, coverage_end as wall-clock texts) whose window holds its
    start, both ends inside: all editions of a year at once.

    A window is spread over the stretches of `days` days that it touches, an event lies in one of them, so the join is on
    the stretch and the bounds are checked within it: one row of an edition for each stretch, no loop over all pairs.
    Adaptive execution splits a stretch with many events. Unreadable starts are in none."""
    stretch = lambda c: F.floor(F.unix_date(F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")) / days)
    wide = editions.withColumn("_stretch", F.explode(F.sequence(stretch("coverage_start"), stretch("coverage_end"))))
    named = events.withColumn("_stretch", stretch(start))
    return named.join(wide, "_stretch").filter(F.col(start).between(F.col("coverage_start"), F.col("coverage_end"))).drop("_stretch")


def listed(included: DataFrame, start: str = "start_time", title: str = "title") -> DataFrame:
    """The order of a listing: by start, then by title."""
    return included.orderBy(start, title)


def readiness(cancelled: Column, conflict: Column, unmapped: Column, placeholder: Column, no_place: Column) -> Column:
    return F.when(cancelled | conflict | unmapped, F.lit("check")).when(placeholder | no_place, F.lit("fix")).otherwise(F.lit("ready"))


def gaps(**missing: Column) -> Column:
    return F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in missing.items())), lambda x: x.isNotNull())


def collision_key(start_time: Column, title: Column, placeholder: Column, first_speaker: Column) -> Column:
    return F.concat(start_time, F.lit("|"), fold(F.when(placeholder & (first_speaker != ""), first_speaker).otherwise(title)))


def collisions(included: DataFrame, key: Column) -> DataFrame:
    """Groups of more than one record, with the repeats beyond the first."""
    return included.groupBy(key.alias("collision_key")).agg(F.count("*").alias("size")).filter("size > 1").withColumn("repeats", F.col("size") - 1)


def by_day(included: DataFrame, start: str, *columns: str) -> DataFrame:
    """A row per day: its records sorted by time, then the other columns. Groups are a day of one edition, so small."""
    return included.groupBy(F.to_date(start).alias("day")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(start, *columns))).alias("items"))
