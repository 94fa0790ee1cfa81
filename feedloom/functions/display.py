"""Texts of a listing: places, lines, sponsors, what a record lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import text, timex

#: Fixed value: the shape of a room in a listing.
ROOM = r"^[A-Za-z]?\d{1,4}[A-Za-z]?$"


def place(name: Column, detail: Column, room: str = "Room ") -> Column:
    """'Hall, Room 306' where the detail looks like a room, else 'Hall, East Wing'; with room='' 'Hall 306'."""
    name, detail = (F.trim(F.coalesce(c, F.lit(""))) for c in (name, detail))
    between = F.when(detail.rlike(ROOM), F.lit(f", {room}" if room else " ")).otherwise(F.lit(", "))
    return F.when(name == "", detail).when(detail == "", name).otherwise(F.concat(name, between, detail))


def when_and_where(start: Column, end: Column, place_: Column) -> Column:
    there = F.when(F.coalesce(place_, F.lit("")) != "", F.concat(F.lit("in "), place_)).otherwise(F.lit("location TBA"))
    return F.concat(timex.time_range(start, end), F.lit(" "), timex.short_date(start), F.lit(", "), there)


def sponsors(records: DataFrame, key: str, sources: str, registry: DataFrame) -> DataFrame:
    """(key, sponsors): label and home of each of a record's sources, in their order; a source that isn't registered has
    its own name for a label."""
    each = records.select(key, F.posexplode(sources).alias("_at", "source")).join(registry, "source", "left")
    one = F.struct("_at", F.coalesce("label", "source").alias("label"), F.coalesce("home", F.lit("")).alias("home"))
    return each.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: F.struct(x["label"].alias("label"), x["home"].alias("home"))).alias("sponsors"))


def decorated(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Events as a listing shows them: id, times, title, series with spaces, first paragraph, speakers and their bare names,
    place with and without the word for a room, sponsors in the order of the sources (label and home of the registry),
    purposes, whether the title stands in for one, and whether the start can't be read. One join with the registry for
    each source of an event, none over the texts."""
    said = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    names = F.filter(F.transform("speakers", lambda s: s["name"]), lambda n: n != "")
    out = events.select(
        "id", "start_time", "end_time", said("title").alias("title"), text.series_spacing(said("series")).alias("series"), text.first_paragraph(F.coalesce("content", F.lit(""))).alias("description"),
        text.speaker_display(F.col("speakers")).alias("speakers"), names.alias("names"), place(F.col("location.name"), F.col("location.detail")).alias("location"),
        place(F.col("location.name"), F.col("location.detail"), room="").alias("place"), F.coalesce("url", F.lit("")).alias("url"), "sources", "purposes",
        F.coalesce("title_is_placeholder", F.lit(False)).alias("placeholder"), (~F.coalesce(F.col("start_time").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"), F.lit(False))).alias("malformed_start"),
    )
    return out.join(sponsors(events, "id", "sources", registry), "id", "left").withColumn("sponsors", F.coalesce("sponsors", F.array().cast("array<struct<label:string,home:string>>")))


#: Why a record isn't ready.
CANCELLED, CONFLICTED, UNKNOWN, UNTITLED, NOWHERE = "cancelled", "the mapping conflicted", "a category nothing recognises: ", "no title announced yet", "no location"


def reasons(cancelled: Column, conflict: Column, unmapped: Column, placeholder: Column, no_place: Column) -> Column:
    """Why a record isn't ready, what is wrong first; unmapped: an array of categories."""
    found = [
        F.when(cancelled, F.lit(CANCELLED)),
        F.when(conflict, F.lit(CONFLICTED)),
        F.when(F.size(unmapped) > 0, F.concat(F.lit(UNKNOWN), F.array_join(unmapped, ", "))),
        F.when(placeholder, F.lit(UNTITLED)),
        F.when(no_place, F.lit(NOWHERE)),
    ]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def calendar_url(title: Column, start: Column, end: Column, place_: Column, details: Column) -> Column:
    """A link that opens an entry in a web calendar. start, end: UTC timestamps."""
    at = lambda c: F.date_format(c, "yyyyMMdd'T'HHmmss'Z'")
    values = (("text", title), ("dates", F.concat(at(start), F.lit("/"), at(end))), ("location", place_), ("details", details))
    parts = [F.concat(F.lit(f"&{k}="), F.url_encode(F.coalesce(v, F.lit("")))) for k, v in values]
    return F.concat(F.lit("https://calendar.google.com/calendar/render?action=TEMPLATE"), *parts)


def listing_html(day: Column, items: Column) -> Column:
    """A day of a listing: a heading and an entry for each item (title, line, url), texts escaped."""
    safe = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    one = lambda x: F.concat(F.lit('<p style="margin:0 0 12px"><a href="'), safe(x["url"]), F.lit('"><strong>'), safe(x["title"]), F.lit("</strong></a><br>"), safe(x["line"]), F.lit("</p>"))
    return F.concat(F.lit("<h3>"), safe(day), F.lit("</h3>"), F.array_join(F.transform(items, one), ""))
