"""Raw feed records to events, by what each source declares; a source fails by a row, never by an exception."""

from __future__ import annotations

import zoneinfo
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import chain, predicate, tags, text, timex, venue

ROLES = ("speaker", "title", "rules")
FIELDS = ("title", "speakers", "affiliation", "series_extra")
PEOPLE = "array<struct<name:string,affiliation:string>>"


@dataclass(frozen=True)
class Source:
    """What a source declares: how its summary reads, its zone, chains, purposes and clauses."""

    slug: str
    platform: str = "ics"
    role: str = "title"
    timezone: str = "UTC"
    rules: tuple = ()
    patterns: dict = field(default_factory=dict)
    on_no_match: str = "title"
    not_a_person: tuple[str, ...] = ()
    venues: tuple[str, ...] = venue.DEFAULT
    purposes: tuple[str, ...] = ()
    overrides: tuple[tuple[dict, tuple[str, ...]], ...] = ()
    publish_where: dict | None = None
    publish_unless: dict | None = None
    label: str = ""
    home: str = ""
    feed_url: str = ""
    status: str = "live"
    reason: str = ""
    producer: str = ""
    cadence: str = "1h"
    page_size: int | None = None
    enrich: tuple = ()
    rebuild_after_hours: int = 24
    escape: tuple[str, ...] = ()
    title_template: str = ""
    expectations: dict = field(default_factory=dict)


def by_source(sources: list[Source], value, *declared: str) -> Column:
    """value(source) for each row's source; null for rows of none of them. declared: the fields that the value depends
    on; sources that declare the same share a branch, so the plan grows with the declarations, not with the sources."""
    alike: dict[str, list[Source]] = {}
    for s in sources:
        alike.setdefault(repr([getattr(s, f) for f in declared]), []).append(s)
    return F.coalesce(*(F.when(F.col("source").isin([s.slug for s in some]), value(some[0])) for some in alike.values()))


def _zones() -> Column:
    return F.split(F.lit("|".join(sorted(zoneinfo.available_timezones()))), r"\|")


def _known(zone: str) -> bool:
    return zone in zoneinfo.available_timezones()


def _outcome(s: Source, summary: Column) -> Column:
    """struct(rule, title, title_source, speakers, rest, extra, series_extra, failed) of a summary by the source's role."""
    empty, none = F.lit(""), F.array().cast("array<string>")
    person = lambda c: F.when(c != "", F.array(text.split_speaker(c))).otherwise(F.array()).cast(PEOPLE)

    def out(rule, title=empty, speakers=None, rest=empty, extra=none, series=empty, failed=None):
        nobody = F.array().cast(PEOPLE)
        people = nobody if speakers is None else speakers
        real = F.when(text.is_missing(title), empty).otherwise(title)
        return F.struct(
            rule.alias("rule"), real.alias("title"), F.when(real != "", F.lit("ics")).alias("title_source"), people.alias("speakers"),
            rest.alias("rest"), extra.alias("extra"), series.alias("series_extra"), (F.lit(False) if failed is None else failed).alias("failed"),
        )

    declared = F.concat("source", F.lit(f":summary-is-{s.role}"))
    if s.role == "speaker":
        return out(declared, speakers=person(summary))
    if s.role == "title":
        return out(declared, title=summary)
    if s.role != "rules":
        return out(declared, failed=F.lit(True))
    r = chain.applied(summary, list(s.rules), FIELDS, s.patterns, s.on_no_match, list(s.not_a_person))
    # a captured affiliation is surer than one split off the name
    people = person(r["speakers"])
    people = F.when(r["affiliation"] != "", F.transform(people, lambda p: F.struct(p["name"].alias("name"), r["affiliation"].alias("affiliation")))).otherwise(people)
    extra = F.concat(r["tags"], F.when(r["series_extra"] != "", F.array(r["series_extra"])).otherwise(none))
    return out(F.concat("source", F.lit(":"), r["rule_id"]), r["title"], people, r["unresolved"], extra, r["series_extra"], r["rule_id"].isNull())


def events(raw: DataFrame, sources: list[Source], alias: dict[str, str]) -> DataFrame:
    """A row per raw record (source, ordinal, uid, summary, description, location, url, categories, dtstart,
    dtstart_params, dtend, dtend_params, series, speakers): the event's columns and `error`, null where it maps.

    One select over all sources; what depends on a source is a CASE of its declaration. Null texts count as empty. A
    record of a source that isn't declared is an error of that source.
    """
    none = lambda c: F.coalesce(F.col(c), F.lit(""))
    got = raw.withColumn("_summary", text.collapse(text.decode_entities(none("summary")))).withColumn("_zone", by_source(sources, lambda s: F.lit(s.timezone if _known(s.timezone) else "UTC"), "timezone"))
    got = got.withColumn("_o", by_source(sources, lambda s: _outcome(s, F.col("_summary")), "role", "rules", "patterns", "on_no_match", "not_a_person"))
    got = got.withColumn("_place", by_source(sources, lambda s: venue.parsed(text.decode_entities(none("location")), s.venues), "venues"))
    tzid = lambda c: F.regexp_extract(none(c), r"TZID=([^;:]+)", 1)
    for end, value, params in (("_start", "dtstart", "dtstart_params"), ("_end", "dtend", "dtend_params")):
        named = tzid(params)
        got = got.withColumn(f"{end}_zone", F.when(named == "", F.col("_zone")).when(F.array_contains(_zones(), named), named))
        got = got.withColumn(end, F.when(F.trim(none(value)).rlike(r"^\d{8}(T\d{6}Z?)?$"), timex.ics_instant(F.trim(none(value)), F.coalesce(f"{end}_zone", F.lit("UTC")))))
    bad = by_source(sources, lambda s: F.lit(None if _known(s.timezone) else f"timezone {s.timezone!r} is not known").cast("string"), "timezone")
    role = by_source(sources, lambda s: F.lit(None if s.role in ROLES else f"role {s.role!r} is not implemented").cast("string"), "role")
    # the texts of errors are fixed values
    say = lambda test, *parts: F.when(test, F.concat(*parts))
    error = F.coalesce(
        say(F.col("_zone").isNull(), F.lit("the source is not declared")), role,
        say(none("uid") == "", F.lit("event at position "), F.col("ordinal").cast("string"), F.lit(" has no UID")),
        say(none("dtstart") == "", "uid", F.lit(" has no DTSTART")), bad,
        say(F.col("_start_zone").isNull(), F.lit("timezone "), tzid("dtstart_params"), F.lit(" is not known")),
        say(F.col("_start").isNull(), F.lit("cannot read "), none("dtstart"), F.lit(" as a date-time")),
        say((none("dtend") != "") & F.col("_end_zone").isNull(), F.lit("timezone "), tzid("dtend_params"), F.lit(" is not known")),
        say((none("dtend") != "") & F.col("_end").isNull(), F.lit("cannot read "), none("dtend"), F.lit(" as a date-time")),
        say(F.col("_o.failed"), F.lit("no rule reads "), "_summary"),
    )
    categories = F.coalesce("categories", F.array().cast("array<string>"))
    got = got.withColumn("_end", F.coalesce("_end", "_start")).withColumn("_tags", tags.normalized(F.concat(categories, F.col("_o.extra")), alias))
    people = F.when(F.size("_o.speakers") > 0, F.col("_o.speakers")).otherwise(F.coalesce(F.col("speakers").cast(PEOPLE), F.array().cast(PEOPLE)))
    series = F.coalesce(F.nullif(F.array_join(categories, ","), F.lit("")), F.nullif(none("series"), F.lit("")), F.col("_o.series_extra"))
    return got.select(
        "source", "ordinal", F.concat_ws(":", "source", "uid").alias("id"), F.col("uid").alias("guid"), F.array("source").alias("sources"),
        by_source(sources, lambda s: F.lit(s.platform), "platform").alias("platform"), timex.stamp(F.col("_start")).alias("starts_at"), timex.stamp(F.col("_end")).alias("ends_at"),
        _local("_start").alias("start_time"), _local("_end").alias("end_time"), F.col("_zone").alias("timezone"),
        F.col("_o.title").alias("title"), none("url").alias("url"), F.struct("_place.name", F.lit("").alias("id"), "_place.detail").alias("location"),
        people.alias("speakers"), text.speaker_display(people).alias("speaker"), text.single_affiliation(people).alias("affiliation"), series.alias("series"),
        F.col("_tags.tags").alias("tags"), F.col("_tags.unmapped").alias("unmapped_tags"), categories.alias("raw_categories"),
        by_source(sources, lambda s: F.array(*map(F.lit, s.purposes)).cast("array<string>"), "purposes").alias("purposes"),
        text.decode_entities(none("description")).alias("content"), none("summary").alias("summary_raw"), none("location").alias("location_raw"),
        F.array("_o.rule").alias("mapping_rules"), F.col("_o.rest").alias("summary_rest"), F.col("_place.rule").alias("location_rule"),
        F.col("_o.title_source").alias("title_source"), F.lit(False).alias("title_is_placeholder"), F.lit(False).alias("mapping_conflict"), error.alias("error"),
    )


def _local(c: str) -> Column:
    return F.date_format(F.from_utc_timestamp(c, F.coalesce("_zone", F.lit("UTC"))), "yyyy-MM-dd'T'HH:mm:ss")


def resolved(mapped: DataFrame, sources: list[Source]) -> DataFrame:
    """Purposes by the first override of the source that holds, else as declared."""
    alike: dict[str, list[Source]] = {}
    for s in sources:
        alike.setdefault(repr(s.overrides), []).append(s)
    out = F.col("purposes")
    for some in alike.values():
        for where, values in reversed(some[0].overrides):
            mine = F.col("source").isin([s.slug for s in some])
            out = F.when(mine & predicate.compiled(where, mapped), F.array(*map(F.lit, values)).cast("array<string>")).otherwise(out)
    return mapped.withColumn("purposes", out)


def selected(mapped: DataFrame, sources: list[Source]) -> Column:
    """Whether a source publishes the event, by its clauses."""
    return by_source(sources, lambda s: predicate.selected(mapped, s.publish_where, s.publish_unless), "publish_where", "publish_unless")


def failures(mapped: DataFrame) -> DataFrame:
    """(source, errors, first): the sources of which a record failed, and the first error in feed order."""
    bad = mapped.filter("error is not null")
    return bad.groupBy("source").agg(F.count("*").alias("errors"), F.min_by("error", F.struct("ordinal", "error")).alias("first"))


def built(mapped: DataFrame) -> DataFrame:
    """Events of the sources without an error; a source fails as a whole. Failed sources are few and named by the
    registry, so the join is with a row for each of them."""
    return mapped.join(failures(mapped).select("source"), "source", "left_anti").drop("error")


def counts(published: DataFrame) -> DataFrame:
    """What a run reports of each source; published: events with `declined` (not published by choice)."""
    kept = ~F.col("declined")
    no_place = (F.col("location.name") == "") & (F.col("location.detail") == "")
    return published.groupBy("source").agg(
        F.count_if(kept).alias("events"), F.count_if(kept & F.col("title_is_placeholder")).alias("placeholder_titles"),
        F.count_if(kept & no_place).alias("locations_declined"), F.count_if("declined").alias("declined"),
    )


def horizon(raw: DataFrame, page_size: dict[str, int]) -> DataFrame:
    """(source, listed, horizon): how many records a feed lists, and, where that is a full page, up to when it is
    complete; null elsewhere."""
    seen = raw.groupBy("source").agg(F.count("*").alias("listed"), F.max("dtstart").alias("last"))
    sizes = F.coalesce(*(F.when(F.col("source") == s, F.lit(n)) for s, n in page_size.items()), F.lit(None).cast("int"))
    day = F.regexp_replace(F.substring("last", 1, 8), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    clock = F.when(F.length("last") >= 13, F.concat(F.lit(" "), F.substring("last", 10, 2), F.lit(":"), F.substring("last", 12, 2))).otherwise(F.lit(""))
    return seen.select("source", "listed", F.when(F.col("listed") >= sizes, F.concat(day, clock)).alias("horizon"))
