"""Syndication text (RSS 2.0 with an events namespace) to raw records, by the engine's XML path functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all(name: str) -> Column:
    return F.transform(F.xpath("item", F.lit(f"/item/*[local-name()='{name}']/text()")), lambda x: F.trim(x))  # F.trim itself would take the place for what to trim


def _one(name: str) -> Column:
    return F.coalesce(F.try_element_at(_all(name), F.lit(1)), F.lit(""))


def endpoint(c: Column) -> Column:
    """'Thursday, October 8, 2026 - 16:15' as a floating calendar value; null if unreadable or the weekday is wrong."""
    t = F.try_to_timestamp(F.regexp_replace(c, r"^[A-Za-z]+, ", ""), F.lit("MMMM d, yyyy - HH:mm"))
    return F.when(F.date_format(t, "EEEE") == F.regexp_extract(c, r"^([A-Za-z]+),", 1), F.date_format(t, "yyyyMMdd'T'HHmmss"))


def records(feeds: DataFrame, source: str = "source", text: str = "text", uri: str | None = None) -> DataFrame:
    """source, ordinal, uid (guid, else link), summary, description, url, location, series, speakers, dtstart, dtend,
    properties, error. Organisations go with speakers only where both are as many. An unreadable date, or one whose
    weekday is wrong, is an error of the record, and so fails its source.

    uri: the namespace whose elements are read, found by the prefix that the feed binds to it; elements of other
    prefixes are left alone. Without one, prefixes are not looked at. `properties` has every prefixed element's text.
    """
    prefix = F.regexp_extract(F.col(text), rf'xmlns:([A-Za-z0-9]+)="{uri}"', 1) if uri else F.lit("[A-Za-z0-9]+")
    items = F.regexp_extract_all(F.col(text), F.lit(r"(?s)(<item>.*?</item>)"), F.lit(1))
    own = lambda x: F.regexp_replace(F.regexp_replace(x, F.concat(F.lit("(</?)"), F.col("_prefix"), F.lit(":")), F.lit("$1")), "(</?[A-Za-z0-9]+):", "$1_")
    got = feeds.withColumn("_prefix", prefix).select(F.col(source).alias("source"), "_prefix", F.posexplode(items).alias("ordinal", "raw"))
    got = got.withColumn("item", own(F.col("raw")))
    tagged = lambda i: F.regexp_extract_all("raw", F.concat(F.lit("(?s)<"), F.col("_prefix"), F.lit(":([A-Za-z0-9]+)[^>]*>(.*?)</")), F.lit(i))
    got = got.withColumn("_names", tagged(1)).withColumn("_values", tagged(2)).withColumn("_distinct", F.array_distinct("_names"))
    people, orgs = _all("speaker"), _all("speakerOrg")
    both = F.when(F.size(people) == F.size(orgs), F.zip_with(people, orgs, lambda n, a: F.struct(n.alias("name"), a.alias("affiliation")))).otherwise(F.transform(people, lambda n: F.struct(n.alias("name"), F.lit("").alias("affiliation"))))
    ends = F.split(_one("date"), r" - (?=[A-Z])")
    start, end = endpoint(F.element_at(ends, 1)), endpoint(F.try_element_at(ends, F.lit(2)))
    bad = (_one("date") != "") & (start.isNull() | (F.size(ends) > 1) & end.isNull())
    return got.select(
        "source", "ordinal", F.coalesce(F.nullif(_one("guid"), F.lit("")), _one("link")).alias("uid"), _one("title").alias("summary"), _one("description").alias("description"),
        _one("link").alias("url"), _one("location").alias("location"), _one("hostOrg").alias("series"), F.filter(both, lambda s: s["name"] != "").alias("speakers"),
        start.alias("dtstart"), F.coalesce(end, F.lit("")).alias("dtend"),
        F.map_from_arrays("_distinct", F.transform("_distinct", lambda n: F.trim(F.element_at("_values", F.array_position("_names", n).cast("int"))))).alias("properties"),
        F.when(bad, F.concat(F.lit("cannot read "), _one("date"))).alias("error"),
    )
