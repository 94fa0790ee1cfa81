"""Calendar text to raw records, one per VEVENT in feed order, by expressions of the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.functions.text import ics_escape, ics_list, ics_unescape


#: Where a line goes on.
FOLD = r"\r?\n[ \t]"


def read(spark, path: str) -> DataFrame:
    """(path, text) of whole feed files."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def prodid(text):
    return F.trim(F.regexp_extract(text, r"(?m)^PRODID:(.*?)\r?$", 1))


def records(feeds: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """source, ordinal, uid, summary, description, location, url, categories, dtstart, dtstart_params, dtend,
    dtend_params, properties. Lines are unfolded; lines without a colon are skipped; of a repeated property the last
    counts, but categories gather. A feed is one row, so feeds are the unit of distribution; `scan` reads feeds of any
    size from files."""
    unfolded = F.regexp_replace(F.col(text), FOLD, "")
    events = feeds.select(F.col(source).alias("source"), F.posexplode(F.regexp_extract_all(unfolded, F.lit(r"(?ms)^BEGIN:VEVENT\s*$(.*?)^END:VEVENT\s*$"), F.lit(1))).alias("ordinal", "body"))
    return parsed(events)


def parsed(events: DataFrame) -> DataFrame:
    """Raw records of events (source, ordinal, body: the unfolded lines between BEGIN and END)."""
    line = r"^([A-Za-z0-9-]+)((?:;[^:\"]*(?:\"[^\"]*\"[^:\"]*)*)?):(.*)$"
    lines = F.filter(F.split("body", r"\r?\n"), lambda x: x.rlike(line))
    parts = F.transform(lines, lambda x: F.struct(F.upper(F.regexp_extract(x, line, 1)).alias("name"), F.regexp_extract(x, line, 2).alias("params"), F.regexp_extract(x, line, 3).alias("value")))
    got = events.select("source", "ordinal", parts.alias("p"))
    last = lambda name, f: F.coalesce(F.try_element_at(F.filter("p", lambda x: x["name"] == name), F.lit(-1))[f], F.lit(""))
    text_of = lambda name: ics_unescape(last(name, "value"))
    names = F.array_distinct(F.transform("p", lambda x: x["name"]))
    return got.select(
        "source", "ordinal", text_of("UID").alias("uid"), text_of("SUMMARY").alias("summary"), text_of("DESCRIPTION").alias("description"),
        text_of("LOCATION").alias("location"), last("URL", "value").alias("url"),
        F.flatten(F.transform(F.filter("p", lambda x: x["name"] == "CATEGORIES"), lambda x: ics_list(x["value"]))).alias("categories"),
        last("DTSTART", "value").alias("dtstart"), F.regexp_replace(last("DTSTART", "params"), "^;", "").alias("dtstart_params"),
        last("DTEND", "value").alias("dtend"), F.regexp_replace(last("DTEND", "params"), "^;", "").alias("dtend_params"),
        F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter("p", lambda x: x["name"] == n), -1)["value"])).alias("properties"),
    )


def scan(spark: SparkSession, path: str, source: Column | None = None) -> DataFrame:
    """Raw records of calendar files, as `records` of their texts, but read by event: a file of any size is many tasks.

    The reader splits files at the lines that begin an event, so no task holds more than one event, and a record that
    crosses a split is read by the task where it begins. An event's ordinal is its place in its split plus the events of
    the splits before it: the counts of splits (a row for each) are summed by file and joined back, so no file's events
    are brought together. source: by default the file's name without its ending. Null and empty files have no records;
    files are as the file system has them, so compressed ones are one split."""
    begin = "BEGIN:VEVENT"
    lines = spark.read.option("lineSep", f"\n{begin}").text(path)
    raw = lines.select(F.col("value"), "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    # what stands before the first event is a record too, the only one that isn't cut off behind BEGIN
    blocks = raw.groupBy("file_path", "file_block_start").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = F.sum("n").over(W.partitionBy("file_path").orderBy("file_block_start").rowsBetween(W.unboundedPreceding, -1))
    blocks = blocks.select("file_path", "file_block_start", "first", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    found = raw.join(blocks, ["file_path", "file_block_start"]).withColumn("ordinal", (F.col("at") - F.col("first") + F.col("earlier") - 1).cast("int"))
    body = F.regexp_extract(F.regexp_replace("value", FOLD, ""), r"(?ms)\A[ \t\r]*$(.*?)^END:VEVENT\s*$", 1)
    name = source if source is not None else F.regexp_extract("file_path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    events = found.filter((F.col("ordinal") >= 0) & F.col("value").rlike(r"(?m)^END:VEVENT\s*$"))
    return parsed(events.select(name.alias("source"), "ordinal", body.alias("body")))


def fold(line: Column) -> Column:
    """A content line of more than 75 characters goes on in lines that begin with a space."""
    rest = F.regexp_replace(F.substr(line, F.lit(76)), "(.{74})(?=.)", "$1\r\n ")
    return F.when(F.length(line) <= 75, line).otherwise(F.concat(F.substring(line, 1, 75), F.lit("\r\n "), rest))


def calendar(uid: Column, start: Column, end: Column, summary: Column, description: Column, url: Column, prodid: str = "-//feedloom//EN") -> Column:
    """A calendar file of one event with an alarm a day before. start, end: UTC timestamps. The uid is the caller's, so
    the same event written twice is one entry; the stamp is the start, so the text is the same for the same input. No
    URL line where url is null or empty; null texts are empty."""
    stamp = lambda c: F.date_format(c, "yyyyMMdd'T'HHmmss'Z'")
    held = lambda c: ics_escape(F.coalesce(c, F.lit("")))
    rows = [
        *map(F.lit, ("BEGIN:VCALENDAR", "VERSION:2.0", f"PRODID:{prodid}", "CALSCALE:GREGORIAN", "BEGIN:VEVENT")),
        *(F.concat(F.lit(k), v) for k, v in (("UID:", uid), ("DTSTAMP:", stamp(start)), ("DTSTART:", stamp(start)), ("DTEND:", stamp(end)), ("SUMMARY:", held(summary)), ("DESCRIPTION:", held(description)))),
        F.when(url != "", F.concat(F.lit("URL:"), held(url))),
        *map(F.lit, ("BEGIN:VALARM", "TRIGGER:-PT24H", "ACTION:DISPLAY")),
        F.concat(F.lit("DESCRIPTION:"), held(summary)),
        *map(F.lit, ("END:VALARM", "END:VEVENT", "END:VCALENDAR")),
    ]
    return F.concat(F.concat_ws("\r\n", *map(fold, rows)), F.lit("\r\n"))
