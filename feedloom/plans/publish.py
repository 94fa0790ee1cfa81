"""Publication: feeds, manifest, state and summary as files; state and last publications read back."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import text, timex

#: Names of fields on the wire, in their order, and the columns they come from.
WIRE = {
    "id": "id", "guid": "guid", "sources": "sources", "platform": "platform", "startsAt": "starts_at", "endsAt": "ends_at",
    "startTime": "start_time", "endTime": "end_time", "timezone": "timezone", "title": "title", "speakers": "speakers", "speaker": "speaker",
    "affiliation": "affiliation", "series": "series", "tags": "tags", "purposes": "purposes", "rawCategories": "raw_categories",
    "unmappedTags": "unmapped_tags", "location": "location", "urlRef": "url", "content": "content", "rawEventDetails": "raw_details",
    "rawExtractAbstract": "abstract", "rawExtractBio": "bio", "cancelled": "cancelled", "bannerImage": "banner_image", "itemType": "item_type",
    "summaryRaw": "summary_raw", "locationRaw": "location_raw", "mappingRules": "mapping_rules", "locationRule": "location_rule",
    "summaryRest": "summary_rest", "titleSource": "title_source", "titleIsPlaceholder": "title_is_placeholder", "mappingConflict": "mapping_conflict",
}
#: What fields that no stage has filled hold.
BLANK = {"itemType": "advertisement"}


def wire(events: DataFrame, escaped: Iterable[str] = (), collapsed: Iterable[str] = ("content",)) -> Column:
    """One JSON object of an event, keys in the order of the wire, ASCII only; null titleSource is written."""
    escaped, collapsed = set(escaped), set(collapsed)

    def value(name: str, column: str) -> Column:
        if column not in events.columns:
            return F.lit(BLANK.get(name, ""))
        c = F.col(column)
        kind = events.schema[column].dataType
        if isinstance(kind, T.StringType):
            c = text.collapse(c) if name in collapsed else c
            return text.escape(c) if name in escaped else c
        if name in escaped and isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            return F.transform(c, lambda s: F.struct(*(text.escape(s[f.name]).alias(f.name) for f in kind.elementType.fields)))
        if name in escaped and isinstance(kind, T.ArrayType):
            return F.transform(c, text.escape)
        return c

    fields = F.struct(*(value(n, c).alias(n) for n, c in WIRE.items()))
    return F.to_json(fields, {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"})


def manifest_rows(feeds: DataFrame) -> DataFrame:
    """(path, row): each feed's entry as JSON in order of path, keys in order, those without a value left out. feeds:
    path, status, events, stale, detail, last_success, label, home, sources, purposes, notes."""
    said = lambda c: F.nullif(F.col(c), F.lit(""))
    some = lambda c: F.when(F.size(c) > 0, F.col(c))
    row = F.struct(
        "path", "status", "events", F.when(F.col("stale"), F.lit(True)).alias("stale"), said("detail").alias("detail"), said("last_success").alias("lastSuccessAt"),
        said("label").alias("label"), said("home").alias("home"), some("sources").alias("sources"), some("purposes").alias("purposes"), some("notes").alias("notes"),
    )
    return feeds.select("path", F.to_json(row, {"ignoreNullFields": "true"}).alias("row")).orderBy("path")


def manifest_document(feeds: DataFrame, generated_at: str, purposes: dict | None = None, templates: dict | None = None) -> str:
    """The manifest: counts by status, events of single feeds, stale feeds, and a row for each feed. Feeds are as many as
    sources and combined views, so the driver holds them."""
    by = feeds.groupBy("status").agg(F.count("*").alias("n"), F.sum(F.when(F.col("path").startswith("feeds/"), F.col("events")).otherwise(0)).alias("e"), F.count_if("stale").alias("s")).orderBy("status").collect()
    out = {"generatedAt": generated_at} | ({"purposes": purposes} if purposes else {}) | ({"templates": templates} if templates else {})
    out["summary"] = {r.status: r.n for r in by} | {"events": sum(r.e for r in by), "stale": sum(r.s for r in by)}
    out["feeds"] = [json.loads(r.row) for r in manifest_rows(feeds).collect()]
    return json.dumps(out, indent=2, ensure_ascii=True) + "\n"


def summary_rows(feeds: DataFrame) -> DataFrame:
    """(path, line): a table's line for each feed, with what there is to say of it in at most 140 characters."""
    note = text.cell(F.concat_ws(" ", F.nullif("detail", F.lit("")), F.array_join("notes", " ")))
    mark = F.when(F.col("stale"), F.lit("**stale**")).otherwise(F.col("status"))
    return feeds.select("path", F.concat(F.lit("| `"), "path", F.lit("` | "), mark, F.lit(" | "), F.col("events").cast("string"), F.lit(" | "), note, F.lit(" |")).alias("line"))


def summary_document(feeds: DataFrame, generated_at: str) -> str:
    by = feeds.groupBy("status").agg(F.count("*").alias("n"), F.count_if("stale").alias("s")).orderBy("status").collect()
    stale = sum(r.s for r in by)
    head = ", ".join(f"{r.n} {r.status}" for r in by) + (f" — **{stale} stale**" if stale else "")
    lines = [r.line for r in summary_rows(feeds).orderBy("path").collect()]
    return "\n".join([f"### Published {generated_at}", "", head, "", "| feed | status | events | note |", "| --- | --- | ---: | --- |", *lines]) + "\n"


#: A row of the manifest.
FEED_SCHEMA = "path string, status string, events long, stale boolean, detail string, last_success string, label string, home string, sources array<string>, purposes array<string>, notes array<string>"
FEED = [f.split()[0] for f in FEED_SCHEMA.split(", ")]

IDS = T.StructType().add("source", T.StringType()).add("id", T.StringType())
STATE = "source string, etag string, last_modified string, last_enriched string"


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON document by Spark's reader; a missing or malformed one is an empty table."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs):
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, _bad string").option("columnNameOfCorruptRecord", "_bad").option("mode", "PERMISSIVE").json(path, multiLine=True).filter("_bad is null").drop("_bad")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Last publication's rows by path."""
    rows = read_json(spark, path, "feeds array<struct<path:string,status:string,events:bigint,stale:boolean,lastSuccessAt:string,notes:array<string>>>")
    got = rows.select(F.inline("feeds"))
    return got.select("path", "status", "events", F.coalesce("stale", F.lit(False)).alias("stale"), F.col("lastSuccessAt").alias("last_success"), "notes").filter("path is not null")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_events(spark: SparkSession, root: str, slugs: list[str], schema: T.StructType, escapes: dict[str, tuple[str, ...]]) -> DataFrame:
    """The published feeds of some sources as events, escapes undone; a malformed one has no rows."""
    if not slugs:
        return spark.createDataFrame([], schema)
    names = {n: c for n, c in WIRE.items() if c in schema.names}
    kinds = T.StructType([T.StructField(n, schema[c].dataType) for n, c in names.items()] + [T.StructField("_bad", T.StringType())])
    paths = [f"{root}/feeds/{s}/events.json" for s in slugs]
    got = spark.read.schema(kinds).option("columnNameOfCorruptRecord", "_bad").option("mode", "PERMISSIVE").json(paths, multiLine=True).filter("_bad is null and id is not null")
    got = got.withColumn("_slug", F.substring_index("id", ":", 1))

    def value(name: str, column: str) -> Column:
        c, kind = F.col(name), schema[column].dataType
        mine = F.col("_slug").isin([s for s, e in escapes.items() if name in e])
        if isinstance(kind, T.StringType):
            return F.when(mine, text.unescape(c)).otherwise(c)
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            return F.when(mine, F.transform(c, lambda s: F.struct(*(text.unescape(s[f.name]).alias(f.name) for f in kind.elementType.fields)))).otherwise(c)
        if isinstance(kind, T.ArrayType):
            return F.when(mine, F.transform(c, text.unescape)).otherwise(c)
        return c

    columns = [value(n, c).alias(c) for n, c in names.items()]
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in names.values() and f.name != "source"]
    return got.select(F.col("_slug").alias("source"), *columns, *rest).select(*schema.names)


def read_feed(spark: SparkSession, path: str, schema: str, escaped: Iterable[str] = ()) -> DataFrame:
    """A published feed read back, escapes undone; a malformed one has no rows."""
    got = read_json(spark, path, schema)
    return got.select(*(text.unescape(F.col(c)).alias(c) if c in set(escaped) else F.col(c) for c in got.columns))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    rows = read_json(spark, path, "sources map<string,struct<etag:string,lastModified:string,lastEnrichedAt:string>>")
    got = rows.select(F.explode("sources").alias("source", "s"))
    said = lambda c: F.coalesce(F.col(f"s.{c}"), F.lit(""))
    return got.select("source", said("etag").alias("etag"), said("lastModified").alias("last_modified"), said("lastEnrichedAt").alias("last_enriched"))


def state_document(state: DataFrame, generated_at: str) -> str:
    """The state, by source, without what is empty; a row for each source, so the driver holds it."""
    out = {}
    for r in state.orderBy("source").collect():
        entry = {k: v for k, v in (("etag", r.etag), ("lastModified", r.last_modified), ("lastEnrichedAt", r.last_enriched)) if v}
        if entry:
            out[r.source] = entry
    return json.dumps({"note": "Internal state: cache validators and scrape times.", "generatedAt": generated_at, "sources": out}, indent=2) + "\n"


def advance(state: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The state after a run (source, outcome, etag, last_modified, enriched_at): validators change only where the feed
    was reached and sent one; a scrape's time stays where this run made none."""
    new = outcomes.select("source", "outcome", *(F.col(c).alias(f"_{c}") for c in ("etag", "last_modified", "enriched_at")))
    got = state.join(new, "source", "full_outer")
    reached = F.coalesce(F.col("outcome").isin("ok", "not_modified"), F.lit(False))
    said = lambda c, ok: F.coalesce(F.when(ok, F.nullif(f"_{c}", F.lit(""))), F.col({"enriched_at": "last_enriched"}.get(c, c)), F.lit(""))
    return got.select("source", said("etag", reached).alias("etag"), said("last_modified", reached).alias("last_modified"), said("enriched_at", F.lit(True)).alias("last_enriched"))


def enrichment_due(sources: DataFrame, state: DataFrame, now: Column) -> DataFrame:
    """(source, due, reason) of sources (source, targets, window in hours): whether this run reads their pages again."""
    got = sources.join(state.select("source", "last_enriched"), "source", "left")
    hours = timex.hours_between(F.regexp_replace(F.coalesce("last_enriched", F.lit("")), "Z$", ""), now)
    none = F.struct(F.lit(False).alias("due"), F.lit("declares no enrichment targets").alias("reason"))
    return got.select("source", F.when(F.col("targets") == 0, none).otherwise(timex.elapsed_window(hours, F.col("window"))).alias("d")).select("source", "d.due", "d.reason")


def write(files: dict[str, str], root: str, spark: SparkSession) -> list[str]:
    """Files under a folder of any file system that Spark reaches, in order of path."""
    jvm = spark.sparkContext._jvm
    for path, body in sorted(files.items()):
        p = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{path}")
        out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
        try:
            out.write(bytearray(body.encode()))
        finally:
            out.close()
    return sorted(files)


def landing(feeds: DataFrame) -> DataFrame:
    """The landing view: feeds that aren't disabled, their pill and what there is to say."""
    live = feeds.filter("status <> 'disabled'")
    kind = F.when(F.col("stale"), F.lit("warn")).when(F.col("status") == "ok", F.lit("ok")).when(F.col("status") == "empty", F.lit("dim")).otherwise(F.lit("bad"))
    return live.select("path", F.when(F.col("stale"), F.lit("stale")).otherwise(F.col("status")).alias("pill"), kind.alias("kind"), "events", F.concat_ws(" ", F.nullif("detail", F.lit("")), F.array_join("notes", " ")).alias("note"))


def health_line(feeds: DataFrame, minutes: Column) -> DataFrame:
    """One row with one line: how long ago, feeds by status, the oldest content."""
    n = lambda s: F.count_if(F.col("status") == s)
    got = feeds.agg(n("ok").alias("ok"), n("empty").alias("empty"), n("failed").alias("failed"), F.count_if("stale").alias("stale"), F.min(F.when(F.col("path").startswith("feeds/") & (F.col("status") != "disabled"), F.nullif("last_success", F.lit("")))).alias("oldest"))
    part = lambda c: F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(f" {c}")))
    fine = F.when((F.col("stale") == 0) & (F.col("failed") == 0), F.lit("none stale or failed"))
    line = F.concat_ws(" · ", F.concat(F.lit("Checked "), timex.ago(minutes)), F.concat(F.col("ok").cast("string"), F.lit(" feeds ok")), part("empty"), part("stale"), part("failed"), fine, F.concat(F.lit("oldest feed content "), F.col("oldest")))
    return got.select(line.alias("line"))


def due(sources: DataFrame, manifest: DataFrame, at: str) -> DataFrame:
    """(source, due, reason) of sources (source, cadence as declared): whether this run fetches their feeds again."""
    got = sources.join(manifest.select("path", "last_success"), F.concat(F.lit("feeds/"), "source", F.lit("/events.json")) == F.col("path"), "left")
    waited = timex.hours_between(F.regexp_replace(F.coalesce("last_success", F.lit("")), "Z$", ""), F.lit(at[:19])) * 60
    every = timex.cadence_minutes(F.col("cadence"))
    said = F.concat(F.lit("fetched "), F.format_string("%.0f", waited), F.lit("m ago, cadence is "), every.cast("string"), F.lit("m"))
    reason = F.when(F.col("path").isNull(), "never published").when(F.coalesce("last_success", F.lit("")) == "", "no recorded success to measure from").when(waited < 0, "last success is dated in the future").otherwise(said)
    is_due = F.when(F.col("path").isNull() | (F.coalesce("last_success", F.lit("")) == ""), F.lit(True)).otherwise(timex.due(waited, every))
    return got.select("source", is_due.alias("due"), reason.alias("reason"))
