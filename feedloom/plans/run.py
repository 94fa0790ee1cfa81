"""A whole run: feeds to events, pages, gates, last-good fallback, combined views, files. One plan over all sources; a
source fails by a row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import text, titles
from feedloom.operators import combine, enrich, quality, transform
from feedloom.plans import contract, publish
from feedloom.plans.config import Combo, Registry
from feedloom.session import written
from feedloom.sources import sink

#: What a publication says of a source that it didn't build, and in its notes.
NEVER = "{}. Never published, so nothing is served at this path."
UNBUILT = "not built in this run"
DECLINED = "declined: %d event(s) present in the upstream feed are deliberately not published here, per this source's %s (%s)."
NOTHING = "upstream: the feed listed no events at all."
HORIZON = "horizon: the upstream feed lists at most %d events and returned %d, so it is complete only up to the last start it lists (%s local); events starting after that may exist and not be listed yet."
MERGED = "%d event(s) were published by more than one source with every compared detail matching, and were merged into one record naming all of them"
DIVERGED = "%d group(s) matched on %s but differed in detail, so every record was kept rather than picking a winner"


@dataclass
class Built:
    """events: what is published; runs: source, status (ok, empty, failed), detail, notes; counts by source; scraped:
    source, field and status of each page that was wanted, where pages were."""

    events: DataFrame
    runs: DataFrame
    counts: DataFrame
    scraped: DataFrame | None = None


def _expected(registry: Registry, name: str, default):
    return F.coalesce(transform.by_source(registry.sources, lambda s: F.lit(s.expectations.get(name, default)), "expectations"), F.lit(default))


def schema_of(registry: Registry, feeds: DataFrame) -> T.StructType:
    """The columns of events, with those that pages give."""
    mapped = transform.events(registry.raw_records(feeds), registry.sources, registry.alias).drop("error")
    more = {t["field"] for s in registry.sources for t in s.enrich} - set(mapped.columns)
    return T.StructType([*mapped.schema.fields, *(T.StructField(f, T.StringType()) for f in sorted(more))])


def built(
    registry: Registry, feeds: DataFrame, template: str = "", held: DataFrame | None = None, scraped: list[str] = (), gates: dict | None = None,
    previous: DataFrame | None = None, allow_large_diff: bool = False, pages: DataFrame | None = None, trouble: DataFrame | None = None,
) -> Built:
    """Feeds (source, text) of live sources through the stages in their order: map, purposes, choice, what earlier runs
    scraped (held: guid and the scraped fields) or pages say (pages: url, code, body; held: source, guid and fields),
    titles, gates, schema, and what has vanished since the last publication (previous: source, id). The choice comes before
    anything is fetched for an event, and the gates see what is published. A source that any stage fails, or that could
    not be fetched (trouble: source, detail), publishes nothing.

    The mapped events are written once; all that is asked of them later reads that table, not the feeds."""
    raw = registry.raw_records(feeds)
    mapped = transform.events(raw, registry.sources, registry.alias)
    if "error" in raw.columns:  # what the reader could not read
        bad = raw.select("source", "ordinal", F.col("error").alias("_error"))
        mapped = mapped.join(bad, ["source", "ordinal"]).withColumn("error", F.coalesce("_error", "error")).drop("_error")
    mapped = transform.resolved(mapped, registry.sources).withColumn("_dtstart_day", F.substring("start_time", 1, 16))
    chosen = written(mapped.withColumn("declined", ~F.coalesce(transform.selected(mapped, registry.sources), F.lit(True))), "mapped")
    kept, seen = chosen.filter("not declined").drop("_dtstart_day"), None
    if pages is not None:
        kept, seen = enrich.enriched(kept, registry.sources, pages, held)
        kept = written(kept, "enriched")
    elif held is not None:
        kept = enrich.carry(kept, held, "guid", list(scraped)).drop("carried")
    own = transform.by_source(registry.sources, lambda s: titles.fallback(s.title_template or template, F.col("series"), F.col("speaker"), F.col("source")), "title_template")
    missing = text.is_missing(F.col("title"))
    kept = kept.withColumn("_t", own).withColumns({
        "title": F.when(missing, F.col("_t.title")).otherwise(F.col("title")), "title_source": F.when(missing, F.col("_t.title_source")).otherwise(F.col("title_source")),
        "title_is_placeholder": missing,
    }).drop("_t")
    no_place = (F.col("location.name") == "") & (F.col("location.detail") == "")
    limits = {"min_events": _expected(registry, "min_events", 1), "max_declined": _expected(registry, "max_location_declined_rate", 0.3), "max_placeholder": _expected(registry, "max_placeholder_rate", 1.0)} | (gates or {})
    graded = quality.gates(kept, "source", "id", F.col("starts_at"), F.col("ends_at"), F.col("title_is_placeholder"), no_place, F.size("unmapped_tags") > 0, F.col("guid"), "^.+$", **limits)
    graded = graded.groupBy("source").agg(*(F.array_join(F.array_sort(F.collect_list(F.when(F.col("result") == r, F.concat_ws(": ", "gate", F.col("failing").cast("string"))))), "; ").alias(r) for r in ("fail", "warn")))
    why = transform.failures(chosen).select("source", F.col("first").alias("detail"))
    why = why.unionByName(graded.filter("fail <> ''").select("source", F.col("fail").alias("detail")))
    why = why.unionByName(quality.schema_errors(kept).select("source", F.concat(F.lit("schema: "), F.element_at("examples", 1)).alias("detail")))
    why = why.unionByName(registry.mismatched(feeds).select("source", F.concat(F.lit("feed reports producer "), "found").alias("detail")))
    if previous is not None:
        asked = previous.join(feeds.select("source").distinct(), "source", "left_semi")
        diff = quality.diff_threshold(asked, kept, "source", "id", most=_expected(registry, "max_removed_ratio", 0.5), allow=allow_large_diff).filter("result = 'fail'")
        said = F.format_string("%d of %d events disappeared. Confirm upstream, then rebuild with --allow-large-diff.", "removed", "before")
        why = why.unionByName(diff.select("source", said.alias("detail")))
    if seen is not None:
        why = why.unionByName(enrich.breaches(seen, registry.sources))
    if trouble is not None:
        why = why.unionByName(trouble.select("source", "detail"))
    why = written(why.groupBy("source").agg(F.min("detail").alias("detail")), "why")
    listed = chosen.groupBy("source").agg(F.count("*").alias("listed"), F.count_if("declined").alias("declined"), F.max("_dtstart_day").alias("last"))
    every = feeds.select("source")
    every = every.unionByName(trouble.select("source")) if trouble is not None else every
    runs = every.distinct().join(listed, "source", "left").join(why, "source", "left").join(graded.select("source", "warn"), "source", "left")
    status = F.when(F.col("detail").isNotNull(), "failed").when(F.coalesce("listed", F.lit(0)) == 0, "empty").otherwise("ok")
    size = transform.by_source(registry.sources, lambda s: F.lit(s.page_size).cast("int"), "page_size")
    clause = transform.by_source(registry.sources, _clause, "publish_where", "publish_unless")
    notes = F.array(
        F.when(F.coalesce("listed", F.lit(0)) == 0, F.lit(NOTHING)).when(F.col("listed") >= size, F.format_string(HORIZON, size, F.col("listed"), F.translate("last", "T", " "))),
        F.when(F.col("declined") > 0, F.format_string(DECLINED, F.col("declined"), clause["name"], clause["said"])),
        F.nullif("warn", F.lit("")),
    )
    runs = runs.select("source", status.alias("status"), F.coalesce("detail", F.lit("")).alias("detail"), F.filter(notes, lambda n: n.isNotNull()).alias("notes"))
    good = kept.join(why.select("source"), "source", "left_anti").drop("error", "declined")
    return Built(good, runs, transform.counts(chosen), seen)


def _clause(s: transform.Source):
    name, where = ("publish_unless", s.publish_unless) if s.publish_unless else ("publish_where", s.publish_where or {})
    said = "; ".join(f"{field} {op} {value!r}" for field, tests in where.items() for op, value in tests.items())
    return F.struct(F.lit(name).alias("name"), F.lit(said).alias("said"))


def combined(events: DataFrame, combo: Combo, live: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """A combined view over events of several sources: its events, its divergences, and the sources that it may hold."""
    inputs = [s for s in (live if "*" in combo.include else combo.include) if s in live and s not in combo.exclude]
    chosen = combine.chosen(events, inputs, (), combo.where, combo.exclude_where)
    key, details = combine.keyed(combo.key), combine.details()
    merged = combine.merged(chosen, key, details, ["starts_at", "id"], sets=("sources", "purposes"))
    return merged, combine.divergences(chosen, key, details), inputs


def published(
    spark: SparkSession, registry: Registry, run: Built, root: str, at: str, previous: DataFrame | None = None, combos: list[Combo] = (), state: DataFrame | None = None,
) -> list[str]:
    """Writes the tree under root: feeds and combined views, then state, manifest and summary; the paths written.

    Only what this run built is touched. A source that failed keeps the file of its last good publication, is marked
    stale and keeps the time of its last success; one that wasn't asked keeps its file and its row of the manifest. A
    combined view is built from what this run built and from the last good feeds of the others. Feeds are written by the
    tasks that hold them and put in place together; readers go by the manifest, which is written last.

    previous: events of the last good publication; by default those of the tree. What comes to the driver is a row for
    each source and view."""
    was = {r.path: r for r in publish.read_manifest(spark, f"{root}/status.json").collect()}
    runs = {r.source: r for r in run.runs.collect()}
    path = lambda slug: f"feeds/{slug}/events.json"
    events = written(run.events, "events")
    live = [s.slug for s in registry.live]
    kept = [s for s in live if s not in runs or runs[s].status == "failed"]
    there = [s for s in kept if publish.exists(spark, f"{root}/{path(s)}")]
    restored = previous is not None
    if previous is None:
        previous = publish.read_events(spark, root, there, events.schema, {s.slug: s.escape for s in registry.sources})
    previous = previous.filter(F.col("source").isin(kept))
    n = {r.source: r.n for r in events.groupBy("source").agg(F.count("*").alias("n")).collect()}
    old = {r.source: r.n for r in previous.groupBy("source").agg(F.count("*").alias("n")).collect()}

    rows, degraded, feeds = [], {}, []
    for s in registry.sources:
        row = {"path": path(s.slug), "status": "disabled", "events": 0, "stale": False, "detail": " ".join(s.reason.split())[:300], "last_success": "", "label": s.label or s.slug, "home": s.home, "sources": [s.slug], "purposes": list(s.purposes), "notes": []}
        mine, before, served = runs.get(s.slug), was.get(path(s.slug)), s.slug in there or s.slug in old
        if s.slug in live and mine is not None and mine.status != "failed":
            row |= {"status": mine.status if mine.status == "empty" or n.get(s.slug) else "empty", "events": n.get(s.slug, 0), "detail": "", "last_success": at, "notes": list(mine.notes)}
            feeds.append(s.slug)
        elif s.slug in live and mine is None and before is not None and served:
            row |= {"status": before.status, "events": before.events, "stale": before.stale, "detail": "", "last_success": before.last_success or "", "notes": list(before.notes or ())}
            if before.stale:
                degraded[s.slug] = f"the last good copy of {s.slug}"
        elif s.slug in live:
            detail = mine.detail if mine is not None else UNBUILT
            row |= {"status": "failed", "events": old.get(s.slug, 0), "stale": served, "detail": text_of(detail if served else NEVER.format(detail)), "last_success": (before.last_success or "") if before is not None else ""}
            degraded[s.slug] = f"the last good copy of {s.slug}" if served else f"{s.slug} failed and has never been published"
        rows.append(row)

    escapes = {tuple(s.escape) for s in registry.sources}
    body = F.coalesce(*(F.when(F.col("source").isin([s.slug for s in registry.sources if tuple(s.escape) == e]), publish.wire(events, e)) for e in escapes))
    at_path = lambda c: F.concat(F.lit("feeds/"), c, F.lit("/events.json"))
    out = events.filter(F.col("source").isin(feeds)).select(at_path("source").alias("path"), "starts_at", "id", body.alias("wire"))
    if restored:  # events that the caller holds take the place of a feed that the tree may not have
        again = previous.filter(F.col("source").isin(list(old)))
        both = events.limit(0).unionByName(again, allowMissingColumns=True)
        out = out.union(both.select(at_path("source"), "starts_at", "id", publish.wire(both)))
    marks = [(path(s), None, None, None) for s in feeds]

    every = events.unionByName(previous, allowMissingColumns=True) if combos else None
    for c in combos:
        row = {"path": f"combos/{c.name}/events.json", "status": "disabled", "events": 0, "stale": False, "detail": " ".join(c.reason.split())[:300], "last_success": "", "label": "", "home": "", "sources": [], "purposes": [], "notes": []}
        if c.enabled:
            made, apart, inputs = combined(every, c, live)
            made = written(made, "combined")
            total = made.agg(F.count("*").alias("events"), F.sum(F.col("n") - 1).alias("merged")).first()
            differ = apart.count()
            reasons = sorted({degraded[s] for s in inputs if s in degraded})
            notes = ([MERGED % total.merged] if total.merged else []) + ([DIVERGED % (differ, ", ".join(c.key))] if differ else [])
            since = min((r["last_success"] for r in rows if r["last_success"] and r["sources"][0] in inputs), default=at)
            row |= {"status": "ok", "events": total.events, "stale": bool(reasons), "detail": f"built from {', '.join(reasons)}" if reasons else "", "last_success": since, "sources": inputs, "notes": notes}
            out = out.union(made.select(F.lit(row["path"]), "starts_at", "id", publish.wire(made)))
            marks.append((row["path"], None, None, None))
        rows.append(row)

    if marks or restored:
        sink.write(out.union(spark.createDataFrame(marks, sink.SCHEMA)), root)
    listing = spark.createDataFrame([tuple(r[c] for c in publish.FEED) for r in rows], publish.FEED_SCHEMA)
    files = {"summary.md": publish.summary_document(listing, at)} | contract.files()
    if state is not None:
        files["state.json"] = publish.state_document(state, at)
    publish.write(files, root, spark)
    publish.write({"status.json": publish.manifest_document(listing, at)}, root, spark)
    return sorted([*(m[0] for m in marks), *files, "status.json"])


def text_of(detail: str, most: int = 300) -> str:
    return detail if len(detail) <= most else detail[: most - 1] + "…"

