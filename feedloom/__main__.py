"""Commands: sources, check, build, publish, verify, heartbeat. Exit codes: 0 done, 2 a wrong call, 3 wrong configuration, 4 a
source failed (after all else was published)."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime

from pyspark.sql import functions as F

from feedloom.functions import timex
from feedloom.operators import health
from feedloom.plans import config, publish, run
from feedloom.session import local, written
from feedloom.sources import fetch, sink

OK, USAGE, CONFIG, FAILED = 0, 2, 3, 4


def load(path: str, tags: str | None) -> config.Registry:
    found = config.read(path, {"sources", "defaults", "purposes"})
    return config.Registry(found.get("sources") or {}, found.get("defaults"), config.vocabulary(tags) if tags else {}, set(found.get("purposes") or ()))


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="feedloom")
    p.add_argument("command", choices=("sources", "check", "build", "publish", "verify", "heartbeat"))
    p.add_argument("--registry", default="sources.yaml")
    p.add_argument("--combos", help="declared combined views")
    p.add_argument("--tags")
    p.add_argument("--feeds", help="folder of feed texts, one <source>.txt each")
    p.add_argument("--source")
    p.add_argument("--out")
    p.add_argument("--at", help="time of the run, as an instant")
    p.add_argument("--fetch", action="store_true", help="fetch the feeds that are due into the folder first")
    p.add_argument("--enrich", action="store_true", help="also read the pages of events")
    p.add_argument("--ignore-cadence", action="store_true")
    p.add_argument("--rescrape", action="store_true", help="read all pages again, whatever the window")
    p.add_argument("--allow-large-diff", action="store_true")
    p.add_argument("--summary", help="also write the summary to this file")
    p.add_argument("--last-commit-epoch", type=int, help="heartbeat: time of the last commit")
    p.add_argument("--threshold-days", type=float, default=35)
    return p


def _fetched(spark, registry: config.Registry, a, at: str, state, transport: fetch.Transport):
    """Fetches due feeds to the folder: each outcome, and the sources that could not be fetched."""
    manifest = publish.read_manifest(spark, f"{a.out}/status.json")
    due = {r.source for r in publish.due(registry.table(spark).filter("live"), manifest, at).filter("due").collect()}
    held = {s.slug for s in registry.live if publish.exists(spark, f"{a.feeds}/{s.slug}.txt")}
    wanted = [s for s in registry.live if s.feed_url and (a.ignore_cadence or s.slug in due or s.slug not in held) and a.source in (None, s.slug)]
    if skipped := sorted(s.slug for s in registry.live if s not in wanted):
        print(f"not due, serving the current capture: {', '.join(skipped)}", file=sys.stderr)
    asked = spark.createDataFrame([(s.slug, s.feed_url, s.slug in held) for s in wanted], "source string, url string, captured boolean")
    asked = asked.join(state, "source", "left").withColumn("headers", F.lit(None).cast("map<string,string>"))
    got = written(fetch.captures(asked, transport), "captures")
    texts = got.filter("outcome = 'ok'").select(F.concat("source", F.lit(".txt")).alias("path"), F.lit("").alias("starts_at"), F.lit("").alias("id"), F.col("body").alias("wire"))
    sink.write(texts, a.feeds, plain=True)
    said = F.when(F.col("code").isNull(), F.lit("no answer")).otherwise(F.concat(F.lit("HTTP "), F.col("code").cast("string")))
    trouble = got.filter("outcome not in ('ok', 'not_modified')").select("source", F.concat(F.lit("could not fetch the feed: "), said).alias("detail"))
    return got, trouble


def _publish(spark, registry: config.Registry, combos: list[config.Combo], a, at: str, known: list[str], transport: fetch.Transport) -> int:
    state = publish.read_state(spark, f"{a.out}/state.json")
    outcomes, trouble = _fetched(spark, registry, a, at, state, transport) if a.fetch else (None, None)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.txt$", 1)
    feeds = spark.read.text(f"{a.feeds}/*.txt", wholetext=True).select(name.alias("source"), F.col("value").alias("text"))
    feeds = feeds.filter(F.col("source").isin(known))
    feeds = feeds.join(trouble, "source", "left_anti").select("source", "text") if trouble is not None else feeds
    escapes = {s.slug: s.escape for s in registry.sources}
    there = [s for s in known if publish.exists(spark, f"{a.out}/feeds/{s}/events.json")]
    schema = run.schema_of(registry, feeds) if a.enrich else None
    previous = publish.read_events(spark, a.out, there, publish.IDS, {}) if there else None
    held, pages, rescraped = None, None, []
    if a.enrich:
        windows = publish.enrichment_due(registry.table(spark).filter("live"), state, F.lit(at[:19]))
        rescraped = [s for s in registry.live if s.enrich and s.slug in known]
        if not a.rescrape:
            due = {r.source for r in windows.filter("due").collect()}
            rescraped = [s for s in rescraped if s.slug in due]
        carried = [s for s in there if s not in {r.slug for r in rescraped}]
        held = publish.read_events(spark, a.out, carried, schema, escapes) if carried else None
        pages = _pages(spark, registry, feeds, held, transport)
    got = run.built(registry, feeds, previous=previous, allow_large_diff=a.allow_large_diff, pages=pages, held=held, trouble=trouble)
    new = spark.createDataFrame([(s.slug, at) for s in rescraped], "source string, enriched_at string")
    seen = outcomes if outcomes is not None else spark.createDataFrame([], fetch.OUTCOMES)
    seen = seen.select("source", "outcome", "etag", "last_modified").join(new, "source", "full_outer")
    run.published(spark, registry, got, a.out, at, combos=combos, state=publish.advance(state, seen))
    if a.summary:
        from pathlib import Path

        Path(a.summary).write_text(spark.read.text(f"{a.out}/summary.md", wholetext=True).first()[0], encoding="utf-8")
    failed = got.runs.filter("status = 'failed'").collect()
    for r in failed:
        print(f"{r.source}: {r.detail}", file=sys.stderr)
    return FAILED if failed else OK


def _pages(spark, registry: config.Registry, feeds, held, transport: fetch.Transport):
    """The pages that events of sources with targets want and no earlier publication holds, each asked once."""
    raw = registry.raw_records(feeds).filter(F.col("source").isin([s.slug for s in registry.live if s.enrich]))
    wanted = raw.filter("coalesce(url, '') <> ''").select("source", F.col("uid").alias("guid"), "url")
    if held is not None:
        wanted = wanted.join(held.select("source", "guid"), ["source", "guid"], "left_anti")
    urls = wanted.select("url").distinct().withColumn("headers", F.lit(None).cast("map<string,string>"))
    return written(fetch.asked_once(urls, transport).select("url", "code", "body"), "pages")


def main(argv: list[str] | None = None, spark=None, transport: fetch.Transport = fetch.http) -> int:
    p = _parser()
    try:
        a = p.parse_args(argv)
    except SystemExit as e:
        return OK if e.code == 0 else USAGE
    at = a.at or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    if a.command == "heartbeat":
        if a.last_commit_epoch is None:
            p.print_usage(sys.stderr)
            return USAGE
        spark = spark or local()
        days = (datetime.fromisoformat(at).timestamp() - a.last_commit_epoch) / 86400
        said = spark.range(1).select(health.keepalive(F.lit(days), a.threshold_days).alias("k")).select("k.*").first().asDict()
        print(said["reason"])
        if a.out and said["commit"]:
            publish.write({"heartbeat.json": json.dumps({"at": at, **said}, indent=2) + "\n"}, a.out, spark)
        return OK
    if a.command == "verify":
        spark = spark or local()
        manifest = publish.read_json(spark, f"{a.out}/status.json", "generatedAt string")
        age = timex.hours_between(F.regexp_replace("generatedAt", "Z$", ""), F.lit(at[:19])) * 60
        found = [r.f for r in manifest.select(health.freshness(age).alias("f")).collect()] or ["fail"]
        stale = publish.read_manifest(spark, f"{a.out}/status.json").filter("stale or status = 'failed'").count()
        print(f"manifest {found[0]}; {stale} stale or failed")
        return FAILED if found[0] == "fail" or stale else OK
    try:
        registry = load(a.registry, a.tags)
        combos = config.combos((config.read(a.combos, {"combos"}).get("combos") or []), registry) if a.combos else []
    except (ValueError, TypeError) as e:
        print(e, file=sys.stderr)
        return CONFIG
    if a.command == "check":
        print(f"registry ok: {len(registry.sources)} sources, {len(registry.live)} live, fingerprint {registry.fingerprint()}")
        return OK
    spark = spark or local()
    if a.command == "sources":
        for r in config.listing(registry.table(spark)).collect():
            print(f"{r.source:<16} {r.state:<12} {r.platform:<6} {r.role:<8} {r.cadence:<5} {r.targets:<3} {r.feed_url or '-'} {r.said}".rstrip())
        print(config.totals(registry.table(spark)).first().line)
        print(f"registry fingerprint: {registry.fingerprint()}")
        return OK
    if not a.feeds or not a.out:
        p.print_usage(sys.stderr)
        return USAGE
    known = [s.slug for s in registry.live if a.source in (None, s.slug)]
    if not known:
        print(f"{a.source} is not live", file=sys.stderr)
        return CONFIG
    return _publish(spark, registry, combos, a, at, known, transport)


if __name__ == "__main__":
    sys.exit(main())
