"""Health of what is published: freshness, staleness, promised against served counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import decimals


def freshness(age_minutes: Column, most: int = 90) -> Column:
    return F.when(age_minutes.isNull() | (age_minutes > most), F.lit("fail")).when(age_minutes < -5, F.lit("warn")).otherwise(F.lit("ok"))


def staleness(status: Column, stale: Column, since_success: Column, most: int = 360) -> Column:
    grade = F.when(since_success.isNull(), F.lit("warn")).when(since_success > most, F.lit("fail")).otherwise(F.lit("warn"))
    return F.when(status == "disabled", F.lit("skip")).when(stale, grade).when(status == "failed", F.lit("fail")).otherwise(F.lit("ok"))


def served(manifest: DataFrame, records: DataFrame, source: str = "source") -> DataFrame:
    """Promised and served counts of every feed that isn't disabled."""
    n = records.groupBy(source).agg(F.count("*").alias("served"))
    out = manifest.filter("status <> 'disabled'").join(n, source, "left").withColumn("served", F.coalesce("served", F.lit(0)))
    return out.withColumn("finding", F.when(F.col("served") == F.col("promised"), F.lit("ok")).otherwise(F.lit("fail")))


#: What is said of a repository's last commit: dated ahead, recent, late, too late.
COMMITS = (
    "the last commit is dated %s days ahead", "last commit %s days ago, inside the {0:g}-day threshold",
    "last commit %s days ago, past the {0:g}-day threshold and %s days from the schedules being disabled",
    "last commit %s days ago, past GitHub's {1:g}-day limit — the scheduled workflows have most likely already been disabled",
)


def keepalive(days: Column, warn: float = 35, fail: float = 60) -> Column:
    """struct(commit, reason): whether a repository that has been quiet for so many days needs a commit."""
    ahead, recent, late, too_late = (c.format(warn, fail) for c in COMMITS)
    pair = lambda c, said, *n: F.struct(F.lit(c).alias("commit"), F.format_string(said, *map(decimals, n)).alias("reason"))
    return F.when(days < 0, pair(False, ahead, -days)).when(days < warn, pair(False, recent, days)).when(days >= fail, pair(True, too_late, days)).otherwise(pair(True, late, days, fail - days))


def stopped(states: DataFrame, expected: DataFrame) -> DataFrame:
    """Of states (path, state), those that aren't active though a file of that name in expected (path) has a schedule."""
    name = F.element_at(F.split("path", "/"), -1)
    wanted = expected.select(name.alias("file")).distinct()
    return states.withColumn("file", name).filter("state <> 'active'").join(wanted, "file", "left_semi").drop("file")


def protection_gaps(spec: DataFrame, live: DataFrame, checks: str = "required_status_checks") -> DataFrame:
    """(kind, name) of what spec (type, context) requires and live does not: types of rules, and contexts of checks
    where live has that type at all."""
    types = spec.select("type").distinct().join(live.select("type").distinct(), "type", "left_anti")
    of = lambda x: x.filter((F.col("type") == checks) & F.col("context").isNotNull()).select("type", "context").distinct()
    missing = of(spec).join(of(live), ["type", "context"], "left_anti").join(live.select("type").distinct(), "type", "left_semi")
    return types.select(F.lit("rule").alias("kind"), F.col("type").alias("name")).union(missing.select(F.lit("check"), "context"))


def workflow_states(documents: DataFrame, column: str) -> DataFrame:
    """(name, path, state) of workflows in a listing as JSON text; a malformed one has none."""
    got = F.from_json(F.col(column), "workflows array<struct<name:string,path:string,state:string>>")
    return documents.select(F.explode(got["workflows"]).alias("w")).select("w.*")


def page_check(pages: DataFrame, column: str, needed: list[str]) -> DataFrame:
    """Pages with what they lack of what a landing page must hold."""
    lacks = F.filter(F.array(*(F.when(~F.coalesce(F.col(column).contains(x), F.lit(False)), F.lit(x)) for x in needed)), lambda x: x.isNotNull())
    return pages.withColumn("lacks", lacks).withColumn("finding", F.when(F.size("lacks") == 0, F.lit("ok")).otherwise(F.lit("fail")))
