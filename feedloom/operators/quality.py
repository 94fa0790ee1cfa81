"""Gates over sources: one aggregation for all of them, every gate always reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def gates(df: DataFrame, source: str, ident: str, start: Column, end: Column, placeholder: Column, no_place: Column, unmapped: Column, uid: Column, uid_pattern: str,
          min_events: int = 1, allow_empty: bool = False, max_placeholder: float = 1.0, max_declined: float = 0.3) -> DataFrame:
    """(source, gate, result, failing, total); distinct ids are counted from a pre-aggregation by source and id."""
    flags = {"late": end < start, "placeholder": placeholder, "no_place": no_place, "unmapped": unmapped, "odd_uid": ~uid.rlike(uid_pattern)}
    per_id = df.select(source, ident, *(F.coalesce(c, F.lit(False)).cast("long").alias(n) for n, c in flags.items()))
    per_id = per_id.groupBy(source, ident).agg(F.count("*").alias("n"), *(F.sum(n).alias(n) for n in flags))
    s = per_id.groupBy(source).agg(F.sum("n").alias("n"), F.sum((F.col("n") > 1).cast("long")).alias("repeated"), *(F.sum(x).alias(x) for x in flags))
    rate = lambda x: F.col(x) / F.col("n")
    verdict = lambda ok, bad: F.when(ok, F.lit("pass")).otherwise(F.lit(bad))
    rows = [
        ("count_floor", verdict((F.col("n") >= min_events) | (F.lit(allow_empty) & (F.col("n") == 0)), "fail"), F.lit(0).cast("long")),
        ("unique_ids", verdict(F.col("repeated") == 0, "fail"), F.col("repeated")),
        ("time_order", verdict(F.col("late") == 0, "fail"), F.col("late")),
        ("placeholder_rate", verdict(rate("placeholder") <= max_placeholder, "fail"), F.col("placeholder")),
        ("location_declined", verdict(rate("no_place") <= max_declined, "warn"), F.col("no_place")),
        ("unmapped_tags", verdict(F.col("unmapped") == 0, "warn"), F.col("unmapped")),
        ("uid_pattern", verdict(F.col("odd_uid") == 0, "warn"), F.col("odd_uid")),
    ]
    each = F.array(*(F.struct(F.lit(g).alias("gate"), r.alias("result"), n.alias("failing")) for g, r, n in rows))
    return s.select(F.col(source).alias("source"), F.col("n").alias("total"), F.explode(each).alias("g")).select("source", "g.gate", "g.result", "g.failing", "total")


def diff_threshold(previous: DataFrame, current: DataFrame, source: str, ident: str, most: float = 0.5, least_before: int = 3, allow: bool = False) -> DataFrame:
    """Removed and added ids by source against the last publication; skipped where that had few rows."""
    p = previous.select(source, ident).distinct().withColumn("was", F.lit(1))
    c = current.select(source, ident).distinct().withColumn("is", F.lit(1))
    out = p.join(c, [source, ident], "full_outer").groupBy(source).agg(
        F.count("was").alias("before"),
        F.count_if(F.col("was").isNotNull() & F.col("is").isNull()).alias("removed"),
        F.count_if(F.col("was").isNull() & F.col("is").isNotNull()).alias("added"),
    )
    skip = (F.col("before") <= least_before) | F.lit(allow)
    result = F.when(skip, F.lit("pass")).when(F.try_divide("removed", "before") <= most, F.lit("pass")).otherwise(F.lit("fail"))
    return out.select(F.col(source).alias("source"), "before", "removed", "added", result.alias("result"))


def violations(rules: dict[str, Column]) -> Column:
    """Names of the schema rules that a record breaks."""
    return F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())), lambda x: x.isNotNull())


def event_rules() -> dict[str, Column]:
    """The published contract of an event, as rules over its columns. Patterns and names are fixed values."""
    full = lambda c: F.length(F.coalesce(F.col(c), F.lit(""))) > 0
    like = lambda c, p: F.col(c).rlike(p)
    unique = lambda c: F.size(F.array_distinct(c)) == F.size(c)
    instant, wall = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"
    return {
        "id: pattern": like("id", "^[a-z0-9][a-z0-9-]*:.+$"), "guid: minLength": full("guid"), "sources: minItems": F.size("sources") >= 1, "sources: uniqueItems": unique("sources"),
        "startsAt: pattern": like("starts_at", instant), "endsAt: pattern": like("ends_at", instant), "startTime: pattern": like("start_time", wall), "endTime: pattern": like("end_time", wall),
        "title: minLength": full("title"), "tags: uniqueItems": unique("tags"), "purposes: uniqueItems": unique("purposes"), "urlRef: uri": like("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:\S+)?$"),
        "location: required": F.col("location.name").isNotNull() & F.col("location.detail").isNotNull(), "mappingRules: pattern": F.forall("mapping_rules", lambda r: r.rlike("^[a-z0-9][a-z0-9-]*:.+$")),
        "titleSource: enum": F.col("title_source").isNull() | F.col("title_source").isin("ics", "enriched", "fallback-speaker", "fallback-template", "fallback-series"),
    }


def schema_errors(events: DataFrame, most: int = 25) -> DataFrame:
    """(source, errors, examples): how many rules are broken, and the first ones by id."""
    each = events.select("source", "id", F.explode(violations(event_rules())).alias("rule"))
    first = F.row_number().over(W.partitionBy("source").orderBy("id", "rule"))
    some = each.withColumn("_n", first).filter(F.col("_n") <= most).groupBy("source").agg(F.array_sort(F.collect_list(F.concat_ws(": ", "id", "rule"))).alias("examples"))
    return each.groupBy("source").agg(F.count("*").alias("errors")).join(some, "source")


def first_ids(df: DataFrame, source: str, ident: str, test: Column, most: int = 5) -> DataFrame:
    """(source, ids): the least ids that a test finds, for a gate's report. A limit by group, before the shuffle too."""
    rank = F.row_number().over(W.partitionBy("source").orderBy(ident))
    found = df.filter(test).select(F.col(source).alias("source"), ident).distinct().withColumn("_n", rank)
    return found.filter(F.col("_n") <= most).groupBy("source").agg(F.array_sort(F.collect_list(ident)).alias("ids"))


def top_unmapped(values: DataFrame, column: str, k: int = 3) -> DataFrame:
    return values.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)
