"""Plans over whole publications: manifest and last-good fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest(registry: DataFrame, built: DataFrame, previous: DataFrame) -> DataFrame:
    """A row per source: status, stale, events, last_success. registry: source, live; built: source, ok, events, at;
    previous: source, events_before, last_success_before. A failed source is served from its last good publication."""
    out = registry.join(built, "source", "left").join(previous, "source", "left")
    live, ok, n = F.col("live"), F.coalesce("ok", F.lit(False)), F.coalesce("events", F.lit(0))
    status = F.when(~live, F.lit("disabled")).when(ok & (n > 0), F.lit("ok")).when(ok, F.lit("empty")).otherwise(F.lit("failed"))
    failed = live & ~ok
    return out.select(
        "source",
        status.alias("status"),
        (failed & F.col("events_before").isNotNull()).alias("stale"),
        F.when(~live, F.lit(0)).when(ok, n).otherwise(F.coalesce("events_before", F.lit(0))).cast("long").alias("events"),
        F.when(live & ok, F.col("at")).when(live, F.col("last_success_before")).alias("last_success"),
    )


def summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count("*").alias("feeds"), F.sum("events").alias("events"), F.sum(F.col("stale").cast("long")).alias("stale"))


def combo_status(inputs: DataFrame, rows: DataFrame) -> DataFrame:
    """Combined feeds (combo, source): stale if any input is, last success the least of them."""
    return inputs.join(rows, "source").groupBy("combo").agg(F.bool_or(F.col("stale") | (F.col("status") == "failed")).alias("stale"), F.min("last_success").alias("last_success"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("stale"), F.col("source")))), ",").alias("degraded"))


def with_last_good(new: DataFrame, previous: DataFrame, failed: DataFrame) -> DataFrame:
    """New records of sources that were built, previous records of those that failed."""
    return new.join(failed, "source", "left_anti").unionByName(previous.join(failed, "source", "left_semi"), allowMissingColumns=True)
