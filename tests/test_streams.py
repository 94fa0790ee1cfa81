"""Keyed merge state, late discovery, weekly windows and due batches, with replays and late records."""

import json
import random

import pytest
from pyspark.sql import functions as F

from feedloom import streaming
from feedloom.functions import text
from feedloom.operators import combine

SCHEMA = "id long, title string, content string, sources array<string>, at timestamp"


@pytest.fixture
def store(spark):
    key, value = streaming.STATE_STORE
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    yield
    spark.conf.set(key, old)


def batches(spark, path, parts):
    for rows in parts:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(path)


def last_of(rows):
    """The newest row of each digest: the one with most records."""
    out = {}
    for r in rows:
        if (r.key, r.digest) not in out or out[r.key, r.digest].n <= r.n:
            out[r.key, r.digest] = r
    return sorted((json.loads(r.record)["id"], tuple(r.sources), r.n) for r in out.values())


def test_replayed_and_late_batches_give_the_batch_answer(spark, tmp_path, store):
    rng = random.Random(7)
    rows = [(i, rng.choice(["Winds – Waves", "winds - waves", "Other", "Straße"]), rng.choice(["a", "b", "A"]), [rng.choice("xyz")], None) for i in range(60)]
    late = rows[:20]
    key, details = {"title": text.compare_form(F.col("title"))}, {"content": text.compare_form(F.col("content"))}
    found = []
    for part in (rows[20:45], rows[45:], rows[30:50], late, late + rows[55:]):  # the third repeats, the fourth is late, the fifth both
        batches(spark, f"{tmp_path}/in", [part])
        stream = spark.readStream.schema(SCHEMA).json(f"{tmp_path}/in")
        out = streaming.merged(stream, "id", key, details, F.lpad(F.col("id").cast("string"), 20, "0"))
        q = out.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True)
        q = q.foreachBatch(lambda b, n: found.extend(b.collect())).start()
        assert q.awaitTermination(120)
    whole = combine.merged(spark.createDataFrame(rows, SCHEMA), key, details, ["id"]).collect()
    assert last_of(found) == sorted((r.id, tuple(r.sources), r.n) for r in whole)


def test_a_key_is_forgotten_after_its_time(spark, tmp_path, store):
    day = lambda d: __import__("datetime").datetime(2024, 1, d)
    found = []
    for part in ([(1, "t", "c", ["x"], day(1))], [(2, "u", "c", ["x"], day(20))], [(3, "u", "d", ["x"], day(21))], [(4, "t", "c", ["y"], day(25))]):
        batches(spark, f"{tmp_path}/in", [part])
        stream = spark.readStream.schema(SCHEMA).json(f"{tmp_path}/in")
        out = streaming.merged(stream, "id", {"title": F.col("title")}, {"content": F.col("content")}, F.col("id"), at="at", keep=3)
        q = out.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True)
        assert q.foreachBatch(lambda b, n: found.extend((json.loads(r.record)["id"], r.n) for r in b.collect())).start().awaitTermination(120)
    assert sorted(found) == [(1, 1), (2, 1), (3, 1), (4, 1)]  # the last one finds nothing of the first


def test_late_discovery_is_no_watermark(spark, tmp_path):
    schema, found = "id long, at long", []
    for rows in ([(1, 5), (2, 9)], [(1, 6), (3, 9), (3, 10)], [(4, 0), (2, 1)]):  # the last new one is older than all
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).json(f"{tmp_path}/in")
        q = streaming.discover(stream, f"{tmp_path}/state", "id", F.col("at"), f"{tmp_path}/check", lambda b, n: found.append(sorted(map(tuple, b.collect()))), buckets=4)
        assert q.awaitTermination(120)
    assert found == [[(1, 5), (2, 9)], [(3, 10)], [(4, 0)]]


def test_old_versions_go(spark, tmp_path):
    schema = "id long, at long"
    for k in range(5):
        spark.createDataFrame([(1, k), (k + 10, 0)], schema).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).json(f"{tmp_path}/in")
        assert streaming.publish(stream, f"{tmp_path}/out", ["id"], F.col("at"), f"{tmp_path}/check", buckets=1).awaitTermination(120)
    assert len(list(tmp_path.glob("out/v=*/_bucket=0"))) == 2
    last = streaming.latest(spark, f"{tmp_path}/out", spark.createDataFrame([], schema).schema)
    assert sorted(map(tuple, last.collect())) == [(1, 4), (10, 0), (11, 0), (12, 0), (13, 0), (14, 0)]


def test_weekly_windows_and_due_batches(spark, tmp_path):
    rows = [("a", "2024-01-07 23:00:00"), ("a", "2024-01-08 00:00:00"), ("b", "2024-01-14 23:59:59"), ("b", "2024-01-02 00:00:00")]
    spark.createDataFrame(rows, "source string, s string").withColumn("ts", F.to_timestamp("s")).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("source string, s string, ts timestamp").parquet(f"{tmp_path}/in")
    weeks, due = [], []
    q = streaming.weekly(stream, "ts").writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True)
    assert q.foreachBatch(lambda b, n: weeks.extend(map(tuple, b.collect()))).start().awaitTermination(120)
    assert sorted((str(w), n) for w, n in weeks) == [("2024-01-01", 2), ("2024-01-08", 2)]
    cadence = spark.createDataFrame([("a", 60), ("b", 1440)], "source string, cadence int")
    since = F.when(F.col("source") == "a", 55).otherwise(100)
    q = streaming.due_batches(stream, cadence, since).writeStream.option("checkpointLocation", f"{tmp_path}/c2").trigger(availableNow=True)
    assert q.foreachBatch(lambda b, n: due.extend(r.source for r in b.collect())).start().awaitTermination(120)
    assert due == ["a", "a"]
