"""Streams: keyed merge state, incremental publication over versions in buckets, weekly windows, late discovery."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from feedloom.functions import timex


def weekly(events: DataFrame, ts: str, delay: str = "1 day") -> DataFrame:
    """Counts by edition week (Monday to Sunday) over a stream with a watermark; late records within it still count."""
    return events.withWatermark(ts, delay).groupBy(F.window(ts, "7 days", "7 days", "4 days")).agg(F.count("*").alias("n")).select(F.col("window.start").cast("date").alias("week"), "n")


#: The store that keyed state needs; a session's setting.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

_S, _L = T.StringType(), T.LongType()
_SEEN = T.StructType().add("digest", _S).add("id", _S)
_DIGEST = T.StructType().add("digest", _S)
_ONE = T.StructType().add("one", T.BooleanType())
_BEST = T.StructType().add("first", _S).add("record", _S).add("sources", T.ArrayType(_S)).add("n", _L)
_LAST = T.StructType().add("until", _L)
#: What a merge gives: the key and the digest of the details, the first record's place and the record, sources, count.
MERGED = T.StructType([T.StructField("key", _S), T.StructField("digest", _S), *_BEST.fields])


class Merge(StatefulProcessor):
    """Records of one key to one row for each digest of their details. State: which ids a digest has seen, so that a record
    that is delivered again changes nothing; the digest's first record, sources and count; and, with a retention, until
    when the key is kept, which a timer of event time enforces."""

    def __init__(self, keep_ms: int | None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", _SEEN, _ONE)
        self.best = handle.getMapState("best", _DIGEST, _BEST)
        self.last = handle.getValueState("last", _LAST)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        changed, until = {}, None
        for r in rows:
            if self.keep_ms is not None:
                end = int(r.at.timestamp() * 1000) + self.keep_ms
                until = end if until is None else max(until, end)
            if self.seen.containsKey((r.digest, r.id)):
                continue
            self.seen.updateValue((r.digest, r.id), (True,))
            old = changed.get(r.digest) or self.best.getValue((r.digest,))
            if old is None:
                new = (r.first, r.record, sorted(set(r.sources)), 1)
            else:
                first, record, sources, n = old
                if r.first < first:
                    first, record = r.first, r.record
                new = (first, record, sorted({*sources, *r.sources}), n + 1)
            changed[r.digest] = new
        for digest, new in changed.items():
            self.best.updateValue((digest,), new)
            yield Row(key=key[0], digest=digest, first=new[0], record=new[1], sources=list(new[2]), n=new[3])
        if until is not None:
            held = self.last.get() if self.last.exists() else None
            if held is None or until > held[0]:
                if held is not None:
                    self.handle.deleteTimer(held[0])
                self.last.update((until,))
                self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for state in (self.seen, self.best, self.last):
            state.clear()
        return iter(())

    def close(self) -> None:
        pass


def merged(stream: DataFrame, ident: str, key: dict[str, Column], details: dict[str, Column], order: Column, sources: str = "sources", at: str | None = None, delay: str = "1 day", keep: int | None = None) -> DataFrame:
    """MERGED rows of a stream in update mode: of each key and each total match of the details the first record in
    `order` (as JSON), the sorted union of the sources, and how many records. The last row of a digest is what a merge
    over all records at once gives, whatever the batches, their order and repeated deliveries: a record counts once by
    its id, and its place does not depend on its arrival.

    key and details are as those of `operators.combine.merged`. Work and state are by key and row: no batch rewrites what
    it does not touch, and a hot key costs one lookup for each of its records. Without `keep`, state is kept for good;
    with it (days), the key is forgotten when the watermark of `at` passes its last record by so much.
    The session needs STATE_STORE.
    """
    named = stream.withWatermark(at, delay) if keep is not None else stream
    digest = lambda cs: F.sha2(F.to_json(F.struct(*(c.alias(n) for n, c in cs.items())), {"ignoreNullFields": "false"}), 256)
    record = F.to_json(F.struct(*stream.columns))
    rows = named.select(
        digest(key).alias("key"), digest(details).alias("digest"), F.col(ident).cast("string").alias("id"), order.cast("string").alias("first"),
        record.alias("record"), F.col(sources).alias("sources"), *([F.col(at).alias("at")] if keep is not None else []),
    )
    mode = "EventTime" if keep is not None else "None"
    return rows.groupBy("key").transformWithState(Merge(keep * 86_400_000 if keep is not None else None), MERGED, "Update", mode)


#: Parts of the state by a hash of the key; a batch rewrites only those that it touches.
BUCKETS = 64


def publish(stream: DataFrame, path: str, key: list[str], newest: Column, checkpoint: str, buckets: int = BUCKETS):
    """Keeps the newest record of each key in a table under `path`, in buckets of keys: every batch reads the last version
    of the buckets that it touches, merges and writes the next ones, so a failed batch leaves the last good state. What
    no reader of the last two versions of a bucket can want is removed after each batch. Runs over what is there, then
    stops."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        touched = {r.b for r in batch.select(bucket.alias("b")).distinct().collect()}
        old = latest(spark, path, batch.schema, before=number, only=touched)
        every = batch if old is None else batch.unionByName(old)
        best = every.groupBy(*key).agg(F.max_by(F.struct(*batch.columns), newest).alias("r")).select("r.*")
        best.withColumn("_bucket", bucket).write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/v={number}")
        _pruned(spark, path)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _versions(spark: SparkSession, path: str) -> tuple[object, dict[int, dict[int, object]]]:
    """The file system, and the finished versions of each bucket with their folders."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[int, dict[int, object]] = {}
    for s in fs.listStatus(root) if fs.exists(root) else []:
        if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            for part in fs.listStatus(s.getPath()):
                name = part.getPath().getName()
                if name.startswith("_bucket="):
                    found.setdefault(int(name[8:]), {})[int(s.getPath().getName()[2:])] = part.getPath()
    return fs, found


def _pruned(spark: SparkSession, path: str, keep: int = 2) -> None:
    fs, found = _versions(spark, path)
    for versions in found.values():
        for v in sorted(versions)[:-keep]:
            fs.delete(versions[v], True)


def latest(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None, only: set[int] | None = None) -> DataFrame | None:
    """The last version of each bucket (or of some) that a batch finished, or None."""
    paths = []
    for b, versions in _versions(spark, path)[1].items():
        known = [v for v in versions if before is None or v < before]
        if known and (only is None or b in only):
            paths.append(versions[max(known)].toString())
    return spark.read.schema(schema).parquet(*paths) if paths else None


def due_batches(stream: DataFrame, cadence: DataFrame, minutes_since: Column, key: str = "source") -> DataFrame:
    """Records of a stream whose source is due by its cadence (source, cadence in minutes; a row for each source)."""
    return stream.join(F.broadcast(cadence), key).filter(timex.due(minutes_since, F.col("cadence"))).drop("cadence")


def discover(stream: DataFrame, path: str, key: str, newest: Column, checkpoint: str, found: Callable[[DataFrame, int], None], buckets: int = BUCKETS):
    """Late discovery: found(batch, number) gets the records whose key the state under `path` (that of `publish`) does not
    hold, each key once with its newest record, however late it comes; then they are put into the state. An anti-join
    with the buckets that the batch touches, not a watermark: a key is new if no earlier batch had it. A batch that is
    run again sees the state before it, so it finds the same."""
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        once = batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), newest).alias("r")).select("r.*")
        touched = {r.b for r in batch.select(bucket.alias("b")).distinct().collect()}
        held = latest(spark, path, batch.schema, before=number, only=touched)
        new = once if held is None else once.join(held.select(key), key, "left_anti")
        found(new, number)
        every = new if held is None else new.unionByName(held)
        every.withColumn("_bucket", bucket).write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/v={number}")
        _pruned(spark, path)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
