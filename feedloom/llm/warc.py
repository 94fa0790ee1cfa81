"""[1] WARC archives: records written by the engine's own writer, capture runs sorted locally and merged by a loser tree."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import fresh, saved, scratch, table, tasks

#: Fixed value: the alphabet of base32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Digests of copies are broadcast while they are at most so many (about 8 MB), else both sides are shuffled.
FEW = 100_000
#: Index rows of one merge task on average.
MERGE_ROWS = 200_000
BREAK = "\r\n"
FIRST_CAPTURE = 1_700_000_000
#: The protocol's head of every response block; the payload follows it.
HTTP = f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK * 2}"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: four characters for every five hexadecimal digits."""
    digits = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(F.sha1(data), i * 5 + 1, F.lit(5)), 16, 10).cast("int"))
    letters = F.flatten(F.transform(digits, lambda n: F.array(*(F.substring(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)))))
    return F.array_join(letters, "")


def url_key(url: Column) -> Column:
    """The key that captures are sorted by: host labels reversed and joined by commas, then ')' and the path, lower-cased."""
    bare = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://", ""))
    host = F.regexp_replace(F.regexp_extract(bare, r"^([^/?#]*)", 1), r"^www\d*\.|:\d+$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(F.regexp_extract(bare, r"^[^/?#]*([^#]*)", 1), "^$", "/"))


def _record(boundary: str) -> Column:
    """A record of WARC 1.1 as text; the writer ends each with two line breaks."""
    head = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))
    response = F.col("refers_to").isNull()
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")
    lines = [
        F.lit(f"WARC/1.1{BREAK}WARC-Boundary: {boundary}{BREAK}"),
        head("WARC-Type", F.when(response, F.lit("response")).otherwise(F.lit("revisit"))),
        head("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        head("WARC-Target-URI", uri),
        head("WARC-Date", F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        head("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        head("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.when(response, F.lit("")).otherwise(head("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))),
        F.when(response, F.lit("")).otherwise(head("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        head("Content-Type", F.lit("application/http; msgtype=response")),
        head("Content-Length", F.when(response, F.col("bytes") + len(HTTP)).otherwise(F.lit(0)).cast("string")),
        F.lit(BREAK),
        F.when(response, F.concat(F.lit(HTTP), F.col("payload"))).otherwise(F.lit("")),
    ]
    return F.concat(*lines)


def write(pages: DataFrame, least_bytes: int = 0) -> tuple[str, str]:
    """Writes a record for every page (page_id, url, html) to a folder of archives; the folder and its boundary.

    Of payloads that are equal and have at least `least_bytes`, the record of the smallest id holds the payload, the
    others revisit it. Only digests are grouped (a partial minimum before the shuffle, so a payload of any number of
    copies is cheap); those that have copies come back to the pages, broadcast only while they are few.
    """
    spark = pages.sparkSession
    boundary = uuid.uuid4().hex
    base = fresh(pages, "page_id", "url", "html").withColumn("payload", F.coalesce("html", F.lit(""))).drop("html")
    base = base.withColumn("digest", base32_sha1(F.col("payload").cast("binary"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    base = base.withColumn("captured", F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.coalesce(F.col("page_id"), F.lit(0)) % 100_000_000))
    copied = base.filter(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    copied = saved(copied, "copied")
    joined = base.join(F.broadcast(copied) if copied.count() <= FEW else copied, "digest", "left")
    joined = joined.withColumn("refers_to", F.when((F.col("bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
    path = scratch(spark, "warc")
    # the null id and its like in a record are the word null
    joined = joined.withColumn("page_id", F.coalesce(F.col("page_id").cast("string"), F.lit("null")))
    joined.select(_record(boundary).alias("value")).write.option("lineSep", BREAK * 2).text(path)
    return path, boundary


def read(spark: SparkSession, path: str, boundary: str) -> DataFrame:
    """Records of archives that write() made: url_key, captured, page_id, refers_to, record_type, digest, payload_bytes,
    url, payload, archive. The line reader splits archives of any size at the boundary; a payload whose length or
    digest is not as its head says is an error."""
    mark = f"WARC/1.1{BREAK}WARC-Boundary: {boundary}{BREAK}"
    raw = spark.read.option("lineSep", f"{BREAK * 2}{mark}").text(path).select("value", F.input_file_name().alias("archive"))
    cut = F.instr("value", BREAK * 2)
    head, rest = F.substring("value", F.lit(1), cut + 1), F.expr("substring(value, instr(value, '\\r\\n\\r\\n') + 4)")
    field = lambda name: F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    out = raw.select("archive", head.alias("head"), rest.alias("rest"))
    out = out.select(
        "archive",
        url_key(field("WARC-Target-URI")).alias("url_key"),
        F.to_timestamp(field("WARC-Date"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
        F.try_to_number(F.regexp_extract(field("WARC-Record-ID"), r"page:([0-9-]+)", 1), F.lit("S9999999999999999999")).cast("long").alias("page_id"),
        F.try_to_number(F.regexp_extract(field("WARC-Refers-To"), r"page:([0-9-]+)", 1), F.lit("S9999999999999999999")).cast("long").alias("refers_to"),
        field("WARC-Type").alias("type"),
        F.regexp_extract(field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("digest"),
        field("WARC-Payload-Length").cast("long").alias("payload_bytes"),
        field("WARC-Target-URI").alias("url"),
        field("Content-Length").cast("int").alias("length"),
        "rest",
    )
    # the last record of an archive still has the two line breaks that end it
    out = out.withColumn("payload", F.expr(f"cast(substring(cast(rest as binary), {len(HTTP) + 1}, length - {len(HTTP)}) as string)"))
    sound = (F.col("type") == "revisit") | ((F.octet_length("payload") + len(HTTP) == F.col("length")) & (base32_sha1(F.col("payload").cast("binary")) == F.col("digest")))
    out = out.withColumn("payload_bytes", F.when(sound, F.col("payload_bytes")).otherwise(F.raise_error(F.lit("a WARC record is not as its head says")).cast("long")))
    kind = F.when(F.col("type") == "revisit", F.lit("revisit")).otherwise(F.lit("response"))
    return out.select("url_key", "captured", "page_id", "refers_to", kind.alias("record_type"), "digest", "payload_bytes", "url", "payload", "archive")


class LoserTree:
    """k-way merge: the winner on top, in every other node the loser of its match; log2(k) comparisons a row."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.k = max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.nodes = [-1] * self.k
        for leaf in range(self.k):
            self._play(leaf, building=True)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    def _play(self, leaf: int, building: bool = False) -> None:
        node, winner = (leaf + self.k) // 2, leaf
        while node > 0:
            if self.nodes[node] == -1:
                if building:
                    self.nodes[node] = winner
                    return
            elif self._before(self.nodes[node], winner):
                self.nodes[node], winner = winner, self.nodes[node]
            node //= 2
        self.nodes[0] = winner

    def __iter__(self) -> Iterator:
        while (winner := self.nodes[0]) >= 0 and (head := self.heads[winner]) is not None:
            yield head
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


_KEY = ("url_key", "captured", "page_id")


def _order(row: tuple) -> tuple:
    """Url key, then time, then id, nulls first."""
    return tuple((x is not None, x) if x is not None else (False, 0) for x in row[:3])


def _sorted_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted run of each batch of captures, with its rows' places; runs are numbered by task and batch."""
    task = TaskContext.get().partitionId() << 32
    for number, batch in enumerate(batches):
        order = pc.sort_indices(batch, [(c, "ascending") for c in _KEY], null_placement="at_start")
        t = batch.take(order)
        yield pa.RecordBatch.from_arrays([*t.columns, pa.array([task + number] * len(t), pa.int64()), pa.array(range(len(t)), pa.int64())], names=[*t.schema.names, "run", "place"])


def _merged(names: list[str]) -> Callable:
    """Merges the slices of runs that lie in a range; rows stay in Arrow's columns, the tree sees their keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        part = TaskContext.get().partitionId()
        table = pa.Table.from_batches(held).sort_by([("run", "ascending"), ("place", "ascending")])  # slices come in any order
        number = np.asarray(table.column("run"))
        ends = np.flatnonzero(np.append(True, number[1:] != number[:-1])).tolist() + [len(table)]
        keys = list(zip(*(table.column(c).to_pylist() for c in _KEY), strict=True))
        slices = [((_order(keys[i]), i) for i in range(a, b)) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        order = np.fromiter((i for _, i in LoserTree(slices)), np.int64, len(table))
        for at in range(0, len(order), 10_000):
            some = table.select(names).take(pa.array(order[at : at + 10_000])).combine_chunks()
            some = some.append_column("part", pa.array([part] * len(some), pa.int32())).append_column("at", pa.array(range(at, at + len(some)), pa.int64()))
            yield from some.to_batches()

    return run


def index(captures: DataFrame) -> DataFrame:
    """Captures (url_key, captured, page_id, archive and more) with their position in the global order of url key, time
    and id, nulls first.

    Every reading task sorts its batches to runs; the runs are dealt to ranges of the whole key, so that a url with any
    number of captures is many ranges, each of about MERGE_ROWS rows; each task merges its slices of the runs with a
    loser tree. Ranges follow the order, so a row's position is its place in the range after the rows of those before,
    whose numbers are all that the driver sees.
    """
    spark, names = captures.sparkSession, captures.columns
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in captures.schema.fields)
    runs = saved(captures.mapInArrow(_sorted_runs, f"{fields}, run long, place long"), "runs")
    parts = max(tasks(spark), -(-runs.count() // MERGE_ROWS))
    merged = saved(runs.repartitionByRange(parts, *_KEY).mapInArrow(_merged(names), f"{fields}, part int, at long"), "merged")
    sizes = sorted((r.part, r["count"]) for r in merged.groupBy("part").count().collect())
    before = [(p, sum(n for q, n in sizes if q < p)) for p, _ in sizes]
    offsets = spark.createDataFrame(before, "part int, before long")
    return merged.join(F.broadcast(offsets), "part").select(*names, (F.col("before") + F.col("at")).alias("position"))


def histories(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes the archives of pages, reads them back and merges their index: a row per page with its position in the order of url key, time and id.

    A null html is an empty payload; null urls have an empty target; null ids are kept, and among equal payloads the
    smallest id that is not null holds the payload. Rows that repeat an id repeat its record. Further columns are
    ignored. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    path, boundary = write(pages, least_bytes)
    return index(read(spark, path, boundary).drop("payload"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page of the table: page_id, payload_bytes, payload_digest, record_type, refers_to, and of the merged
    index url_key, captured and position."""
    out = histories(table(spark, sf_dir, "pages"))
    at = F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured")
    return out.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to", "url_key", at, "position")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, lower(regexp_replace(regexp_replace(coalesce(url, ''), '[\\r\\n]', ' ', 'g'), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '')) AS bare FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first,
  array_to_string(list_reverse(string_split(regexp_replace(regexp_extract(bare, '^([^/?#]*)', 1), '^www[0-9]*\\.|:[0-9]+$', '', 'g'), '.')), ',') || ')'
    || regexp_replace(regexp_extract(bare, '^[^/?#]*([^#]*)', 1), '^$', '/') AS url_key,
  strftime(make_timestamp((1700000000 + page_id % 100000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to,
  url_key, captured, row_number() OVER (ORDER BY url_key, captured, page_id) - 1 AS position
FROM d
"""
