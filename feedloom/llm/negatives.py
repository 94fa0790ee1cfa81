"""[13] Hard negatives by a vector-approximation file: cells in place of components, bounds of scores from tables of cells."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import dropped, fresh, saved, table

ANCHOR_EVERY, SHIFT_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 5
#: Per cent of a positive's score that a negative must reach at least.
LEAST = 80
#: Cells of a dimension; one byte each in the file.
CELLS = 32
#: Bytes of vectors of the anchors that are broadcast at once (bounded), anchors and rows that a worker compares at once.
AT_ONCE, ANCHORS, ROWS = 8 << 20, 256, 1024
#: Pairs whose components a worker multiplies at once.
PAIRS = 1 << 15
#: Whole numbers up to here are exact in double precision.
EXACT = 2**53


def matrix(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the vectors without null or non-finite components, and their floor(256 x) padded with zeros."""
    size = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
    flat = lists.flatten()
    row = np.repeat(np.arange(len(lists)), size)
    x = np.floor(256.0 * np.asarray(pc.fill_null(flat, np.nan).cast(pa.float64())))
    good = np.asarray(lists.is_valid())
    good[row[~np.isfinite(x)]] = False
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros((len(lists), int(size[good].max(initial=0))))
    some = good[row]
    out[row[some], at[some]] = x[some]
    return np.flatnonzero(good), out[good]


def _padded(x: np.ndarray, wide: int) -> np.ndarray:
    return x if x.shape[1] == wide else np.pad(x, ((0, 0), (0, wide - x.shape[1])))


def _moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each dimension and batch: how many vectors, sums, squares, least and greatest component."""
    for batch in batches:
        _, x = matrix(batch.column("embedding"))
        if x.size:
            d = np.arange(x.shape[1])
            cols = [d, np.full(len(d), len(x)), x.sum(axis=0), (x * x).sum(axis=0), x.min(axis=0), x.max(axis=0)]
            kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["d", "n", "s", "s2", "lo", "hi"])


@dataclass
class Cells:
    """inner: the bounds between cells, a row for each dimension; low and high: the least and greatest component a cell
    can hold. Any bounds give right results; those of a normal distribution fill the cells about equally."""

    inner: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, vectors: DataFrame) -> Cells:
        """Bounds from sums over all rows; one row for each dimension comes to the driver."""
        sums = vectors.mapInArrow(_moments, "d long, n long, s double, s2 double, lo double, hi double").groupBy("d")
        found = sums.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("s2").alias("s2"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("d").toPandas()
        rows = found["n"].max() if len(found) else 1
        n, lo, hi = (found[c].to_numpy(float) for c in ("n", "lo", "hi"))
        lo, hi = np.where(n < rows, np.minimum(lo, 0), lo), np.where(n < rows, np.maximum(hi, 0), hi)  # shorter vectors end by zeros
        mean = found["s"].to_numpy(float) / rows
        sd = np.sqrt(np.maximum(found["s2"].to_numpy(float) / rows - mean**2, 0))
        z = np.array([NormalDist().inv_cdf(k / CELLS) for k in range(1, CELLS)])
        inner = np.clip(mean[:, None] + sd[:, None] * z, lo[:, None], hi[:, None])
        return cls(inner, np.hstack([lo[:, None], inner]), np.hstack([inner, hi[:, None]]))

    def code(self, x: np.ndarray) -> np.ndarray:
        """The cell of each component."""
        out = np.empty(x.shape, np.uint8)
        for d in range(x.shape[1]):
            out[:, d] = np.searchsorted(self.inner[d], x[:, d], side="right")
        return out

    def bounds(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each vector, by lookup of its cells: the middle of its box, and half of the box's width."""
        d = np.arange(cells.shape[1])
        low, high = self.low[d, cells], self.high[d, cells]
        return (low + high) / 2, (high - low) / 2


def _filed(shared) -> Callable:
    """Vectors to rows of the file: the cells, one byte a dimension, beside the components as they are needed last."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: Cells = shared.value
        for batch in batches:
            kept, x = matrix(batch.column("embedding"))
            x = _padded(x, len(cells.inner))
            rows = batch.take(pa.array(kept))
            codes, exact = (pa.array([r.tobytes() for r in v], pa.binary()) for v in (cells.code(x), x))
            yield pa.RecordBatch.from_arrays([rows.column("vec_id"), rows.column("label"), codes, exact], names=["vec_id", "label", "cells", "exact"])

    return run


def _read(column: pa.Array, kind) -> np.ndarray:
    """Equally long byte strings as rows of a matrix."""
    flat = np.frombuffer(b"".join(column.to_pylist()), kind)
    return flat.reshape(len(column), -1)


@dataclass
class Asked:
    """Anchors of a block: ids, labels, vectors; of each positive found: its anchor's place, id and score."""

    ids: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    of: np.ndarray | None = None
    score: np.ndarray | None = None
    cut: np.ndarray | None = None


def ranked(slot: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best entries of each slot, ties to smaller ids."""
    order = np.lexsort((ids, -score, slot))
    slot = slot[order]
    first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.zeros(0, int)
    rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
    return order[rank < k]


class Held:
    """The k best entries of each slot seen so far."""

    def __init__(self, k: int):
        self.k, self.slot, self.score, self.ids = k, np.zeros(0, np.int64), None, np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        score = score if self.score is None else np.concatenate([self.score, score])
        slot, ids = np.concatenate([self.slot, slot]), np.concatenate([self.ids, ids])
        best = ranked(slot, score, ids, self.k)
        self.slot, self.score, self.ids = slot[best], score[best], ids[best]

    def batch(self, kind) -> pa.RecordBatch:
        score = np.zeros(0) if self.score is None else self.score
        return pa.RecordBatch.from_arrays([pa.array(self.slot, pa.int64()), pa.array(score.tolist() if score.dtype == object else score, kind), pa.array(self.ids, pa.int64())], names=["slot", "score", "vec_id"])


def products(q: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows a of q with the rows b of x, as whole numbers."""
    small = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(q.shape[1], 1) < EXACT
    out = []
    for i in range(0, len(a), PAIRS):
        s = slice(i, i + PAIRS)
        if small:
            out.append(np.einsum("ij,ij->i", q[a[s]], x[b[s]]).astype(np.int64))
        else:
            out.append(np.array([sum(int(u) * int(v) for u, v in zip(q[m], x[n], strict=True)) for m, n in zip(a[s], b[s], strict=True)], object))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _tiles(batches: Iterable[pa.RecordBatch], cells: Cells, asked: Asked, same: bool):
    """For ROWS rows of the file and ANCHORS anchors at once: the batch, where its anchors begin, lower and upper bounds of the
    scores, and which pairs count (other ids; the same label, or another)."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            part = batch.slice(at, ROWS)
            ids, labels = np.asarray(part.column("vec_id")), np.asarray(part.column("label"))
            mid, half = cells.bounds(_read(part.column("cells"), np.uint8))
            for start in range(0, len(asked.ids), ANCHORS):
                q = asked.q[start : start + ANCHORS]
                near, far = q @ mid.T, np.abs(q) @ half.T
                far += 1e-9 * (np.abs(q) @ np.abs(mid).T + far) + 1  # more than doubles round
                alike = asked.labels[start : start + ANCHORS, None] == labels[None, :]
                pairs = (alike if same else ~alike) & (asked.ids[start : start + ANCHORS, None] != ids[None, :])
                yield part, ids, start, near - far, near + far, pairs


def _best_lower(cells_, asked_, k: int) -> Callable:
    """Positives, phase 1: each task's k best lower bounds of each anchor."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(k)
        for _, ids, start, lower, _, pairs in _tiles(batches, cells_.value, asked_.value, True):
            if lower.shape[1] > k:  # of a row of the tile only its k best can count
                best = np.where(pairs, lower, -np.inf)
                kth = -np.partition(-best, k - 1, axis=1)[:, k - 1]
                pairs = pairs & (lower >= kth[:, None])
            a, b = np.nonzero(pairs)
            held.add(a + start, lower[a, b], ids[b])
        yield held.batch(pa.float64())

    return run


def _positives(cells_, asked_, k: int) -> Callable:
    """Positives, phase 2: exact scores of the rows whose upper bound reaches the cutoff; each task's k best."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, held = asked_.value, Held(k)
        for part, ids, start, _, upper, pairs in _tiles(batches, cells_.value, asked, True):
            a, b = np.nonzero(pairs & (upper >= asked.cut[start : start + len(upper), None]))
            if len(a):
                held.add(a + start, products(asked.q[start:], _read(part.column("exact"), np.float64), a, b), ids[b])
        yield held.batch(pa.int64())

    return run


def _slots(asked: Asked, start: int, stop: int) -> range:
    """The places of the positives whose anchors lie in a tile."""
    return range(*np.searchsorted(asked.of, [start, stop]))


def _sure_lower(cells_, asked_, k: int, least: int) -> Callable:
    """Negatives, phase 1: of the rows that lie in a positive's window for sure, each task's k best lower bounds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, held = asked_.value, Held(k)
        for _, ids, start, lower, upper, pairs in _tiles(batches, cells_.value, asked, False):
            for s in _slots(asked, start, start + len(lower)):
                a = asked.of[s] - start
                b = np.flatnonzero(pairs[a] & (upper[a] <= asked.score[s]) & (100 * lower[a] >= least * float(asked.score[s])))
                held.add(np.full(len(b), s), lower[a, b], ids[b])
        yield held.batch(pa.float64())

    return run


def _negatives(cells_, asked_, k: int, least: int) -> Callable:
    """Negatives, phase 2: exact scores of the rows that may lie in a window and reach its cutoff; each task's k best."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, held = asked_.value, Held(k)
        for part, ids, start, lower, upper, pairs in _tiles(batches, cells_.value, asked, False):
            maybe = []
            for s in _slots(asked, start, start + len(lower)):
                a = asked.of[s] - start
                b = np.flatnonzero(pairs[a] & (lower[a] <= asked.score[s]) & (upper[a] >= max(asked.cut[s], least / 100 * float(asked.score[s]))))
                maybe.append((np.full(len(b), s), np.full(len(b), a), b))
            if not maybe:
                continue
            slot, a, b = (np.concatenate(x) for x in zip(*maybe, strict=True))
            pair, back = np.unique(a * len(ids) + b, return_inverse=True)  # a pair in several windows is scored once
            if not len(pair):
                continue
            score = products(asked.q[start:], _read(part.column("exact"), np.float64), pair // len(ids), pair % len(ids))[back]
            limit = np.array([int(x) for x in asked.score], object)[slot]
            inside = ((100 * score.astype(object) >= least * limit) & (score <= limit)).astype(bool)
            held.add(slot[inside], score[inside], ids[b[inside]])
        yield held.batch(pa.int64())

    return run


_FOUND = "slot long, score long, vec_id long"
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vectors and anchors (vec_id, label
    as a whole number, embedding).

    A row's score is its integer inner product with the anchor, of floor(256 x). An anchor's positives are its best rows
    of the same label; of each positive, the best rows of other labels whose score lies between `least` per cent of the
    positive's and the positive's are its negatives. Higher scores come first, ties by smaller id. A positive of
    negative score has an empty window.

    The file holds a byte for each component: its cell, of CELLS in each dimension, whose bounds come from sums over all
    rows. A lookup of the cells gives the box of a vector, hence a lower and an upper bound of each score. The k-th best
    lower bound that is sure to count is a cutoff; only rows whose upper bound reaches it, and whose bounds meet the
    window, are scored exactly. So four passes over the file for each block of anchors: cutoffs read the cells alone, and
    rows never leave their task but as k entries of an anchor or a window. A block of anchors is broadcast within
    AT_ONCE bytes, as are its positives; cutoffs come back by block.

    Rows with a null id, label or vector, or with null or non-finite components take no part; shorter vectors count as
    ended by zeros. Rows that repeat an id are candidates each, but never an anchor's of that id; a repeated anchor is
    asked once, with its least label and vector. Scores beyond 64 bits are an error. Empty tables give an empty result;
    further columns are ignored.
    """
    spark = vectors.sparkSession
    plain = lambda df: fresh(df, "vec_id", "label", "embedding").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding").filter("vec_id is not null and label is not null and embedding is not null")
    rows = plain(vectors)
    cells = Cells.of(rows)
    shared = spark.sparkContext.broadcast(cells)
    file = saved(rows.mapInArrow(_filed(shared), "vec_id long, label long, cells binary, exact binary"), "cells")
    wide = len(cells.inner)
    asked = plain(anchors).mapInArrow(_filed(shared), "vec_id long, label long, cells binary, exact binary") if wide else None
    found = []
    if asked is not None:
        asked = asked.groupBy("vec_id").agg(F.min(F.struct("label", "exact")).alias("r")).select("vec_id", "r.label", "r.exact")
        most = max(1, AT_ONCE // (8 * wide * max(1, positives)))
        blocks = -(-2 * asked.count() // most)
        asked = saved(asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks)))), "anchors")
        for b in range(blocks):
            part = asked.filter(F.col("block") == b).toArrow()
            for start in range(0, len(part), most):
                p = part.slice(start, most).combine_chunks()
                if len(p):
                    q = Asked(np.asarray(p["vec_id"]), np.asarray(p["label"]), _read(p["exact"], np.float64))
                    found.append(_mined(spark, file, shared, q, positives, negatives, least))
        dropped(asked)
    if not found:
        return spark.createDataFrame([], OUT)
    return spark.read.schema(found[0].schema).parquet(*(f._feedloom_path for f in found))


def _mined(spark: SparkSession, file: DataFrame, cells, asked: Asked, positives: int, negatives: int, least: int) -> DataFrame:
    """The four passes of a block of anchors; all that comes to the driver is bounded by the block."""
    best = W.partitionBy("slot").orderBy(F.desc("score"), "vec_id")
    top = lambda df, k: df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    def cutoffs(df: DataFrame, k: int, slots: int) -> np.ndarray:
        cut = np.full(slots, -np.inf)
        got = top(df, k).filter(F.col("rank") == k).select("slot", "score").toPandas()
        cut[got["slot"].to_numpy(np.int64)] = got["score"].to_numpy(float)
        return cut

    send = spark.sparkContext.broadcast
    narrow = file.select("vec_id", "label", "cells")
    asked.cut = cutoffs(narrow.mapInArrow(_best_lower(cells, send(asked), positives), "slot long, score double, vec_id long"), positives, len(asked.ids))
    near = top(file.mapInArrow(_positives(cells, send(asked), positives), _FOUND), positives).orderBy("slot", "rank").toPandas()
    near = near[near["score"] >= 0]
    with_positives = Asked(asked.ids, asked.labels, asked.q, near["slot"].to_numpy(np.int64), near["score"].to_numpy(np.int64))
    with_positives.cut = cutoffs(narrow.mapInArrow(_sure_lower(cells, send(with_positives), negatives, least), "slot long, score double, vec_id long"), negatives, len(near))
    got = top(file.mapInArrow(_negatives(cells, send(with_positives), negatives, least), _FOUND), negatives)
    names = pa.table([pa.array(np.arange(len(near))), pa.array(asked.ids[with_positives.of], pa.int64()), pa.array(near["vec_id"].to_numpy(np.int64)), pa.array(with_positives.score)], names=["slot", "anchor_id", "positive_id", "positive_score"])
    names = spark.createDataFrame(names) if len(near) else spark.createDataFrame([], "slot long, anchor_id long, positive_id long, positive_score long")
    out = got.join(F.broadcast(names), "slot")
    return saved(out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "mined")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the anchors, rows whose id is divisible by ANCHOR_EVERY, among all rows; where the id is
    divisible by SHIFT_EVERY, the label is the next one."""
    label = F.when(F.col("vec_id") % SHIFT_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    vectors = fresh(table(spark, sf_dir, "embeddings"), "vec_id", "label", "embedding").withColumn("label", label)
    return mine(vectors, vectors.filter(F.col("vec_id") % ANCHOR_EVERY == 0))


SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
QUALIFY rank <= 5
"""
