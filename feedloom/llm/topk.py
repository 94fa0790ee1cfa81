"""[9] Exact top-k inner products by a three-phase uniform threshold."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import fresh, saved, table

EVERY, TOP = 50, 5
#: Lists that a score is the sum of: blocks of components.
LISTS = 4
#: Queries that are broadcast at once (bounded), and candidate rows that a worker compares at once.
QUERIES, ROWS = 2048, 2048
#: Whole numbers up to here are exact in double precision.
EXACT = 2**53


def whole(batch: pa.RecordBatch) -> tuple[np.ndarray, list[int], np.ndarray]:
    """ids, row numbers kept, and floor(256 x) of vectors without null or non-finite components, padded with zeros."""
    ids, kept, rows = [], [], []
    for i, (v, x) in enumerate(zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True)):
        if v is None or not x.is_valid or x.values.null_count:
            continue
        a = np.floor(256.0 * np.asarray(x.values, dtype=np.float64))
        if np.isfinite(a).all():
            ids.append(v)
            kept.append(i)
            rows.append(a)
    wide = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), wide))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return np.array(ids, np.int64), kept, out


def _exact(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both cut to their common width; as whole numbers without bound (slow) where sums could pass EXACT."""
    wide = min(q.shape[1], x.shape[1])
    q, x = q[:, :wide], x[:, :wide]
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(wide, 1)
    if most >= EXACT:
        q, x = (np.vectorize(int, otypes=[object])(v.astype(object)) for v in (q, x))
    return q, x


def _cuts(wide: int) -> list[slice]:
    """The components of each list."""
    cuts = np.linspace(0, wide, LISTS + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _sums(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return q @ x.T if q.shape[1] else np.zeros((len(q), len(x)), x.dtype)  # a double zero would round whole numbers


def parts(q: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    """The sums of each list, queries by rows, exact: in double precision while all sums fit, else in whole numbers."""
    q, x = _exact(q, x)
    return [_sums(q[:, c], x[:, c]) for c in _cuts(q.shape[1])]


def reaching(q: np.ndarray, x: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query, row and score of every pair that reaches its query's cutoff, and how many list sums were computed.

    A pair's lists not yet summed give at most the products of their norms. A row whose sums and this bound stay below
    the cutoff of every query is left before its next list. Of the other rows, a pair goes on that has an entry of at
    least cutoff / LISTS in some list, as each pair that reaches the cutoff has.
    """
    q, x = _exact(q, x)
    cuts = _cuts(q.shape[1])
    long = [np.stack([np.sqrt((v[:, c].astype(float) ** 2).sum(axis=1)) for c in cuts], axis=1) for v in (q, x)]
    row, done = np.arange(len(x)), 0
    score, enough = np.zeros((len(q), len(x)), x.dtype), np.zeros((len(q), len(x)), bool)
    for k, c in enumerate(cuts):
        rest, sums = long[0][:, k:] @ long[1][row, k:].T, score.astype(float)
        slack = 1e-9 * (rest + np.abs(sums)) + 1  # more than doubles round
        live = (~(sums + rest + slack < cut[:, None])).any(axis=0)
        if not live.all():
            row, score, enough = row[live], score[:, live], enough[:, live]
        s = _sums(q[:, c], x[row, c])
        done += s.size
        score = score + s
        enough |= (s >= (cut / LISTS)[:, None]).astype(bool)
    at, to = np.nonzero(enough & (score >= cut[:, None]).astype(bool))
    return at, row[to], score[at, to], done


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            ids, _, x = whole(batch.slice(at, ROWS))
            if len(ids):
                yield ids, x


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of a row, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


_FOUND = "query_id long, vec_id long, score long"


def _rows(query, vec, score):
    return pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.int64())], names=["query_id", "vec_id", "score"])


def _local_lists(shared, k: int):
    """Phase 1: of each list, the k best rows of this task, with their full scores; of those the k best."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qid, q = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(qid)
        for ids, x in _blocks(batches):
            lists = parts(q, x)
            full = sum(lists)
            near = [np.argpartition(-s, k - 1, axis=1)[:, :k] if len(ids) > k and s.dtype != object else np.argsort(-s, axis=1)[:, :k] for s in lists]
            near = np.concatenate(near, axis=1)
            for i in range(len(qid)):
                some = np.unique(near[i])
                some = some[ids[some] != qid[i]]
                v = np.concatenate([held[i][0], ids[some]])
                s = np.concatenate([held[i][1], full[i, some].astype(np.int64)])
                b = _best(s, v, k)
                held[i] = v[b], s[b]
        if len(qid):
            yield _rows(np.repeat(qid, [len(v) for v, _ in held]), np.concatenate([v for v, _ in held]), np.concatenate([s for _, s in held]))

    return run


def _above(shared, cutoffs, k: int):
    """Phases 2 and 3: rows that may still reach a cutoff, list by list, with an entry of at least cutoff / LISTS in some
    list; their remaining entries are added to full scores, and of those that reach the cutoff the task's k best go on."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (qid, q), cut = shared.value, cutoffs.value
        held: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(qid)
        for ids, x in _blocks(batches):
            at, row, score, _ = reaching(q, x, cut)
            other = ids[row] != qid[at]
            at, row, score = at[other], row[other], score[other].astype(np.int64)
            order = np.lexsort((ids[row], -score, at))
            at, row, score = at[order], row[order], score[order]
            ends = np.searchsorted(at, np.arange(len(qid) + 1))
            for i in np.unique(at):
                mine = slice(ends[i], min(ends[i + 1], ends[i] + k))
                v, s = np.concatenate([held[i][0], ids[row[mine]]]), np.concatenate([held[i][1], score[mine]])
                b = _best(s, v, k)
                held[i] = v[b], s[b]
        if len(qid):
            yield _rows(np.repeat(qid, [len(v) for v, _ in held]), np.concatenate([v for v, _ in held]), np.concatenate([s for _, s in held]))

    return run


def _cutoffs(kth: list[int | None]) -> np.ndarray:
    """Cutoffs as doubles, never above the score: one step lower where whole numbers round. None, of a query with fewer
    than k rows: every row reaches it."""
    cut = np.array([-np.inf if s is None else s for s in kth], float)
    return np.where(np.abs(cut) >= EXACT, np.nextafter(cut, -np.inf), cut)


def search(vectors: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): of every query the k rows of highest integer inner product, its own id left out.

    A score is the sum of LISTS partial scores. Phase 1 gathers each task's best entries of each list, with full scores;
    the k-th best full score seen is a safe cutoff, since it is some row's score. Phase 2 broadcasts the cutoff: a row
    that reaches it has an entry of at least cutoff / LISTS in some list, so only such rows are collected, and a row is
    left at the first list from which norms prove that it reaches no query's cutoff. Phase 3 resolves their scores
    exactly. Candidates are never shuffled and never leave their task but as k rows a query;
    queries are taken in blocks of QUERIES, each broadcast with a proven bound.

    Null vectors and ids, and vectors with null or non-finite components, take no part. Shorter vectors count as ended
    by zeros. Ties go to the smaller id. Rows that repeat an id are candidates each; a query's id that repeats is asked
    once, with the row of least vector. Scores beyond 64 bits are an error. Empty tables give an empty result.
    """
    spark = vectors.sparkSession
    vectors = fresh(vectors, "vec_id", "embedding")
    asked = saved(fresh(queries, "vec_id", "embedding").filter("vec_id is not null and embedding is not null"), "queries")
    # blocks of ids by count, in order; a block's rows are collected, at most QUERIES of them
    number = asked.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    blocks = max(1, -(-number.count() // (QUERIES // 2)))
    number = saved(number.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), "numbered") if blocks > 1 else number.withColumn("block", F.lit(0))
    found = None
    for b in range(blocks):
        batch = number.filter(F.col("block") == b).select("vec_id", "embedding").toArrow().combine_chunks().to_batches()
        for part in batch:
            for start in range(0, len(part), QUERIES):
                qid, _, q = whole(part.slice(start, QUERIES))
                if not len(qid):
                    continue
                shared = spark.sparkContext.broadcast((qid, q))
                first = vectors.mapInArrow(_local_lists(shared, k), _FOUND)
                w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
                kth = {r.query_id: r.score for r in first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") == k).select("query_id", "score").collect()}
                cut = spark.sparkContext.broadcast(_cutoffs([kth.get(i) for i in qid.tolist()]))
                rows = vectors.mapInArrow(_above(shared, cut, k), _FOUND)
                rows = rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
                rows = saved(rows.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "top")
                found = rows if found is None else found.union(rows)
    return found if found is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
