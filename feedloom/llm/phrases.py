"""[11] Collocations: count-min sketches of all n-grams are merged, and a second pass counts exactly what they let through."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import fresh, listed, mix64, saved, table, tasks, text_blocks

#: Occurrences of a candidate, per cent of it that a longer one covers, phrases returned of a language.
LEAST, SUBSUMED, TOP = 10, 50, 2000
#: Rows of a sketch, and cells of a row as powers of two: as many as a table of so many words needs, within these bounds.
#: A cell is a byte that stops at 255; what is broadcast is a bit for each cell.
DEPTH, NARROW, WIDE = 2, 16, 26
#: Words for each cell.
LOAD = 1.5
#: Cells that are merged and sent as one piece.
PIECE = 1 << 16
#: Bytes of text that a worker holds as words at once.
AT_ONCE = 4 << 20

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
#: Bytes between words, and bytes between pieces.
BLANKS, MARKS = b" \t", b".,;:!?\n\x0b\x0c\r"
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(BLANKS)], _CLASS[list(MARKS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of a block of texts: codes into `names`, languages, and where a word continues the piece of the one before."""

    def __init__(self, block: pa.RecordBatch):
        text = pc.fill_null(block.column("text"), "").cast(pa.large_string())
        off = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        raw = text.buffers()[2]
        data = _LOWER[np.frombuffer(raw, np.uint8)[off[0] : off[-1]]] if raw is not None else np.zeros(0, np.uint8)
        kind = _CLASS[data]
        part = kind == 0
        edge = np.zeros(len(data) + 1, bool)
        edge[off - off[0]] = True
        start = part.copy()
        start[1:] &= ~part[:-1] | edge[1:-1]
        start = np.flatnonzero(start)
        stop = part.copy()
        stop[:-1] &= ~part[1:] | edge[1:-1]
        size = np.flatnonzero(stop) + 1 - start
        piece = np.cumsum(kind == 2)[start]
        doc = np.searchsorted(off - off[0], start, side="right") - 1
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data[part])]).dictionary_encode()
        lang = block.column("lang").dictionary_encode()
        self.langs, self.names = lang.dictionary.to_pylist(), coded.dictionary
        self.code = np.asarray(coded.indices).astype(np.int64)
        self.lang = np.asarray(lang.indices)[doc].astype(np.int64)
        self.goes_on = np.zeros(len(start), bool)
        self.goes_on[1:] = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])

    def __len__(self) -> int:
        return len(self.code)

    def starts(self, n: int) -> np.ndarray:
        """Where n words of one piece begin."""
        whole = len(self) - n + 1
        if whole <= 0:
            return np.zeros(0, np.int64)
        ok = np.ones(whole, bool)
        for i in range(1, n):
            ok &= self.goes_on[i : i + whole]
        return np.flatnonzero(ok)

    def hashes(self) -> np.ndarray:
        """64 bits of each word in its language."""
        word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in listed(self.names)), np.uint64, len(self.names))
        lang = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in self.langs), np.uint64, len(self.langs))
        return mix64(word[self.code] + lang[self.lang] * _ODD[0])

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """n, the starts and the hashes of the phrases of 2 and 3 words."""
        one = self.hashes()
        for n in (2, 3):
            at = self.starts(n)
            h = one[at]
            for i in range(1, n):
                h = mix64(h * _ODD[1] + mix64(one[at + i] + _ODD[2]))
            yield n, at, h


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, limit=AT_ONCE):
        w = Words(block)
        key, count = np.unique(w.code * len(w.langs) + w.lang, return_counts=True)
        lang = pa.array(w.langs, pa.string()).take(pa.array(key % max(len(w.langs), 1)))
        yield pa.RecordBatch.from_arrays([lang, w.names.take(pa.array(key // max(len(w.langs), 1))).cast(pa.string()), pa.array(count)], names=["lang", "phrase", "f"])


def cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of each hash in a row of the sketch; in row 0 the order of cells is that of the hashes."""
    h = h if row == 0 else mix64(h ^ _ODD[3] * np.uint64(row))
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def sketched(sketch: np.ndarray, h: np.ndarray) -> None:
    """Adds hashes (with repeats) to a sketch of DEPTH rows of saturating bytes, in place."""
    bits = sketch.shape[1].bit_length() - 1
    h, count = np.unique(h, return_counts=True)
    for row in range(len(sketch)):
        at, n = cells(h, row, bits), count
        if row:
            order = np.argsort(at, kind="stable")
            at, n = at[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
        if len(first):
            at, n = at[first], np.add.reduceat(n, first)
            sketch[row, at] = np.minimum(sketch[row, at] + n, 255)


def _sketches(bits: int) -> Callable:
    """A task's sketch, in compressed pieces."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros((DEPTH, 1 << bits), np.uint8)
        for block in text_blocks(batches, limit=AT_ONCE):
            hashes = [h for _, _, h in Words(block).grams()]
            sketched(sketch, np.concatenate(hashes))
        flat = sketch.reshape(-1, PIECE)
        some = np.flatnonzero(flat.any(axis=1))
        for i in range(0, len(some), 64):
            pieces = [pa.compress(flat[p].tobytes(), codec="zstd", asbytes=True) for p in some[i : i + 64]]
            yield pa.RecordBatch.from_arrays([pa.array(some[i : i + 64], pa.int32()), pa.array(pieces, pa.binary())], names=["piece", "cells"])

    return run


def _merged(least: int) -> Callable:
    """The sums of each piece, and the cells that reach `least` as bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, data in zip(batch.column("piece").to_pylist(), batch.column("cells"), strict=True):
                add = np.frombuffer(pa.decompress(data.as_py(), decompressed_size=PIECE, codec="zstd", asbytes=True), np.uint8).astype(np.uint16)
                sums[piece] = np.minimum(sums[piece] + add, 255) if piece in sums else add
        for piece, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([np.packbits(total >= least).tobytes()], pa.binary())], names=["piece", "bits"])

    return run


def passes(full: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes lie in cells that reached the threshold, in every row; full: the bits of each row."""
    bits = (full.shape[1] * 8).bit_length() - 1
    ok = np.ones(len(h), bool)
    for row in range(len(full)):
        at = cells(h, row, bits)
        ok &= (full[row, at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return ok


def _survivors(full_) -> Callable:
    """Exact counts, by block, of the phrases that the sketch lets through."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = full_.value
        for block in text_blocks(batches, limit=AT_ONCE):
            w = Words(block)
            for n, at, h in w.grams():
                at = at[passes(full, h)]
                key = w.lang[at]
                for i in range(n):
                    key = np.unique(key * len(w.names) + w.code[at + i], return_inverse=True)[1]
                _, first, count = np.unique(key, return_index=True, return_counts=True)
                at = at[first]
                parts = [w.names.take(pa.array(w.code[at + i])).cast(pa.string()) for i in range(n)]
                lang = pa.array(w.langs, pa.string()).take(pa.array(w.lang[at]))
                yield pa.RecordBatch.from_arrays([lang, *parts, *[pa.nulls(len(at), pa.string())] * (3 - n), pa.array(count)], names=["lang", "w1", "w2", "w3", "f"])

    return run


def counts(docs: DataFrame, least: int = LEAST, bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all single words, and (lang, w1, w2, w3, f) of all phrases of 2 (w3 null) and 3 words with
    f >= least; exact."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    words = texts.mapInArrow(_counted, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    words = saved(words, "words")
    if bits is None:
        total = words.agg(F.sum("f")).first()[0] or 0
        bits = min(max(int(total / LOAD).bit_length(), NARROW), WIDE)
    pieces = texts.mapInArrow(_sketches(bits), "piece int, cells binary").repartition(tasks(spark), "piece")
    full = np.zeros((DEPTH, (1 << bits) // 8), np.uint8)
    for r in pieces.mapInArrow(_merged(least), "piece int, bits binary").toLocalIterator():  # DEPTH << WIDE bits at most
        full.reshape(-1, PIECE // 8)[r.piece] = np.frombuffer(r.bits, np.uint8)
    shared = spark.sparkContext.broadcast(full)
    exact = texts.mapInArrow(_survivors(shared), "lang string, w1 string, w2 string, w3 string, f long")
    exact = exact.groupBy("lang", "w1", "w2", "w3").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return words, saved(exact, "phrases")


def collocations(docs: DataFrame, least: int = LEAST, subsumed: int = SUBSUMED, bits: int | None = None) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of 2 to 3 words that occur at least `least` times, without those
    that lie in a longer one which covers `subsumed` per cent of them.

    docs: text and lang; null texts are empty, null languages `und`. A-Z are lower-cased, pieces end at marks and line
    breaks, words at blanks and tabs. A phrase's score is floor(1000000 a a / (l r)) of the cut where it is least.

    Words are counted exactly, with sums by task before the shuffle. Each task adds its phrases to a count-min sketch;
    the sketches are summed by pieces, and a bit for each cell tells whether it reaches `least`. A sum is never below a
    phrase's own count, so the second pass, which counts what lies in such cells of all rows exactly, loses nothing that
    is frequent. The sketch has as many cells as the words need, up to 2**26 a row (16 MB of bits broadcast); a larger
    corpus lets more rare phrases through to the exact counts, and results stay the same.

    All sums are decimals of 38 digits: exact up to about 10**15 occurrences of a phrase. A worker holds AT_ONCE bytes of text,
    or one longer text, as words. Tables without rows or words give an empty result; further columns are ignored.
    """
    words, phrases = counts(fresh(docs, "text", "lang"), least, bits)
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = words.filter(F.col("f") >= least)
    one = lambda c, f: often.select("lang", F.col("phrase").alias(c), F.col("f").alias(f))
    two = phrases.filter("w3 is null")
    pair = lambda a, b, f: two.select("lang", F.col("w1").alias(a), F.col("w2").alias(b), F.col("f").alias(f))

    wide = lambda c: F.col(c).cast("decimal(19,0)").cast("decimal(38,0)")
    of = lambda left, right: F.expr(f"cast((1000000 * a_ * a_) div (cast({left} as decimal(38,0)) * cast({right} as decimal(38,0))) as long)")
    cut = lambda k, left, right: F.struct(of(left, right).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))

    threes = phrases.filter("w3 is not null").withColumnRenamed("f", "a").withColumn("a_", wide("a"))
    inside = threes.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a").groupBy("lang", "p.w1", "p.w2").agg(F.max("a").alias("longer"))
    threes = threes.join(one("w1", "f1"), ["lang", "w1"]).join(one("w3", "f3"), ["lang", "w3"]).join(pair("w1", "w2", "f12"), ["lang", "w1", "w2"]).join(pair("w2", "w3", "f23"), ["lang", "w2", "w3"])
    threes = threes.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.least(cut(1, "f1", "f23"), cut(2, "f12", "f3")).alias("c"))
    twos = two.withColumnRenamed("f", "a").withColumn("a_", wide("a")).join(inside, ["lang", "w1", "w2"], "left")
    twos = twos.filter(F.col("longer").isNull() | (100 * F.col("longer").cast("decimal(38,0)") < subsumed * F.col("a_"))).join(one("w1", "f1"), ["lang", "w1"]).join(one("w2", "f2"), ["lang", "w2"])
    twos = twos.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", cut(1, "f1", "f2").alias("c"))
    return twos.union(threes).join(n, "lang").select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each language, the first TOP collocations by score, occurrences and phrase (in order of bytes)."""
    found = saved(collocations(table(spark, sf_dir, "documents")), "collocations")
    w = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= TOP)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
f1 AS MATERIALIZED (SELECT lang, w1, count(*) AS f FROM (SELECT lang, unnest(w) AS w1 FROM w) GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, x.w1 AS w1, x.w2 AS w2, count(*) AS f FROM (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: {'w1': w[i], 'w2': w[i + 1]})) AS x FROM w) GROUP BY ALL HAVING count(*) >= 10),
f3 AS MATERIALIZED (SELECT lang, x.w1 AS w1, x.w2 AS w2, x.w3 AS w3, count(*) AS f FROM (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: {'w1': w[i], 'w2': w[i + 1], 'w3': w[i + 2]})) AS x FROM w) GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
longer AS (SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
two AS (SELECT b.lang, b.w1 || ' ' || b.w2 AS phrase, b.f AS a, x.f AS l, y.f AS r, (CAST(1000000 AS HUGEINT) * b.f * b.f) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM f2 b JOIN f1 x ON x.lang = b.lang AND x.w1 = b.w1 JOIN f1 y ON y.lang = b.lang AND y.w1 = b.w2 LEFT JOIN longer g ON g.lang = b.lang AND g.w1 = b.w1 AND g.w2 = b.w2
  WHERE g.f IS NULL OR 100 * g.f < 50 * b.f),
cut AS (SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, x.f AS x, yz.f AS yz, xy.f AS xy, z.f AS z,
    (CAST(1000000 AS HUGEINT) * t.f * t.f) // (CAST(x.f AS HUGEINT) * yz.f) AS s1, (CAST(1000000 AS HUGEINT) * t.f * t.f) // (CAST(xy.f AS HUGEINT) * z.f) AS s2
  FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f1 z ON z.lang = t.lang AND z.w1 = t.w3
  JOIN f2 xy ON xy.lang = t.lang AND xy.w1 = t.w1 AND xy.w2 = t.w2 JOIN f2 yz ON yz.lang = t.lang AND yz.w1 = t.w2 AND yz.w2 = t.w3),
every AS (SELECT lang, phrase, a, l, r, score FROM two UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN x ELSE xy END, CASE WHEN s1 <= s2 THEN yz ELSE z END, least(s1, s2) FROM cut)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM every JOIN n USING (lang) QUALIFY rank <= 2000
"""
