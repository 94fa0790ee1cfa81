"""[12] Repeated passages: maximal repeat groups from the interval tree of an enhanced suffix array, with all occurrences."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import fresh, mix64, release, saved, table, tasks, text_blocks

#: Bytes of the shortest repeat, and of an anchor: each window of LENGTH bytes holds one, the least of all its GRAM bytes.
LENGTH, GRAM = 200, 64
#: Anchors that a window chooses from, thus the most windows of a fragment.
WINDOWS = LENGTH - GRAM + 1
#: Bytes of text whose windows a worker holds at once; longer texts are taken in pieces that overlap.
AT_ONCE = 1 << 19
#: Bytes of fragments under one suffix array, and fragments of one anchor beyond which it gets longer keys.
BLOCK, MANY = 2 << 20, 2048

_SEED = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))
_BYTE = mix64(np.arange(256, dtype=np.uint64) + _SEED)


def grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes at each place: differences of one running sum of powers, shifted to a common place."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(data) - 1, _BASE)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * powers)])
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _INVERSE)]))
    return mix64((sums[GRAM:] - sums[:n]) * back)


def leftmost_least(h: np.ndarray) -> np.ndarray:
    """Of each WINDOWS values in a row, the place of the least (by its upper 44 bits), the first of equals."""
    n = len(h) - WINDOWS + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = np.uint64((1 << 20) - 1)
    x = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    x = np.concatenate([x, np.full(-len(x) % WINDOWS, np.uint64(2**64 - 1))]).reshape(-1, WINDOWS)
    before = np.minimum.accumulate(x, axis=1).ravel()
    after = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(after[:n], before[WINDOWS - 1 : WINDOWS - 1 + n]) & low).astype(np.int64)


def _pieces(text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of some texts, where each text (or piece of a long one) begins in them, its row, and its place in its text.
    Pieces overlap by LENGTH - 1 bytes, so each window lies in one."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    off = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    if not len(text):
        return
    if off[-1] - off[0] <= AT_ONCE:
        yield data[off[0] : off[-1]], off - off[0], np.arange(len(text)), np.zeros(len(text), np.int64)
        return
    for row in range(len(text)):
        for at in range(off[row], max(off[row] + 1, off[row + 1] - LENGTH + 1), AT_ONCE - LENGTH):
            part = data[at : min(at + AT_ONCE - 1, off[row + 1])]
            yield part, np.array([0, len(part)]), np.array([row]), np.array([at - off[row]])


def fragments(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that share an anchor: text number, first window, number of windows, place of the anchor, its hash.

    Windows of equal bytes have equal anchors at equal places in them, so only windows of one anchor can be equal."""
    h = grams(data)
    least = leftmost_least(h)
    n = len(least)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[:n]
    inside = np.arange(n) + LENGTH <= off[doc + 1] if n else np.zeros(0, bool)
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new & inside)
    run = np.cumsum(new) - 1
    size = np.bincount(run[inside], minlength=run[-1] + 1 if n else 0)
    return doc[at], at, size[run[at]], least[at], h[least[at]]


def _anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, limit=AT_ONCE):
        found = [fragments(data, off)[4] for data, off, _, _ in _pieces(block.column("text"))]
        h, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["anchor", "n"])


def _digest(data) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(data)
    return (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63)


_HITS = "anchor long, k1 long, k2 long, start int, size int, m int, c1 long, c2 long"


def _hits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fragment: anchor, text, place in the text, windows, place of the anchor in the fragment, digest of its bytes."""
    for block in text_blocks(batches, limit=AT_ONCE):
        k1, k2 = np.asarray(block.column("k1")), np.asarray(block.column("k2"))
        for data, off, rows, place in _pieces(block.column("text")):
            doc, at, size, m, h = fragments(data, off)
            view = memoryview(np.ascontiguousarray(data))
            digest = np.array([_digest(view[a:b]) for a, b in zip(at.tolist(), (at + size + LENGTH - 1).tolist(), strict=True)], np.int64).reshape(-1, 2)
            row = rows[doc]
            columns = [h.view(np.int64), k1[row], k2[row], at - off[doc] + place[doc], size, m - at]
            kinds = [pa.int64()] * 3 + [pa.int32()] * 3
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)] + [pa.array(digest[:, 0]), pa.array(digest[:, 1])]
            yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "k1", "k2", "start", "size", "m", "c1", "c2"])


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted fragments of each text."""
    for block in text_blocks(batches, limit=AT_ONCE):
        wanted = block.column("wanted")
        of = np.repeat(np.arange(len(block)), np.asarray(pc.list_value_length(wanted)))
        w = wanted.flatten()
        texts = [t.encode() for t in block.column("text").to_pylist()]
        start, size = np.asarray(w.field("start")), np.asarray(w.field("size"))
        parts = [texts[d][a : a + n + LENGTH - 1] for d, a, n in zip(of, start, size, strict=True)]
        yield pa.RecordBatch.from_arrays([*(w.field(c) for c in ("anchor", "c1", "c2", "n", "d", "m")), pa.array(parts, pa.binary())], names=["key", "c1", "c2", "n", "d", "m", "bytes"])


class SuffixArray:
    """The suffixes of several byte strings in order, with the lengths of common prefixes of neighbours (lcp[i]: of the
    suffixes i - 1 and i). A suffix ends with its string; one that is a prefix of another comes first."""

    def __init__(self, strings: list[bytes]):
        size = np.array([len(s) for s in strings], np.int64)
        end = np.cumsum(size)
        data = np.frombuffer(b"".join(strings), np.uint8)
        n = len(data)
        self.of = np.repeat(np.arange(len(strings)), size)
        self.left = end[self.of] - np.arange(n)  # bytes up to the end of the string
        longest, ranks = int(size.max(initial=0)), []
        padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
        word = np.zeros(n, np.uint64)
        for i in range(8):
            word = (word << np.uint64(8)) | np.where(self.left > i, padded[i : i + n], 0)
        order = np.lexsort((np.minimum(self.left, 8), word))
        rank, step = self._ranks(order, word, np.minimum(self.left, 8)), 8
        ranks.append((step, rank))
        while step < longest:
            after = np.where(self.left > step, np.concatenate([rank[step:], np.zeros(min(step, n), np.int64)])[:n] + 1, 0)
            key = rank * np.int64(n + 1) + after
            order = np.argsort(key, kind="stable")
            rank, step = self._ranks(order, key), step * 2
            ranks.append((step, rank))
        self.order = order
        self.data, self.start = data, end - size
        self.lcp = self._common(ranks)

    @staticmethod
    def _ranks(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
        new = np.zeros(len(order), np.int64)
        for k in keys:
            s = k[order]
            new[1:] |= s[1:] != s[:-1]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _common(self, ranks: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """Common prefixes of neighbours, by equal ranks from the longest step down, then by bytes."""
        n = len(self.order)
        lcp = np.zeros(n, np.int64)
        if n < 2:
            return lcp
        a, b = self.order[:-1], self.order[1:]
        most = np.minimum(self.left[a], self.left[b])
        at = np.zeros(n - 1, np.int64)
        for step, rank in reversed(ranks):
            can = at + step <= most
            same = np.zeros(n - 1, bool)
            same[can] = rank[a[can] + at[can]] == rank[b[can] + at[can]]
            at += np.where(same, step, 0)
        for _ in range(7):
            can = np.flatnonzero(at < most)
            same = self.data[a[can] + at[can]] == self.data[b[can] + at[can]]
            at[can[same]] += 1
            if not same.any():
                break
        lcp[1:] = at
        return lcp


def intervals(sa: SuffixArray, least: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, int]]]:
    """The maximal repeats of at least `least` bytes: for each suffix in order the deepest group that holds it (-1: none),
    and its length; and the groups (length, first and last place in order, parent or -1).

    One scan of the common prefixes with a stack of open intervals. Where they fall, the intervals that end are closed;
    an interval is a maximal repeat if its occurrences are preceded by different bytes, or one begins its string. One
    that is not hands its occurrences to the next interval around it: the bytes before them are part of the repeat, so a
    longer group one byte earlier holds them all.
    """
    order, lcp = sa.order, sa.lcp
    n = len(order)
    begins = order == sa.start[sa.of[order]]
    before = np.where(begins, 256, sa.data[np.maximum(order - 1, 0)].astype(np.int64))
    deepest, length, groups = np.full(n, -1), np.zeros(n, np.int64), []
    # runs of neighbours with a common prefix of at least `least`; those preceded by one byte alone hold no group
    joined = np.concatenate([lcp[1:] >= least, [False]]) if n else np.zeros(0, bool)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
    for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        mine = before[lo : hi + 1]
        if mine[0] != 256 and (mine == mine[0]).all():
            continue
        common, at = lcp[lo : hi + 1].tolist(), mine.tolist()
        stack: list[list] = []  # length, first place, the byte before all (-1: several), groups inside, places of its own
        for i in range(len(common) + 1):
            now = common[i] if 0 < i < len(common) else 0
            if not i:
                continue
            first, byte, places, kids = i - 1, -1 if at[i - 1] == 256 else at[i - 1], [i - 1], []
            while stack and stack[-1][0] > now:
                depth, first, seen, inside, own = stack.pop()
                byte = byte if seen == byte else -1
                inside.extend(kids)
                own.extend(places)
                if byte == -1:
                    for place in own:
                        deepest[lo + place] = len(groups)
                    for k in inside:
                        groups[k][3] = len(groups)
                    own, inside = [], [len(groups)]
                    groups.append([depth, lo + first, lo + i - 1, -1])
                places, kids = own, inside
            if stack and stack[-1][0] == now:
                top = stack[-1]
                top[2] = byte if top[2] == byte else -1
                top[3].extend(kids)
                top[4].extend(places)
            elif now:
                stack.append([now, first, byte, kids, places])
    some = deepest >= 0
    if some.any():
        length[some] = np.array([g[0] for g in groups])[deepest[some]]
    return deepest, length, groups


def _repeats(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments sorted by key to the runs of them that repeat: digest, place before the anchor, bytes. Whole keys form
    blocks of about BLOCK bytes, each under one suffix array."""
    rows, held, key, seen = [], 0, None, set()

    def ended():
        sa = SuffixArray([r[4] for r in rows])
        _, length, _ = intervals(sa, LENGTH)
        found = np.flatnonzero(length >= LENGTH)
        place = sa.order[found]
        of = sa.of[place]
        # of the runs that begin in a fragment, each reaches further than those before or is left out
        at, size = place - sa.start[of], length[found]
        order = np.lexsort((-size, at, of))
        of, at, size = of[order], at[order], size[order]
        reach = at + size + of * np.int64(1 << 20)
        far = np.maximum.accumulate(reach) if len(reach) else reach
        keep = np.ones(len(reach), bool)
        keep[1:] = reach[1:] > far[:-1]
        of, at, size = of[keep], at[keep], size[keep]
        ids = [rows[i] for i in of.tolist()]
        columns = [[r[0] for r in ids], [r[1] for r in ids], [r[2] for r in ids], at - np.array([r[3] for r in ids], np.int64), size]
        kinds = [pa.int64()] * 3 + [pa.int32()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "c1", "c2", "at", "size"])

    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in ("key", "c1", "c2", "m", "bytes")), strict=True):
            if r[0] != key:
                if held >= BLOCK:
                    yield ended()
                    rows, held = [], 0
                key, seen = r[0], set()
            if (r[1], r[2]) not in seen:
                seen.add((r[1], r[2]))
                rows.append(r)
                held += len(r[4])
    if rows:
        yield ended()
    release()


_HALF = "key long, c1 long, c2 long, n long, key2 long, d1 long, d2 long, m int, bytes binary, lo int, hi int"


def _halved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments of a key with many: each half of its windows under a longer key, the bytes that all windows of the half
    share. lo, hi: how far before the anchor the windows of the key begin, the last of them and the first."""
    for batch in batches:
        out = []
        for key, c1, c2, n, m, data, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("key", "c1", "c2", "n", "m", "bytes", "lo", "hi")), strict=True):
            middle = (lo + hi) // 2
            for a, b in ((lo, middle), (middle + 1, hi)):
                first, last = min(b, m), max(a, m - (len(data) - LENGTH))  # the fragment's own windows
                if a > b or first < last:
                    continue
                longer = _digest(data[m - a : m - b + LENGTH] + b"%d %d %d" % (key, a, b))[0]
                part = data[m - first : m - last + LENGTH]
                out.append((key, c1, c2, n, longer, *_digest(part), first, part, a, b))
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.binary(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=[c.split()[0] for c in _HALF.split(", ")])


def _of_many(open_: DataFrame, spark: SparkSession) -> DataFrame:
    """(key, c1, c2, at, size): the repeated runs of different fragments (key, c1, c2, n, d, m, bytes, lo, hi), whole keys
    at a time. n: occurrences, d: fragments of the key. Keys with more than MANY are halved, and what is found of the
    halves is given back to the fragments."""
    open_ = saved(open_, "open")
    dealt = open_.filter(F.col("d") <= MANY).select("key", "c1", "c2", "m", "bytes").repartition(tasks(spark), "key").sortWithinPartitions("key", "c1", "c2")
    found = dealt.mapInArrow(_repeats, "key long, c1 long, c2 long, at int, size int")
    many = open_.filter(F.col("d") > MANY)
    if not many.limit(1).count():
        return found
    many = many.dropDuplicates(["key", "c1", "c2"])  # of rows of one id and text
    halves = many.select("key", "c1", "c2", "n", "m", "bytes", "lo", "hi").mapInArrow(_halved, _HALF)
    halves = saved(halves, "halves")
    kinds = halves.groupBy("key2", "d1", "d2").agg(F.sum("n").alias("n"))
    d = kinds.groupBy("key2").agg(F.count("*").alias("d"))
    live = saved(kinds.join(d, "key2").filter("d > 1 or n > 1"), "live")
    one = halves.select("key2", "d1", "d2", "m", "bytes", "lo", "hi").dropDuplicates(["key2", "d1", "d2"]).join(live, ["key2", "d1", "d2"])
    one = saved(one.select(F.col("key2").alias("key"), F.col("d1").alias("c1"), F.col("d2").alias("c2"), "n", "d", "m", "bytes", "lo", "hi"), "one")
    whole = one.filter("n > 1").select("key", "c1", "c2", (-F.col("m")).alias("at"), F.length("bytes").alias("size"))
    below = _of_many(one.filter("d > 1"), spark).union(whole).select(F.col("key").alias("key2"), F.col("c1").alias("d1"), F.col("c2").alias("d2"), "at", "size")
    return found.union(halves.select("key", "c1", "c2", "key2", "d1", "d2").join(below, ["key2", "d1", "d2"]).select("key", "c1", "c2", "at", "size"))


def keyed(docs: DataFrame) -> DataFrame:
    """Texts with two 64-bit keys of id and text; rows that are the same in both share them."""
    docs = fresh(docs, "doc_id", "text").withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.withColumn("k1", F.xxhash64("doc_id", "text")).withColumn("k2", F.xxhash64(F.lit(1), "text", "doc_id"))


def spans(docs: DataFrame) -> DataFrame:
    """(k1, k2, spans: array of start, size) of keyed() texts: the occurrences of repeats, in no order and overlapping.

    Windows of LENGTH bytes are grouped by their anchor, the least of their GRAM bytes by hash; a run of windows with one
    anchor is a fragment, of LENGTH + WINDOWS - 1 bytes at most.
    1. Anchors are counted (one long for each, sums by task); only those that occur twice go on.
    2. Fragments of such anchors are hit; equal ones collapse to one with a count by their digests of 128 bits, so copies
       of any number are one row. An anchor with one fragment that occurs once holds no repeat.
    3. Fragments that share an anchor with different ones are fetched once each and stand, whole anchors at a time, under
       enhanced suffix arrays of about BLOCK bytes, whose interval trees give the maximal repeats with all occurrences.
       An anchor with more than MANY fragments is halved under longer keys until few differ (`_halved`).
    4. What repeats is joined back to all hits.
    """
    spark = docs.sparkSession
    texts = docs.filter(F.octet_length("text") >= LENGTH)
    often = texts.select("text").mapInArrow(_anchors, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    often = saved(often.filter("n > 1").select("anchor"), "anchors")
    hits = saved(texts.select("k1", "k2", "text").mapInArrow(_hits, _HITS).join(often, "anchor"), "hits")
    rep = (F.first(c).alias(c) for c in ("k1", "k2", "start", "size", "m"))  # of one row: any occurrence will do
    kinds = saved(hits.groupBy("anchor", "c1", "c2").agg(F.count("*").alias("n"), *rep), "kinds")
    differ = kinds.groupBy("anchor").agg(F.count("*").alias("d")).filter("d > 1")
    wanted = kinds.join(differ, "anchor").groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "c1", "c2", "n", "d", "start", "size", "m")).alias("wanted"))
    cut = texts.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).select("text", "wanted").mapInArrow(_cut, "key long, c1 long, c2 long, n long, d long, m int, bytes binary")
    found = _of_many(cut.withColumn("lo", F.lit(0)).withColumn("hi", F.lit(WINDOWS - 1)), spark)
    copies = kinds.filter("n > 1").select(F.col("anchor").alias("key"), "c1", "c2", (-F.col("m")).alias("at"), (F.col("size") + F.lit(LENGTH - 1)).alias("size"))
    runs = found.union(copies).groupBy("key", "c1", "c2").agg(F.collect_list(F.struct("at", F.col("size").alias("bytes"))).alias("runs"))
    runs = saved(runs.withColumnRenamed("key", "anchor"), "runs")
    each = hits.join(runs, ["anchor", "c1", "c2"]).select("k1", "k2", F.transform("runs", lambda r: F.struct((F.col("start") + F.col("m") + r["at"]).cast("int").alias("start"), r["bytes"].alias("size"))).alias("s"))
    return each.groupBy("k1", "k2").agg(F.flatten(F.collect_list("s")).alias("spans"))


def _outcomes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, limit=AT_ONCE):
        rows = []
        for text, found in zip(block.column("text").to_pylist(), block.column("spans"), strict=True):
            data = text.encode()
            cover = np.zeros(len(data) + 1, np.int64)
            if found.is_valid and len(found.values):
                start, size = (np.asarray(found.values.field(c)) for c in ("start", "size"))
                np.add.at(cover, start, 1)
                np.add.at(cover, start + size, -1)
            gone = np.cumsum(cover[:-1]) > 0
            edges = int(gone[0] if len(gone) else 0) + int((gone[1:] & ~gone[:-1]).sum())
            rows.append((len(data), int(gone.sum()), edges, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()))
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays([block.column("doc_id"), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256. Each byte of a passage of at least LENGTH bytes
    that also begins anywhere else, in this document or another, is removed.

    Null texts are empty; texts below LENGTH bytes keep all. Rows that repeat an id are documents each, and null ids are
    as good as others. Further columns are ignored; an empty table gives an empty result. A text of any length is taken
    in pieces of AT_ONCE bytes.
    """
    docs = keyed(docs)
    out = docs.join(saved(spans(docs), "spans"), ["k1", "k2"], "left").select("doc_id", "text", "spans")
    return out.mapInArrow(_outcomes, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document of the table without repeated passages."""
    return deduplicated(table(spark, sf_dir, "documents"))
