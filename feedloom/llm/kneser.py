"""Interpolated Kneser-Ney character models, one column per class: tables of counts by hash, sorted hash arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import listed, mix64, saved, text_blocks, words

ORDER = 4
#: The mark before and after a run of letters.
EDGE = "_"
#: Characters of words whose positions are held at once: each takes some hundred bytes.
AT_ONCE = 1 << 17
_MUL = np.uint64(0x9E3779B97F4A7C15)
_LETTER = np.zeros(0x110000, bool)


def letters() -> np.ndarray:
    if not _LETTER.any():
        _LETTER[:] = [chr(i).isalpha() for i in range(0x110000)]
    return _LETTER


@dataclass
class Spots:
    """Positions to predict in the runs of letters of some words: letters, and the edge after each run."""

    word: np.ndarray  # of each position
    order: np.ndarray  # the longest n-gram that ends there, no longer than ORDER
    chars: np.ndarray  # code points, with the positions' own index in `at`
    at: np.ndarray


def portions(names: list[str]) -> Iterator[slice]:
    """Slices of the words with about AT_ONCE characters each (a longer word may be a slice by itself)."""
    part = np.cumsum(np.fromiter((len(x) + 1 for x in names), np.int64, len(names))) // AT_ONCE
    for first, end in pairwise([0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(names)]):
        if end > first:
            yield slice(first, end)


def spots(names: list[str], order: int = ORDER) -> Spots:
    """Words are lower-cased; what is not a letter ends a run."""
    text = "\n" + "\n".join(names).lower() + "\n"
    raw = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    word = np.cumsum(raw == 10) - 1
    known = letters()[raw]
    chars = np.where(known, raw, ord(EDGE)).astype(np.uint64)
    index = np.arange(len(raw))
    edge = np.maximum.accumulate(np.where(known, 0, index))
    since = index - np.where(known, edge, np.concatenate([[0], edge[:-1]]))
    keep = known.copy()
    keep[1:] |= known[:-1]
    at = np.flatnonzero(keep)
    own = word[at] - ~known[at] * (raw[at] == 10)  # the edge after a word's last run belongs to that word
    return Spots(own, np.minimum(since[at] + 1, order), chars, at)


def hashes(s: Spots, n: int, back: int = 0) -> np.ndarray:
    """Hash of the n characters that end `back` before each position."""
    h = np.full(len(s.at), n, np.uint64)
    for i in range(n - 1, -1, -1):
        h = mix64(h * _MUL + s.chars[np.maximum(s.at - back - i, 0)])
    return h


def grams(names: list[str], times: np.ndarray, name: str, order: int = ORDER) -> Iterator[pa.RecordBatch]:
    """(class, gram, n) of words that occur `times` times: the longest n-gram that ends at each position, once each."""
    found: dict[int, list] = {n: [] for n in range(2, order + 1)}
    for portion in portions(names):
        s = spots(names[portion], order)
        each = times[portion][s.word]
        for n, parts in found.items():
            some = np.flatnonzero((s.order == n) & (each > 0))
            part = Spots(s.word[some], s.order[some], s.chars, s.at[some])
            h, first, inverse = np.unique(hashes(part, n), return_index=True, return_inverse=True)
            parts.append((h, s.chars[part.at[first][:, None] + np.arange(1 - n, 1)].astype("<u4"), np.bincount(inverse, weights=each[some])))
    for n, parts in found.items():
        h, chars, total = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else ([], [], [])
        if not len(h):
            continue
        _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=total).astype(np.int64)
        texts = chars[first].tobytes().decode("utf-32-le")
        texts = [texts[i : i + n] for i in range(0, len(texts), n)]
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(texts)), pa.array(texts), pa.array(total)], names=["class", "gram", "n"])


def _counted(order: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            doc, code, names = words(block.column("text"))
            if not len(doc):
                continue
            classes = pc.cast(block.column("class"), pa.string()).dictionary_encode()
            kind, own = np.asarray(classes.indices)[doc], listed(names)
            for k, name in enumerate(classes.dictionary.to_pylist()):
                times = np.bincount(code[kind == k], minlength=len(own))
                some = np.flatnonzero(times)
                yield from grams([own[i] for i in some], times[some], name, order)
            # the next block comes before these names are bound anew
            del doc, code, names, own

    return run


_GRAMS = "class string, gram string, n long"


def counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(class, gram, n) over all texts of docs (text, class): the longest n-gram that ends at each position."""
    return docs.mapInArrow(_counted(order), _GRAMS).groupBy("class", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Base:
    """What a model has besides its strings: classes, discounts by order and class, characters, sums over all of them."""

    classes: list[str]
    order: int
    vocabulary: int
    discount: np.ndarray
    total: np.ndarray
    types: np.ndarray


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column("s").to_pylist()
        long, h = np.fromiter(map(len, names), np.int64, len(names)), np.zeros(len(names), np.uint64)
        for n in np.unique(long):
            some = np.flatnonzero(long == n)
            h[some] = _hash_all([names[i] for i in some])
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column("of")], names=["h", "of"])


def estimated(found: DataFrame, order: int = ORDER, hashed: bool = True) -> tuple[Base, DataFrame]:
    """The model of counts() as a table with every string in it: (h, of), where `of` holds (k, c, total, types) for each
    class that has it: its count as a gram, and as a context the sum and the number of the grams that continue it. If
    not `hashed`: (s, k, c, total, types), with the strings themselves.

    Raw counts for the longest n-grams and those that begin at an edge; for the others, the number of different
    characters before them. One discount per order and class, n1 / (n1 + 2 n2). Aggregates of the engine; the driver
    gets sums by class and order only.
    """
    spark = found.sparkSession
    found = found.select("class", F.col("gram").alias("s"), F.col("n").alias("c"))
    level, parts = found.filter(F.length("s") == order), []
    for n in range(order, 0, -1):
        parts.append(level := saved(level, "level"))
        if n > 1:
            more = level.select("class", F.expr("substring(s, 2)").alias("s"), F.lit(1).cast("long").alias("c"))
            level = found.filter(F.length("s") == n - 1).union(more).groupBy("class", "s").agg(F.sum("c").alias("c"))
    parts.reverse()
    sums = [part.groupBy("class").agg(F.sum("c").alias("total"), F.count("*").alias("types"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")).collect() for part in parts]
    classes = sorted({r["class"] for rows in sums for r in rows})
    number = {c: k for k, c in enumerate(classes)}
    base = Base(classes, order, max(2, parts[0].select("s").distinct().count() + 1), np.full((order + 1, len(classes)), 0.5), np.zeros(len(classes)), np.zeros(len(classes)))
    for n, rows in enumerate(sums, 1):
        for r in rows:
            k = number[r["class"]]
            base.discount[n, k] = min(0.95, max(0.05, r.n1 / (r.n1 + 2 * r.n2) if r.n1 else 0.5))
            if n == 1:
                base.total[k], base.types[k] = r.total, r.types
    none, every = F.lit(0).cast("long"), None
    for n, part in enumerate(parts, 1):
        rows = part.select("class", "s", "c", none.alias("total"), none.alias("types"))
        if n > 1:
            head = part.groupBy("class", F.expr(f"substring(s, 1, {n - 1})").alias("s")).agg(F.lit(0).cast("long").alias("c"), F.sum("c").alias("total"), F.count("*").alias("types"))
            rows = rows.union(head.select("class", "s", "c", "total", "types"))
        every = rows if every is None else every.union(rows)
    numbers = spark.createDataFrame(pa.table({"class": pa.array(classes, pa.string()), "k": pa.array(range(len(classes)), pa.int32())}))  # of an Arrow table no Python worker is started
    each = every.join(F.broadcast(numbers), "class").groupBy("s", "k").agg(*(F.sum(x).alias(x) for x in ("c", "total", "types")))
    if not hashed:
        return base, saved(each, "model")
    each = each.groupBy("s").agg(F.collect_list(F.struct("k", "c", "total", "types")).alias("of"))
    kind = "array<struct<k:int,c:bigint,total:bigint,types:bigint>>"
    return base, saved(each.mapInArrow(_keyed, f"h long, of {kind}"), "model")


@dataclass
class Held:
    """Strings of a model in order of their hashes - all of them, or those that some texts need."""

    base: Base
    keys: np.ndarray
    c: np.ndarray
    total: np.ndarray
    types: np.ndarray

    @property
    def classes(self) -> list[str]:
        return self.base.classes

    @property
    def order(self) -> int:
        return self.base.order

    @classmethod
    def of(cls, base: Base, h: pa.ChunkedArray, of: pa.ChunkedArray) -> Held:
        h = np.asarray(h.combine_chunks() if isinstance(h, pa.ChunkedArray) else h).astype(np.int64).view(np.uint64)
        of = of.combine_chunks() if isinstance(of, pa.ChunkedArray) else of
        row = np.repeat(np.arange(len(h)), np.asarray(pc.list_value_length(of)).astype(np.int64))
        flat = of.flatten()
        order = np.argsort(h)
        place = np.empty(len(h), np.int64)
        place[order] = np.arange(len(h))
        tables = []
        for name in ("c", "total", "types"):
            x = np.zeros((len(h), len(base.classes)))
            x[place[row], np.asarray(flat.field("k"))] = np.asarray(flat.field(name))
            tables.append(x)
        return cls(base, h[order], *tables)

    def spot_scores(self, s: Spots) -> np.ndarray:
        """Natural log probability of each position in each class."""
        base = self.base
        p = np.full((len(s.at), len(base.classes)), 1.0 / base.vocabulary)
        for n in range(1, base.order + 1):
            rest = np.flatnonzero(s.order >= n)
            if not len(rest):
                break
            part = Spots(s.word[rest], s.order[rest], s.chars, s.at[rest])
            found, where = _find(self.keys, hashes(part, n))
            c = np.zeros((len(rest), len(base.classes)))
            c[found] = self.c[where[found]]
            if n == 1:
                total, types = np.broadcast_to(base.total, c.shape), np.broadcast_to(base.types, c.shape)
            else:
                known, at = _find(self.keys, hashes(part, n - 1, 1))
                total, types = np.zeros(c.shape), np.zeros(c.shape)
                total[known], types[known] = self.total[at[known]], self.types[at[known]]
            d = base.discount[n]
            p[rest] = np.where(total > 0, (np.maximum(c - d, 0) + d * types * p[rest]) / np.maximum(total, 1), p[rest])
        return np.log(p)

    def word_scores(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each word in each class, and its number of positions."""
        s = spots(names, self.order)
        h = np.zeros(len(s.at), np.uint64)
        for n in range(1, self.order + 1):
            rest = np.flatnonzero(s.order == n)
            h[rest] = hashes(Spots(s.word[rest], s.order[rest], s.chars, s.at[rest]), n)
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        p = self.spot_scores(Spots(s.word[first], s.order[first], s.chars, s.at[first]))
        size = np.bincount(s.word, minlength=len(names))
        return np.stack([np.bincount(s.word, weights=p[which, k], minlength=len(names)) for k in range(p.shape[1])], axis=1), size


def needed(names: list[str], order: int = ORDER) -> np.ndarray:
    """Hashes of all strings of a model that the scores of some words look up."""
    keys = np.zeros(0, np.uint64)
    for portion in portions(names):
        s, out = spots(names[portion], order), [keys]
        for n in range(1, order + 1):
            rest = np.flatnonzero(s.order >= n)
            part = Spots(s.word[rest], s.order[rest], s.chars, s.at[rest])
            out.append(np.unique(hashes(part, n)))
            if n > 1:
                out.append(np.unique(hashes(part, n - 1, 1)))
        keys = np.unique(np.concatenate(out))
    return keys


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    where = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return table[where] == wanted, where


def _hash_all(grams: list[str]) -> np.ndarray:
    codes = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(len(grams), -1).astype(np.uint64)
    h = np.full(len(grams), codes.shape[1], np.uint64)
    for i in range(codes.shape[1]):
        h = mix64(h * _MUL + codes[:, i])
    return h
