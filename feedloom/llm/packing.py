"""[10] Packing of documents into sequences: first-fit decreasing with a tournament tree of bin capacities."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import fresh, saved, table, tasks, text_blocks
from feedloom.llm.pieces import loaded

LENGTH = 4096
END = 2
#: Pieces of a randomised group on average; groups are packed apart, each by one task in bounded memory.
GROUP = 4096
#: Bytes of text that a worker holds as ids at once; larger blocks take more memory and no less time.
BLOCK = 1 << 20
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Tournament:
    """Capacities of bins under a tree of maxima; first(size) is the leftmost bin with room for size."""

    def __init__(self, bins: int, capacity: int):
        self.width = 1 << max(0, bins - 1).bit_length()
        self.tree = [capacity] * (2 * self.width)

    def first(self, size: int) -> int:
        tree, at = self.tree, 1
        while at < self.width:
            at *= 2
            if tree[at] < size:
                at += 1
        return at - self.width

    def take(self, bin_: int, size: int) -> None:
        tree, at = self.tree, bin_ + self.width
        tree[at] -= size
        at //= 2
        while at:
            best = tree[2 * at] if tree[2 * at] >= tree[2 * at + 1] else tree[2 * at + 1]
            if tree[at] == best:
                break
            tree[at] = best
            at //= 2


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each item; items in decreasing size, equal ones in the order given. Every size is 1 to capacity."""
    tree = Tournament(len(sizes), capacity)
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        out[i] = tree.first(sizes[i])
        tree.take(out[i], sizes[i])
    return out


def _cut(path: str, length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(path)
        for block in text_blocks(batches, limit=BLOCK):
            offsets, ids = pieces.encode(block.column("text"))
            ids = ids.astype("<u4")
            end = np.array([END], "<u4").tobytes()
            rows: list[tuple] = []
            for i, doc in enumerate(block.column("doc_id").to_pylist()):
                data = ids[offsets[i] : offsets[i + 1]].tobytes() + end
                total = len(data) // 4
                for start in range(0, total, length):
                    part = data[4 * start : 4 * (start + length)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), total))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def _packed(length: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("uid", "ascending"), ("start", "ascending")])
        sizes = group.column("length").to_pylist()
        bins = first_fit_decreasing(sizes, length)
        used: dict[int, int] = {}
        offset = []
        for size, b in zip(sizes, bins, strict=True):
            offset.append(used.get(b, 0))
            used[b] = offset[-1] + size
        base = group.column("g")[0].as_py() << 32 if len(group) else 0
        out = group.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        return out.append_column("sequence_id", pa.array([base + b for b in bins], pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, group: int = GROUP, seed: int = 7) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and the end id, cut every `length` ids; the pieces, whole ones and rests, are dealt to
    randomised groups by a seeded hash of their row and start, and each group is packed by first-fit decreasing.
    Texts are read once; only lengths and checksums are shuffled. A long document is many pieces in many groups, and
    repeated rows have row numbers of their own, so no key is hot. A null text is empty: one piece, the end id. A null
    id is kept. Further columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    cut = fresh(docs, "doc_id", "text").mapInArrow(_cut(tokenizer or vocabulary(), length), _PIECES)
    cut = saved(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    groups = max(1, round(cut.count() / group))
    dealt = cut.withColumn("g", F.pmod(F.xxhash64("uid", "start", F.lit(seed)), F.lit(groups)))
    return dealt.repartition(min(groups, 4 * tasks(spark)) if groups > 1 else 1, "g").groupBy("g").applyInArrow(_packed(length), f"{_PIECES}, sequence_id long, offset long")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
