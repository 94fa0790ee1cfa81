"""What the corpus operators share: reading tables, lineage cuts in the shared folder, Arrow text blocks, hashes."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker holds as words at once, whatever the size of the Arrow batch.
BLOCK_BYTES = 4 << 20
#: Rows of an Arrow batch: of 10,000 texts, the engine and a worker each hold tens of MB at once.
BATCH_ROWS = 2_000


#: Shuffle files are removed when the query that wrote them ends, and not only when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a folder of our own only where that is
    unset and all run on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = spark.sparkContext.getCheckpointDir()
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            base = f"file://{tempfile.mkdtemp(prefix='feedloom-')}"
            spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/feedloom-{uuid.uuid4().hex}-{name}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: cuts the lineage, survives lost executors, and leaves no shuffle
    files. Its Arrow batches hold BATCH_ROWS rows at most, and so do those of later plans of the session."""
    spark = df.sparkSession
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) not in range(1, BATCH_ROWS + 1):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    path = scratch(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._feedloom_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Removes a table of saved() that no later plan reads."""
    spark, path = df.sparkSession, getattr(df, "_feedloom_path", None)
    if path:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(column: str, modulus: int):
    """crc32 of the id as text, modulo: the fold of a document; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus)).cast("int")


def release() -> None:
    """Gives memory that a worker no longer uses back to the system; a worker outlives its task and serves later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_blocks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `limit` bytes of text each (a single longer text is a slice by itself). What
    earlier ones took is released after each batch."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if start < len(sizes):
            yield batch.slice(start)
        release()


def words(text: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII white space, A-Z lower-cased: document and dictionary code of each word, and the dictionary."""
    text = pc.fill_null(text, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
    flat = lists.flatten()
    doc = np.repeat(np.arange(len(lists), dtype=np.int64), np.diff(np.asarray(lists.offsets)))
    full = np.asarray(pc.binary_length(flat)) > 0
    if not full.all():
        flat, doc = flat.filter(pa.array(full)), doc[full]
    coded = flat.dictionary_encode()
    return doc, np.asarray(coded.indices).astype(np.int64), coded.dictionary


def listed(names: pa.Array) -> list[str]:
    """The strings of an array without nulls; several times as fast as its own to_pylist()."""
    return names.to_numpy(zero_copy_only=False).tolist()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def crc_fold(value, modulus: int) -> int:
    return zlib.crc32(str(value).encode()) % modulus


_SAFE = re.compile(r"[A-Za-z_][A-Za-z0-9_]*$")


def fresh(df: DataFrame, *wanted: str) -> DataFrame:
    """Only the wanted columns, so that further columns with clashing names do no harm."""
    return df.select(*(F.col(f"`{c}`") for c in wanted))
