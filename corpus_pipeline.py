"""A corpus from raw documents to packed sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import language, minhash, mixing, packing, quality
from feedloom.llm.common import fresh, saved, table

#: Columns that every stage but the last returns.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


#: Number of a row of a stage's input, or of its text.
ROW = "row"


#: Rejected numbers that are sent to the scan; beyond these, rows and numbers are shuffled.
FEW = 200_000


def _of_text(docs: DataFrame) -> DataFrame:
    """The rows with a 64-bit hash of the text. The language depends on the text alone, so what is rejected is a set of
    texts: no row needs a number, whatever the ids, and nothing but the rejected hashes is written."""
    return fresh(docs, *COLUMNS).withColumn(ROW, F.xxhash64("text"))


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows whose number is not among the rejected ones. While these are few the texts are not shuffled."""
    gone = saved(rejected.select(ROW).distinct(), "rejected")
    return docs.join(F.broadcast(gone) if gone.count() <= FEW else gone, ROW, "left_anti").select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; null ids have no label and are judged by their text, as is each of
    several rows of one id."""
    return quality.accepted(fresh(docs, *COLUMNS), table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known and not rejected."""
    docs = _of_text(docs)
    return _without(docs, language.identify(docs, row=ROW).filter("rejected"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, whatever the ids: that of the smallest id, null ids last."""
    docs = saved(fresh(docs, *COLUMNS).withColumn(ROW, F.monotonically_increasing_id()), "rows")  # plans that read it see the same numbers
    near = minhash.near_duplicates(docs.select(F.col(ROW).alias("doc_id"), "text")).select(F.col("doc_id").alias(ROW), "component_id")
    near = saved(near.join(docs.select(ROW, "doc_id"), ROW), "near")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW))[ROW]
    kept = near.groupBy("component_id").agg(first.alias("kept"), F.count("*").alias("n")).filter("n > 1").select("component_id", "kept")
    return _without(docs, near.join(kept, "component_id").filter(F.col(ROW) != F.col("kept")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's token prefixes, at most one epoch: each document at most once, the last of a leaf cut."""
    return mixing.mixed(fresh(docs, *COLUMNS), epochs=1)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids."""
    return packing.pack(fresh(docs, *COLUMNS))


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can't express the classifiers, the language models and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, f"stage{k}")
    return docs
