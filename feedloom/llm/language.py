"""[7] Language identification by interpolated Kneser-Ney character models with calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import kneser
from feedloom.llm.common import crc_mod, dropped, fresh, listed, release, saved, table, text_blocks, words

FOLDS, HELD_OUT = 3, 1
#: A text is rejected if its cross-entropy lies this many standard deviations above the mean of training texts of its
#: language and about its length.
DEVIATIONS = 8.0
#: Training texts that a length class needs for a threshold of its own; a language without such a class has one for all.
ENOUGH = 30
UNKNOWN = "und"


#: Bytes of text that look up the model together, and words scored at once.
TOGETHER, AT_ONCE = 16 << 20, 8_000
#: Different words that end such a block early, and bytes of a slice of it: what a worker holds of either.
MOST, SLICE = 400_000, 1 << 20


def _packed(x: np.ndarray) -> bytes:
    """32-bit numbers, byte by byte of their places, compressed."""
    return pa.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True) if len(x) else b""


def _unpacked(x: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(x, 4 * n, "zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def _bags(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each slice of texts: its documents, the codes of each document's words in its block, in order and as
    differences, and how often each occurs. Words and hashes of the model's strings that they need are those that
    earlier slices (`part`) of the same block don't have."""
    task = TaskContext.get().partitionId() << 32
    block, part, size, known, seen = 0, 0, 0, {}, np.zeros(0, np.uint64)
    for slice_ in text_blocks(batches, limit=SLICE):
        if size > TOGETHER or len(known) > MOST:
            block, part, size, known, seen = block + 1, 0, 0, {}, seen[:0]
        size += int(pc.sum(pc.binary_length(slice_.column("text"))).as_py() or 0)
        doc, code, names = words(slice_.column("text"))
        first = len(known)
        of = np.array([known.setdefault(w, len(known)) for w in listed(names)], np.int64)
        new = list(islice(known, first, None))
        pair, times = np.unique(doc * max(len(known), 1) + of[code], return_counts=True)
        at, code = pair // max(len(known), 1), pair % max(len(known), 1)
        step = code.copy()
        step[1:] -= np.where(at[1:] == at[:-1], code[:-1], 0)
        keys = np.setdiff1d(kneser.needed(new), seen, assume_unique=True)
        seen = np.union1d(seen, keys)
        lists = [pa.array([slice_.column(x).to_pylist()], pa.list_(kind)) for x, kind in (("row", pa.int64()), ("doc_id", pa.int64()), ("lang", pa.string()), ("held_out", pa.bool_()))]
        packed = [pa.array([_packed(x)], pa.binary()) for x in (np.bincount(at, minlength=len(slice_)), step, times)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([task + block]), pa.array([part]), *lists, pa.array([new], pa.list_(pa.string())), *packed, pa.array([keys.view(np.int64)], pa.list_(pa.int64()))],
            names=["block", "part", "row", "doc_id", "lang", "held_out", "names", "per", "step", "times", "keys"],
        )
        part += 1


_BAGS = "block long, part long, row array<long>, doc_id array<long>, lang array<string>, held_out array<boolean>, names array<string>, per binary, step binary, times binary, keys array<long>"
_SCORED = "row long, doc_id long, lang string, held_out boolean, lang_pred string, score double, entropy double, letters long"


def _scored(base: kneser.Base):
    def run(bags: pa.Table, strings: pa.Table) -> pa.Table:
        model = kneser.Held.of(base, strings.column("h"), strings.column("of"))
        bags = bags.sort_by("part")
        p, size = np.zeros((0, len(model.classes))), np.zeros(0)
        if model.classes:
            names = bags.column("names").combine_chunks().flatten()
            scores = [model.word_scores(listed(names.slice(i, AT_ONCE))) for i in range(0, len(names), AT_ONCE)]
            if scores:
                p, size = np.concatenate([x for x, _ in scores]), np.concatenate([x for _, x in scores])
        out = []
        for i in range(len(bags)):
            numbers, ids, langs, held = (bags.column(x)[i].as_py() for x in ("row", "doc_id", "lang", "held_out"))
            rows = len(ids)
            entropy, n = np.zeros((rows, len(model.classes))), np.zeros(rows)
            per = _unpacked(bags.column("per")[i].as_py(), rows)
            if per.sum() and model.classes:
                doc, start = np.repeat(np.arange(rows), per), np.repeat(np.cumsum(per) - per, per)
                step, times = (_unpacked(bags.column(x)[i].as_py(), len(doc)) for x in ("step", "times"))
                code = np.cumsum(step)
                code -= code[start] - step[start]
                n = np.bincount(doc, weights=size[code] * times, minlength=rows)
                for k in range(len(model.classes)):
                    entropy[:, k] = -np.bincount(doc, weights=p[code, k] * times, minlength=rows) / np.maximum(n, 1)
            if model.classes:
                best = entropy.argmin(1)
                least = entropy[np.arange(rows), best]
                # the posterior under equal priors, with the evidence of at most 50 characters
                odds = np.exp(-(entropy - least[:, None]) * np.minimum(n, 50)[:, None]).sum(1)
                score = np.where(n > 0, 1 / odds, 0.0)
                pred = [model.classes[b] if c else UNKNOWN for b, c in zip(best, n, strict=True)]
            else:
                least, score, pred = np.zeros(rows), np.zeros(rows), [UNKNOWN] * rows
            columns = [pa.array(numbers, pa.int64()), pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(held, pa.bool_()), pa.array(pred, pa.string()), pa.array(score), pa.array(least), pa.array(n.astype(np.int64))]
            out.append(pa.Table.from_arrays(columns, names=["row", "doc_id", "lang", "held_out", "lang_pred", "score", "entropy", "letters"]))
        release()
        return pa.concat_tables(out)

    return run


def identify(docs: DataFrame, deviations: float = DEVIATIONS, row: str | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, entropy, rejected; before them the column `row` (long),
    if one is named.

    One pass counts character n-grams over all whole texts of the training folds (crc32 of the id modulo 3 is not 1,
    lang not null), pre-aggregated in each block; aggregates make the models of them, a table with every n-gram. A second
    pass reduces texts to bags of words, and each block of TOGETHER bytes is joined with the n-grams that its words look
    up, so a worker holds these and never a whole model. The language of least cross-entropy per character is taken; the
    statistics of training texts, by language and length, give the thresholds of rejection. The score is that
    language's posterior.

    A text that is null or has no letter is `und` with score 0, and rejected. Null ids count as the empty text for the
    fold. Ties go to the first language in order of name. Without any training text everything is `und`. An empty table
    gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    number = (F.col(f"`{row}`") if row else F.lit(None)).cast("long").alias("row")
    docs = docs.select(number, "doc_id", "text", "lang").withColumn("held_out", crc_mod("doc_id", FOLDS) == HELD_OUT)
    train = docs.filter("not held_out and lang is not null and text is not null").select("text", F.col("lang").alias("class"))
    base, strings = kneser.estimated(saved(kneser.counts(train), "grams"))
    bags = saved(docs.select("row", "doc_id", "lang", "held_out", "text").mapInArrow(_bags, _BAGS), "bags")
    wanted = bags.select(F.col("block").alias("b"), F.explode("keys").alias("h")).join(strings, "h").select("b", "h", "of")
    scored = saved(bags.drop("keys").groupBy("block").cogroup(wanted.groupBy("b")).applyInArrow(_scored(base), _SCORED), "languages")
    dropped(bags)
    size = F.when(F.col("letters") > 0, F.floor(F.log2(F.greatest("letters", F.lit(1))))).cast("int")
    known = scored.filter("not held_out and lang = lang_pred and letters > 0").groupBy("lang", size.alias("size")).agg(F.count("*").alias("n"), F.avg("entropy").alias("mean"), F.stddev_pop("entropy").alias("dev")).collect()
    by: dict[str, dict[int, float]] = {}
    for lang in {r.lang for r in known}:
        own = [r for r in known if r.lang == lang]
        by[lang] = {r.size: r.mean + deviations * max(r.dev, 0.02) for r in own if r.n >= ENOUGH}
        if not by[lang]:
            # no length class has enough texts: all of them together
            n = sum(r.n for r in own)
            mean = sum(r.n * r.mean for r in own) / n
            dev = (sum(r.n * (r.dev**2 + (r.mean - mean) ** 2) for r in own) / n) ** 0.5
            by[lang][0] = mean + deviations * max(dev, 0.02)
    # Between length classes with too few texts, the next shorter one that has enough (its spread is wider), else any.
    rows = [(lang, s, limit) for lang, sizes in by.items() for s in range(41) for limit in [sizes[max((x for x in sizes if x <= s), default=min(sizes))]]]
    kinds = {"lang_pred": pa.string(), "size": pa.int32(), "most": pa.float64()}
    limits = spark.createDataFrame(pa.table({x: pa.array([r[i] for r in rows], kind) for i, (x, kind) in enumerate(kinds.items())}))  # no Python worker
    out = scored.withColumn("size", size).join(F.broadcast(limits), ["lang_pred", "size"], "left")
    rejected = (F.col("lang_pred") == UNKNOWN) | F.coalesce(F.col("entropy") > F.col("most"), F.lit(False))
    return out.select(*([F.col("row").alias(row)] if row else []), "doc_id", "held_out", "lang_pred", "score", "entropy", rejected.alias("rejected"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
