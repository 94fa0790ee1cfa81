"""[3] Document quality by positive-unlabelled learning: a non-negative risk with an estimated class prior."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import crc_mod, fresh, saved, table, text_blocks, words

FOLDS, HELD_OUT = 3, 1
#: Bytes of text that a worker describes at once; blocks twice as large cost as much time and more memory.
BLOCK = 1 << 20
#: Newton steps at most, half steps at most, the ridge, and the step that ends the fit.
STEPS, HALVES, DECAY, STILL = 25, 12, 1e-2, 1e-5
#: Cells of the score distributions that the class prior is read from, and the least share of positives above a cut.
CELLS, TOP = 200, 0.2

SHARES = ("repeated", "upper", "letterless", "trailing", "digits", "short", "top_word", "letters", "capitals", "marks", "figures", "odd")
FEATURES = (*SHARES, *(f"root_{x}" for x in SHARES), "variety", "word_length", "log_words", "lines", "no_text")


def describe(text: pa.Array) -> np.ndarray:
    """Features of whole texts, a row each: shares of words and of bytes, their roots, variety, lengths."""
    rows = len(text)
    text = pc.fill_null(text, "")
    out = np.zeros((rows, len(FEATURES)))
    put = {name: i for i, name in enumerate(FEATURES)}
    doc, code, names = words(text, lower=False)
    n = np.bincount(doc, minlength=rows)
    per = np.maximum(n, 1)
    share = lambda flag: np.bincount(doc, weights=flag, minlength=rows) / per
    if len(doc):
        of_name = lambda flags: np.asarray(pc.fill_null(flags, False)).astype(float)[code]
        size = np.asarray(pc.utf8_length(names)).astype(float)
        same = np.zeros(len(doc))
        same[1:] = (code[1:] == code[:-1]) & (doc[1:] == doc[:-1])
        out[:, put["repeated"]] = share(same)
        out[:, put["upper"]] = share(of_name(pc.and_(pc.utf8_is_upper(names), pc.greater(pc.utf8_length(names), 1))))
        out[:, put["letterless"]] = share(of_name(pc.invert(pc.match_substring_regex(names, r"\pL"))))
        out[:, put["trailing"]] = share(of_name(pc.match_substring_regex(names, r"[^\pL\pN]{2,}$")))
        out[:, put["odd"]] = share(of_name(pc.match_substring_regex(names, r"[^\pL\pN.,;:!?'\"()-]")))
        out[:, put["digits"]] = share(of_name(pc.match_substring_regex(names, r"[0-9]")))
        out[:, put["short"]] = share((size <= 3)[code].astype(float))
        out[:, put["word_length"]] = np.bincount(doc, weights=size[code], minlength=rows) / per / 10
        pair = np.sort(doc * len(names) + code)
        new = np.concatenate([[True], pair[1:] != pair[:-1]])
        at = np.flatnonzero(new)
        of, times = pair[at] // len(names), np.diff(np.concatenate([at, [len(pair)]]))
        top = np.zeros(rows)
        np.maximum.at(top, of, times)
        out[:, put["top_word"]] = top / per
        out[:, put["variety"]] = np.log1p(np.bincount(of, minlength=rows)) / np.maximum(np.log1p(n), 1e-9) * (n > 0)
    offsets = np.frombuffer(text.buffers()[1], np.int32 if pa.types.is_string(text.type) else np.int64)[text.offset : text.offset + rows + 1].astype(np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if rows else np.zeros(0, np.uint8)
    at = offsets - offsets[0]
    length = np.maximum(np.diff(at), 1)
    kind = np.zeros(256, np.uint8)  # 1 lower, 2 upper, 3 digit, 4 space, 5 mark, 6 newline, 0 beyond ASCII
    for i in range(128):
        c = chr(i)
        kind[i] = 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 6 if c == "\n" else 4 if c.isspace() else 5
    kinds = kind[data]
    for name, of_kind in (("letters", (1, 2, 0)), ("capitals", (2,)), ("marks", (5,)), ("figures", (3,)), ("lines", (6,))):
        flag = np.zeros(len(kinds) + 1, np.int64)
        flag[1:] = np.cumsum(np.isin(kinds, of_kind)) if len(of_kind) > 1 else np.cumsum(kinds == of_kind[0])
        out[:, put[name]] = (flag[at[1:]] - flag[at[:-1]]) / length
    out[:, put["lines"]] *= 10
    out[:, put["log_words"]] = np.log1p(n) / 10
    out[:, put["no_text"]] = n == 0
    for name in SHARES:
        out[:, put[f"root_{name}"]] = np.sqrt(out[:, put[name]])
    return out


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, limit=BLOCK):
        x = describe(block.column("text")).astype(np.float32)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
        names = [x for x in block.schema.names if x != "text"]
        yield pa.RecordBatch.from_arrays([*(block.column(x) for x in names), flat], names=[*names, "x"])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def sums(x: np.ndarray, p: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What a Newton step needs of rows (the last input is 1): of all rows and of positives, their number, the sums of
    log(1 + exp(z)), of log(1 + exp(-z)), of its gradient, and of the second derivatives."""
    out = []
    for some in (x, x[p]):
        z = some @ w
        s = sigmoid(z)
        out += [[len(some), np.logaddexp(0, z).sum(), np.logaddexp(0, -z).sum()], some.T @ s, some.sum(0), ((some * (s * (1 - s))[:, None]).T @ some).ravel()]
    return np.concatenate(out)


def fit(summed: Callable[[np.ndarray], np.ndarray], size: int, prior: float | None) -> np.ndarray:
    """Weights (bias last) of a linear score that minimise the non-negative unbiased risk with logistic losses, by damped
    Newton steps; summed(w) gives sums() over all rows.

    risk = prior * mean loss(+, positives) + max(0, mean loss(-, all) - prior * mean loss(-, positives)). The unbiased
    risk is convex; a step that would make the part in the maximum negative is halved, so the fit ends on the side where
    it isn't. Without a prior: the plain classifier of positives against all rows.
    """

    def risk(w: np.ndarray):
        parts = np.split(summed(w), np.cumsum([3, size, size, size * size, 3, size, size])[:7])
        (n, minus, _), g, _, h, (n_p, minus_p, plus_p), g_p, x_p, h_p = parts
        h, h_p = h.reshape(size, size) / n, h_p.reshape(size, size) / n_p
        up, down = (g_p - x_p) / n_p, g / n
        ridge = DECAY * 0.5 * (w @ w)
        if prior is None:
            return plus_p / n_p + minus / n + ridge, 0.0, up + down + DECAY * w, h + h_p
        negative = minus / n - prior * minus_p / n_p
        return prior * plus_p / n_p + negative + ridge, negative, prior * (up - g_p / n_p) + down + DECAY * w, h

    w = np.zeros(size)
    value, _, g, h = risk(w)
    for _ in range(STEPS):
        step = np.linalg.solve(h + (DECAY + 1e-8) * np.eye(size), g)
        for half in range(HALVES):
            next_ = w - step / 2**half
            new, negative, g_, h_ = risk(next_)
            if new <= value and negative >= 0:
                break
        else:
            return w
        moved = np.abs(next_ - w).max()
        w, value, g, h = next_, new, g_, h_
        if moved < STILL:
            break
    return w


def _summed(train: DataFrame, mean: np.ndarray, scale: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """sums() over a table (x, p) of described rows; the engine adds what its tasks have."""

    def of(w: np.ndarray) -> np.ndarray:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                if len(batch):
                    total = total + sums(_scaled(batch.column("x"), mean, scale), np.asarray(batch.column("p").cast(pa.int8())).astype(bool), w)
            if np.ndim(total):
                yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["i", "v"])

        rows = train.select("x", "p").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
        return rows.sort_values("i")["v"].to_numpy()

    return of


def _scaled(x: pa.Array, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    flat = np.asarray(x.flatten(), float).reshape(len(x), len(mean))
    return np.hstack([(flat - mean) * scale, np.ones((len(x), 1))])


def _linear(w: np.ndarray):
    """The score of a feature array, as an expression of the engine."""
    terms = F.aggregate(F.zip_with("x", F.array(*(F.lit(float(a)) for a in w[:-1])), lambda a, b: a.cast("double") * b), F.lit(float(w[-1])), lambda a, b: a + b)
    return 1 / (1 + F.exp(-F.least(F.greatest(terms, F.lit(-40.0)), F.lit(40.0))))


def prior_of(cells: list) -> float:
    """The class prior from counts by score cell of all positives and all training texts, highest cell first: above a
    cut that only positives reach, the two shares differ by the prior alone, so it is the least ratio of the shares."""
    p, u = np.array([r.p for r in cells], float), np.array([r.u for r in cells], float)
    if not p.sum() or not u.sum():
        return 0.5
    cp, cu = np.cumsum(p) / p.sum(), np.cumsum(u) / u.sum()
    slack = np.sqrt(1 / p.sum()) + np.sqrt(1 / u.sum())
    ok = cp >= TOP
    return float(np.clip(((cu + slack) / cp)[ok].min(), 0.05, 0.98))


def _table(docs: DataFrame, *own: str) -> DataFrame:
    """Numbers of every whole text, written once."""
    described = fresh(docs, *own, "doc_id", "text").mapInArrow(_described, "".join(f"`{c}` long, " for c in own) + "doc_id long, x array<float>")
    return saved(described.withColumn("held_out", crc_mod("doc_id", FOLDS) == HELD_OUT), "described")


def _fitted(described: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights of the score (bias last), as score() says."""
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("id")).distinct()
    train = described.filter("not held_out").join(good, described.doc_id == good.id, "left").select("x", "doc_id", F.col("id").isNotNull().alias("p"))
    train = saved(train, "training")
    each = [F.element_at("x", i + 1).cast("double") for i in range(len(FEATURES))]
    stats = train.agg(F.count("*"), F.count_if("p"), *(F.avg(c) for c in each), *(F.stddev_pop(c) for c in each)).first()
    n, n_p = stats[0], stats[1]
    final = np.zeros(len(FEATURES) + 1)
    if n and n_p:
        mean, dev = np.array(stats[2 : 2 + len(FEATURES)]), np.array(stats[2 + len(FEATURES) :])
        scale = 1 / np.maximum(dev, 1e-3)
        raw = lambda w: np.concatenate([w[:-1] * scale, [w[-1] - (w[:-1] * scale * mean).sum()]])
        summed = _summed(train, mean, scale)
        first = saved(train.select("p", _linear(raw(fit(summed, len(final), None))).alias("s")), "first")
        # cells by rank among the positives, so that they hold like shares of them
        cuts = sorted(set(first.filter("p").agg(F.percentile_approx("s", [float(q) for q in np.linspace(0, 1, CELLS + 1)[1:-1]], 10_000)).first()[0]))
        cell = F.size(F.filter(F.array(*(F.lit(float(c)) for c in cuts)), lambda c: c <= F.col("s")))
        cells = first.select(cell.alias("cell"), "p").groupBy("cell").agg(F.count_if("p").alias("p"), F.count("*").alias("u")).orderBy(F.desc("cell")).collect()
        final = raw(fit(summed, len(final), prior_of(cells)))
    return final


def score(docs: DataFrame, labels: DataFrame, row: str | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted; before them the column `row` (long), if one is named.

    One pass describes every whole text by numbers (letters, marks, repetition, variety ...; never label, lang, source
    or id); that small table is written once. Trusted positives are texts of the training folds (crc32 of the id modulo
    3 is not 1) with quality 1; unlabelled ones are all texts of the training folds, whatever their label. Means,
    deviations, the class prior and every step of the fits come from all of them: a step is an aggregate of the engine,
    of about 2,000 sums. The score is computed by expressions of the engine.

    Null and empty texts are described as empty and scored like others. Labels other than 1 are not learned from. An id
    that is labelled twice counts once as positive if any label is 1. Null ids are scored, as held out if the empty text
    is. With no positive or no training text every score is 0.5. An empty table gives an empty result.
    """
    own = [row] if row else []
    described = _table(docs, *own)
    out = described.select(*own, "doc_id", "held_out", _linear(_fitted(described, labels)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, whose text score() predicts 1. A last pass describes the texts once more
    and lets through what it accepts, so no row is joined with its score and no text is shuffled."""
    w = _fitted(_table(docs), labels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, limit=BLOCK):
            x = describe(block.column("text")).astype(np.float32).astype(float)
            yield block.filter(pa.array(sigmoid(x @ w[:-1] + w[-1]) >= 0.5))

    return docs.mapInArrow(run, docs.schema)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document of the table: doc_id, held_out, score, predicted."""
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
