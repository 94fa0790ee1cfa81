"""Hard negatives against a brute-force search, and the bounds of cells."""

import random

import numpy as np
import pyarrow as pa
import pytest

from feedloom.llm import negatives


def brute(rows, anchors, k=5, take=5, least=80):
    whole = [(i, label, [int(np.floor(256.0 * float(np.float32(x)))) for x in e]) for i, label, e in rows if i is not None and label is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    asked = {}
    for i, label, e in whole:
        if i in anchors:
            asked[i] = min(asked.get(i, (label, e)), (label, e))
    out = []
    for a, (mine, e) in asked.items():
        scored = [(sum(x * y for x, y in zip(e, f)), i, label) for i, label, f in whole if i != a]  # noqa: B905
        order = sorted(scored, key=lambda t: (-t[0], t[1]))
        for ps, p, _ in [t for t in order if t[2] == mine][:k]:
            near = [t for t in order if t[2] != mine and least * ps <= 100 * t[0] <= 100 * ps][:take]
            out += [(a, p, r + 1, i, ps, s) for r, (s, i, _) in enumerate(near)]
    return sorted(out)


def rows_of(rng, n, wide=12, labels=4):
    centre = [[rng.gauss(0, 1) for _ in range(wide)] for _ in range(6)]
    out = []
    for i in range(n):
        c = rng.choice(centre)
        out.append((i, rng.randrange(labels), [x + rng.gauss(0, 0.4) for x in c]))
    return out


def mined(spark, rows, anchors, **more):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(3)
    return sorted(tuple(r) for r in negatives.mine(df, df.filter(df.vec_id.isin(list(anchors))), **more).collect())


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 64)
    monkeypatch.setattr(negatives, "AT_ONCE", 8 * 12 * 5 * 9)  # nine anchors a block
    rng = random.Random(3)
    rows = rows_of(rng, 400)
    rows += [(400 + i, 1, rows[7][2]) for i in range(30)] + [(500 + i, 2, rows[7][2]) for i in range(30)]  # copies of one vector
    rows += [(600, None, rows[0][2]), (601, 1, None), (None, 1, rows[0][2]), (602, 1, [None] * 12), (603, 2, [float("nan")] * 12), (604, 3, [float("inf")] * 12), (605, 1, []), (606, 2, [1.0, 2.0]), (607, 3, [0.0] * 12)]
    rows += [(7, 1, rows[8][2]), (40, 2, rows[41][2]), (3, 3, rows[3][2])]  # repeated ids
    anchors = {i for i in range(0, 620, 20)} | {7, 605, 606, 607}
    got = mined(spark, rows, anchors)
    assert got == brute(rows, anchors) and len(got) > 100
    assert mined(spark, rows, anchors, positives=2, negatives=3, least=50) == brute(rows, anchors, 2, 3, 50)


def test_large_whole_numbers(spark):
    """Scores beyond what doubles hold are exact; negative ones have no window."""
    big = float(2**22)
    rows = [(i, i % 2, [big + 512 * i, 3.0 + i / 256, -big]) for i in range(40)] + [(100, 0, [-big, 0.0, big]), (101, 1, [-big, 1.0, big])]
    assert mined(spark, rows, {0, 3, 100}) == brute(rows, {0, 3, 100})


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.mine(none, none).collect() == []
    rows = rows_of(random.Random(1), 60)
    df = spark.createDataFrame([(*r, i, str(i)) for i, r in enumerate(rows)], "vec_id long, label int, embedding array<float>, slot int, score string")
    assert negatives.mine(df, none).collect() == []
    assert sorted(tuple(r) for r in negatives.mine(df, df.filter("vec_id < 5")).collect()) == brute(rows, set(range(5)))


@pytest.mark.parametrize("seed", range(3))
def test_bounds_hold_every_score(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(300, 8)) * 10.0 ** rng.integers(-2, 2, 8)
    x[0] *= 50
    df = spark.createDataFrame([(x_.tolist(),) for x_ in x], "embedding array<double>")
    cells = negatives.Cells.of(df)
    _, whole = negatives.matrix(pa.array(x.tolist()))
    mid, half = cells.bounds(cells.code(whole))
    q = rng.normal(size=(20, 8))
    score, near, far = q @ whole.T, q @ mid.T, np.abs(q) @ half.T
    assert (score <= near + far + 1e-6).all() and (score >= near - far - 1e-6).all()
    assert np.median(far) < np.abs(score).max()
