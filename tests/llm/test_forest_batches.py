"""A vector's leaves don't depend on what it is computed with; link counts over real trees equal brute force."""

import numpy as np
import pyarrow as pa
import pytest

from feedloom.llm import forest


@pytest.mark.parametrize("wide", [3, 32, 64, 384])
def test_leaves_do_not_depend_on_the_batch(wide):
    rng = np.random.default_rng(wide)
    x = rng.normal(size=(3000, wide))
    x[:50] = x[50:100] * 3  # the same direction
    _, unit = forest.usable(pa.array(x.tolist()))
    depth = 7
    splits = forest.learn(unit, depth, 0)
    at, leaf = forest.leaves_of(unit, splits, depth, 0)
    whole = {(int(a), int(n)) for a, n in zip(at, leaf, strict=True)}
    for size in (1, 7, 500):
        parts = set()
        for i in range(0, len(x), size) if size > 1 else range(200):
            _, some = forest.usable(pa.array(x[i : i + size].tolist()))
            a, n = forest.leaves_of(some, splits, depth, 0)
            parts |= {(int(j) + i, int(m)) for j, m in zip(a, n, strict=True)}
        assert parts == (whole if size > 1 else {p for p in whole if p[0] < 200})
    # a sampled vector can lie on a bound itself
    p = forest.projected(unit, forest.directions(0, 1, wide)[0])
    assert (forest.projected(unit[:1], forest.directions(0, 1, wide)[0]) == p[:1]).all()


def test_zeros_behind_a_vector_change_nothing():
    rng = np.random.default_rng(5)
    x = [rng.normal(size=n).tolist() for n in rng.integers(1, 300, 200)]
    _, together = forest.usable(pa.array(x))
    for i, v in enumerate(x):
        _, alone = forest.usable(pa.array([v]))
        assert (together[i, : len(v)] == alone[0]).all() and not together[i, len(v) :].any()


def test_counts_over_trees_equal_brute_force(spark):
    """One label with trees of depth 5: found links are counted once, whatever the batches; recall at the threshold."""
    rng = np.random.default_rng(9)
    centre = rng.normal(size=(60, 24))
    x = centre[rng.integers(0, 60, 1500)] + rng.normal(size=(1500, 24)) * 0.23
    df = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "vec_id long, label int, embedding array<double>").repartition(7)
    got = {r.vec_id: r for r in forest.near_vectors(df, leaf=60, block=40).collect()}
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    links = (unit @ unit.T >= forest.COSINE) & ~np.eye(len(x), dtype=bool)
    n = links.sum(1)
    assert all(got[i].n_links <= n[i] for i in range(len(x))) and sum(r.n_links for r in got.values()) >= 0.9 * n.sum() and n.sum() > 2000
