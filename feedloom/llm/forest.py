"""[6] Near-duplicate embeddings by a forest of random-projection trees with spill."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import fresh, saved, table, tasks
from feedloom.llm.components import components

COSINE = 0.93
#: Trees; vectors of a leaf aimed at; share of a node's vectors that go to both sides of its split.
TREES, LEAF, SPILL = 4, 256, 0.16
#: Vectors that the splits are learned from at most, by a seeded hash; every vector is indexed.
SAMPLE = 50_000
#: Leaves with more vectors are compared block against block, exactly.
BLOCK = 1500
SEED = 17


def usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Positions and rows (double precision, unit length) of vectors without null, non-finite or only zero components;
    shorter ones are ended by zeros."""
    size = np.asarray(pc.fill_null(pc.list_value_length(column), 0)).astype(np.int64)
    values = np.asarray(pc.fill_null(pc.cast(column.flatten(), pa.float64()), np.nan))
    x = np.zeros((len(column), int(size.max(initial=0))))
    x[np.repeat(np.arange(len(column)), size), np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    top = np.abs(x).max(axis=1, initial=0.0)
    kept = np.flatnonzero((size > 0) & np.isfinite(top) & (top > 0))
    x = x[kept] / top[kept, None]
    # summed from the first component on, so that zeros behind a shorter vector change no bit
    return kept, x / np.sqrt(np.cumsum(x * x, axis=1)[:, -1] if x.shape[1] else np.zeros(len(x)))[:, None]


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A key of each usable vector's exact components, so that equal vectors meet; null for others."""
    for batch in batches:
        column = batch.column("embedding")
        kept, _ = usable(column)
        keys: list = [None] * len(batch)
        for i in kept.tolist():
            keys[i] = xxhash.xxh3_128_digest((np.asarray(column[i].values, np.float64) + 0.0).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), column, pa.array(keys, pa.binary())], names=["vec_id", "label", "embedding", "key"])


def directions(tree: int, depth: int, wide: int) -> np.ndarray:
    """One random direction for each level of a tree. A wider one begins like a narrower one, so that vectors of any
    length meet the same splits in whatever batch they come."""
    return np.stack([np.random.default_rng([SEED, tree, level]).standard_normal(max(wide, 1)) for level in range(depth)]) if depth else np.zeros((0, max(wide, 1)))


#: Steps of a unit, of components and of directions: products stay far below 2**53.
FINE, COARSE = 1 << 24, 1 << 12


def projected(x: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Projections of unit vectors on directions, as whole numbers: their sums have no order, so a vector has the same
    ones alone, in any batch and as one of the sample that the splits are learned from."""
    return (np.rint(x * FINE).astype(np.int64) @ np.rint(d * COARSE).astype(np.int64).T).astype(np.float64)


def learn(x: np.ndarray, depth: int, tree: int) -> dict[int, tuple[float, float]]:
    """Bounds (low, high) of each node's split: vectors below high go left, those from low on go right."""
    d = directions(tree, depth, x.shape[1])
    out: dict[int, tuple[float, float]] = {}
    nodes = {1: np.arange(len(x))}
    for level in range(depth):
        below: dict[int, np.ndarray] = {}
        for node, rows in nodes.items():
            if len(rows) < 8:
                continue
            p = projected(x[rows], d[level])
            low, high = np.quantile(p, [0.5 - SPILL / 2, 0.5 + SPILL / 2])
            out[node] = (float(low), float(high))
            below[2 * node], below[2 * node + 1] = rows[p < high], rows[p >= low]
        nodes = below
    return out


def leaves_of(x: np.ndarray, splits: dict[int, tuple[float, float]], depth: int, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and leaves of all vectors: one for each, or more where a split sends it both ways; in order of row."""
    p = projected(x, directions(tree, depth, x.shape[1]))
    at, node = np.arange(len(x)), np.ones(len(x), np.int64)
    nodes = np.array(sorted(splits), np.int64)
    bounds = np.array([splits[n] for n in nodes.tolist()]).reshape(-1, 2)
    done_at, done = [], []
    for level in range(depth):
        where = np.minimum(np.searchsorted(nodes, node), max(len(nodes) - 1, 0))
        known = nodes[where] == node if len(nodes) else np.zeros(len(node), bool)
        done_at.append(at[~known])
        done.append(node[~known])
        at, node, where = at[known], node[known], where[known]
        if not len(at):
            break
        v = p[at, level]
        left, right = v < bounds[where, 1], v >= bounds[where, 0]
        at, node = np.concatenate([at[left], at[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
    at, node = np.concatenate([*done_at, at]), np.concatenate([*done, node])
    order = np.lexsort((node, at))
    return at[order], node[order]


def _leaves(x: np.ndarray, depth: int, splits: list[dict], upto: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and leaves of vectors in the first trees; a leaf's number holds its tree's."""
    found = [leaves_of(x, s, depth, t) for t, s in enumerate(splits[:upto])]
    return np.concatenate([a for a, _ in found]), np.concatenate([(t << 40) + n for t, (_, n) in enumerate(found)])


def _planted(shared):
    """A row for each leaf of each vector, with the vector as it came."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            labels = np.asarray(batch.column("label"))
            _, x = usable(batch.column("embedding"))
            for label in np.unique(labels).tolist():
                mine = np.flatnonzero(labels == label)
                depth, splits = trees.get(label, (0, [{}]))
                at, leaf = _leaves(x[mine], depth, splits, len(splits))
                rows = pa.array(mine[at])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in ("rep", "label", "copies", "embedding")), pa.array(leaf)], names=["rep", "label", "copies", "embedding", "leaf"])

    return run


def _shared_before(a: np.ndarray, b: np.ndarray, leaf: int) -> np.ndarray:
    """Whether pairs share a leaf before this one: a pair counts in the first leaf that it shares."""
    out = np.zeros(len(a), bool)
    for i in range(a.shape[1]):
        own = a[:, i : i + 1]
        out |= ((own == b) & (own >= 0) & (own < leaf)).any(1)
    return out


def _compare(leaf: int, across: bool, ids, copies, sides, x: np.ndarray, leaves: np.ndarray, cosine: float):
    """Per vector: linked vectors first seen here, and the smallest id that its links in this group reach."""
    m = len(ids)
    links, parent = np.zeros(m, np.int64), np.arange(m)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for start in range(0, m, 512):
        rows = np.arange(start, min(start + 512, m))
        ok = x[rows] @ x.T >= cosine
        ok &= np.arange(m)[None, :] > rows[:, None]
        if across:
            ok &= sides[rows][:, None] != sides[None, :]
        p, q = np.nonzero(ok)
        p = rows[p]
        if not len(p):
            continue
        new = ~_shared_before(leaves[p], leaves[q], leaf)
        np.add.at(links, p[new], copies[q[new]])
        np.add.at(links, q[new], copies[p[new]])
        first = np.unique(p, return_index=True)[1]
        for a, lo, hi in zip(p[first].tolist(), first.tolist(), [*first[1:].tolist(), len(p)], strict=True):
            for b in {root(int(v)) for v in np.unique(q[lo:hi])}:
                r, s = root(a), root(b)
                if r != s:
                    r, s = (r, s) if ids[r] < ids[s] else (s, r)
                    parent[s] = r
    return links, np.array([ids[root(i)] for i in range(m)], np.int64) if m else np.zeros(0, np.int64)


def _grouped(shared, cosine: float):
    """Rows sorted by group (label, leaf, i, j) of at most 2 * BLOCK vectors or a little more: links by vector. The other
    leaves of a vector are found anew from its components, which is cheaper than to carry them."""

    def ended(key: tuple, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        label, leaf, i, j = key
        if len(rows) < 2:
            return
        ids, copies, sides = (np.asarray(rows.column(c)) for c in ("rep", "copies", "side"))
        _, x = usable(rows.column("embedding").combine_chunks())
        depth, splits = shared.value.get(label, (0, [{}]))
        at, node = _leaves(x, depth, splits, (leaf >> 40) + 1)
        order = np.argsort(at, kind="stable")
        at, node = at[order], node[order]
        n = np.bincount(at, minlength=len(x))
        leaves = np.full((len(x), int(n.max())), -1, np.int64)
        leaves[at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)] = node
        links, least = _compare(leaf, i != j, ids, copies, sides, x, leaves, cosine)
        ok = (links > 0) | (least != ids)
        yield pa.RecordBatch.from_arrays([pa.array(ids[ok]), pa.array(least[ok]), pa.array(links[ok])], names=["rep", "least", "links"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("label", "leaf", "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(batch)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                k = tuple(keys[a].tolist())
                if k != key and held:
                    yield from ended(key, pa.Table.from_batches(held))
                    held = []
                key = k
                held.append(batch.slice(a, b - a))
        if held:
            yield from ended(key, pa.Table.from_batches(held))

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    1. Equal vectors of a label are one representative with a number of copies; copies link with each other.
    2. For each label with more than `leaf` representatives, trees of random splits at the median of a bounded sample;
       vectors about a split go both ways (spill). Every representative is indexed in every tree.
    3. Each leaf compares its vectors by cosine in double precision. A pair counts in the first leaf that it shares, so
       link counts are exact over the trees without a list of pairs; each leaf yields a row per vector, with a count and
       the smallest id reached. A leaf above `block` vectors is compared block against block, in groups of bounded size.
    4. Components from (vector, smallest id reached), as tables.

    A pair in no common leaf is not found: with the defaults recall is above 0.9 (see the test and the README). Null ids,
    null labels, and vectors that are null, zero, or hold null or non-finite components link with nothing (component_id
    is the id itself, kept true). Vectors of other lengths count as ended by zeros. Rows that repeat an id are one node,
    and each row's links count rows. An empty table gives an empty result; further columns are ignored.
    """
    spark = vectors.sparkSession
    base = fresh(vectors, "vec_id", "label", "embedding").withColumn("label", F.col("label").cast("long"))
    kind = "array<float>" if base.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    base = base.withColumn("embedding", F.col("embedding").cast(kind))
    keyed = saved(base.mapInArrow(_keyed, f"vec_id long, label long, embedding {kind}, key binary").select("vec_id", "label", "embedding", "key"), "keyed")
    live = keyed.filter("key is not null and label is not null and vec_id is not null")
    reps = live.groupBy("label", "key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.min_by("embedding", "vec_id").alias("embedding"))
    reps = saved(reps, "reps")
    sizes = reps.groupBy("label").agg(F.count("*").alias("n")).filter(F.col("n") > leaf)
    total = sizes.agg(F.sum("n")).first()[0] or 0
    forest: dict[int, tuple[int, list]] = {}
    if total:
        draw = F.pmod(F.xxhash64("rep", F.lit(SEED)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, 0.97 * SAMPLE / total)) + 1
        sample = reps.join(sizes, "label").filter(draw).select("label", "n", "embedding").toArrow().combine_chunks()
        _, x = usable(sample.column("embedding").combine_chunks())
        labels = np.array(sample.column("label").to_pylist())
        for label in np.unique(labels).tolist():
            n = sample.column("n")[int(np.flatnonzero(labels == label)[0])].as_py()
            # a level leaves (1 + SPILL) / 2 of a node's vectors on either side
            depth = min(40, max(0, int(np.ceil(np.log(n / leaf) / np.log(2 / (1 + SPILL))))))
            forest[label] = (depth, [learn(x[labels == label], depth, t) for t in range(trees)])
    shared = spark.sparkContext.broadcast(forest)
    each = reps.select("rep", "label", "copies", "embedding").mapInArrow(_planted(shared), f"rep long, label long, copies long, embedding {kind}, leaf long")
    size = each.groupBy("label", "leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    # only leaves of several blocks are named to the others; most are one
    split = saved(size.filter("blocks > 1"), "split")
    each = each.join(split, ["label", "leaf"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))) if split.limit(1).count() else each.withColumn("blocks", F.lit(1))
    each = each.withColumn("side", F.pmod(F.xxhash64("rep", "leaf"), F.col("blocks")).cast("int"))
    each = each.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    each = each.select("label", "leaf", F.least("side", "o").alias("i"), F.greatest("side", "o").alias("j"), "side", "rep", "copies", "embedding")
    dealt = each.repartition(tasks(spark), "label", "leaf", "i", "j").sortWithinPartitions("label", "leaf", "i", "j")
    found = saved(dealt.mapInArrow(_grouped(shared, cosine), "rep long, least long, links long"), "found")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    same = live.join(reps.select("label", "key", "rep", "copies"), ["label", "key"]).select("vec_id", "label", "key", "rep", "copies")
    edges = found.select(F.col("rep").alias("a"), F.col("least").alias("b")).union(same.select(F.col("vec_id").alias("a"), F.col("rep").alias("b")))
    comp = components(edges)
    out = keyed.join(reps.select("label", "key", "rep", "copies"), ["label", "key"], "left")
    out = out.withColumn("live", F.col("rep").isNotNull() & F.col("vec_id").isNotNull()).join(links, "rep", "left")
    n = F.when(F.col("live"), F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0)).cast("long")
    out = out.select("vec_id", n.alias("n_links"), "live").join(comp, F.col("vec_id") == comp.id, "left")
    component = F.when(F.col("live"), F.coalesce("component_id", "vec_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", "n_links", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector of the table: vec_id, n_links, component_id, kept."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS n FROM v
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.n > 0 AND b.n > 0 AND list_inner_product(a.e, b.e) / (a.n * b.n) >= {COSINE}),
r(id, o) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.o),
c AS (SELECT id, min(o) AS component_id FROM r GROUP BY id), n AS (SELECT a AS id, count(*) AS n_links FROM l GROUP BY a)
SELECT c.id AS vec_id, coalesce(n_links, 0) AS n_links, component_id, c.id = component_id AS kept FROM c LEFT JOIN n USING (id)
"""
