"""[8] Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import dropped, fresh, listed, mix64, saved, table, tasks, text_blocks, words
from feedloom.llm.components import components

SHINGLE = 5
#: Bands of ROWS coordinates: a pair of Jaccard 0.75 shares no band with probability (1 - 0.75**3)**24 = 2e-6.
BANDS, ROWS = 24, 3
K = BANDS * ROWS
#: Members that share one copy of their centre's text in a verification group.
GROUP = 256
#: Sets on either side of a group of the last round.
BLOCK = 1024
#: Bytes of text whose shingles a worker holds at once: each byte of text takes some forty of them.
AT_ONCE = 1 << 20

_ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]


def shingle_sets(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes: their document numbers and the hashes."""
    doc, code, names = words(text)
    if not len(doc):
        return doc, np.zeros(0, np.uint64)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in listed(names)), np.uint64, len(names))[code]
    n = np.bincount(doc, minlength=len(text))
    start = np.concatenate([[0], np.cumsum(n)[:-1]])
    whole = len(doc) - SHINGLE + 1
    if whole > 0:
        h = np.zeros(whole, np.uint64)
        for i in range(SHINGLE):
            h += mix64(hashes[i : i + whole] + _ODD[i]) * _ODD[i]
        at = doc[:whole] == doc[SHINGLE - 1 :]
        of, h = doc[:whole][at], mix64(h[at])
    else:
        of, h = doc[:0], hashes[:0]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        s = np.zeros(len(short), np.uint64)
        for i in range(SHINGLE - 1):
            has = n[short] > i
            s[has] += mix64(hashes[start[short[has]] + i] + _ODD[i]) * _ODD[i]
        of, h = np.concatenate([of, short]), np.concatenate([h, mix64(s + n[short].astype(np.uint64))])
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
    return of[new], h[new]


def _permuted(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A bijection of 32-bit words."""
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(a)
    x = x ^ (x >> np.uint32(15))
    x = x * np.uint32(b)
    return x ^ (x >> np.uint32(16))


def circulant(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """K minima for each set: coordinate k is the least value of the second permutation, circularly shifted by k, over
    the elements after the first permutation, in a universe of 2**32 elements."""
    first = _permuted((h ^ (h >> np.uint64(32))).astype(np.uint32), 0x7FEB352D, 0x846CA68B)
    out = np.empty((len(starts), K), np.uint32)
    for k in range(K):
        out[:, k] = np.minimum.reduceat(_permuted(first + np.uint32(k), 0x85EBCA6B, 0xC2B2AE35), starts)
    return out


def _digests(h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, from sums that do not depend on an order."""
    return np.add.reduceat(mix64(h + _ODD[0]), starts).view(np.int64), np.add.reduceat(mix64(h ^ _ODD[1]), starts).view(np.int64)


def _signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, limit=AT_ONCE):
        of, h = shingle_sets(block.column("text"))
        rows = len(block)
        n = np.bincount(of, minlength=rows).astype(np.int64)
        d1, d2 = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        full = np.flatnonzero(n)
        bands: list = [None] * rows
        if len(full):
            starts = np.concatenate([[0], np.cumsum(n[full])[:-1]])
            d1[full], d2[full] = _digests(h, starts)
            s = circulant(h, starts)
            key = np.zeros((len(full), BANDS), np.uint64)
            for r in range(ROWS):
                key = mix64(key * _ODD[2] + s[:, r::ROWS].astype(np.uint64) + np.uint64(r + 1))
            key = mix64(key + np.arange(BANDS, dtype=np.uint64) * _ODD[3]).view(np.int64)
            for i, d in enumerate(full):
                bands[d] = key[i]
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), pa.array(n), pa.array(d1), pa.array(d2), pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "n", "d1", "d2", "bands"],
        )


def _verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in groups of one centre (role 0, first) and its members; yields the members that link with their centre."""
    centre, key = None, None
    for block in text_blocks(batches, limit=AT_ONCE):
        of, h = shingle_sets(block.column("text"))
        n = np.bincount(of, minlength=len(block))
        at = np.concatenate([[0], np.cumsum(n)])
        full = np.flatnonzero(n)
        d1 = np.zeros(len(block), np.int64)
        if len(full):
            d1[full] = _digests(h, at[full])[0]
        want = np.asarray(block.column("digest"))
        cs, ds, ss, roles, ids = (block.column(x).to_pylist() for x in ("c", "cd", "s", "role", "id"))
        found = []
        for i in range(len(block)):
            if d1[i] != want[i]:  # another text under a repeated id
                continue
            mine = h[at[i] : at[i + 1]]
            if roles[i] == 0:
                centre, key = mine, (cs[i], ds[i], ss[i])
            elif key == (cs[i], ds[i], ss[i]):
                small, large = (mine, centre) if len(mine) < len(centre) else (centre, mine)
                if 100 * len(small) >= 75 * len(large):
                    where = np.searchsorted(large, small)
                    both = int((large[np.minimum(where, len(large) - 1)] == small).sum())
                    if 100 * both >= 75 * (len(small) + len(large) - both):
                        found.append((cs[i], ids[i]))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])


def _exploded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, limit=AT_ONCE):
        of, h = shingle_sets(block.column("text"))
        n = np.bincount(of, minlength=len(block))
        d1 = np.zeros(len(block), np.int64)
        full = np.flatnonzero(n)
        if len(full):
            d1[full] = _digests(h, np.concatenate([[0], np.cumsum(n[full])[:-1]]))[0]
        ok = (d1 == np.asarray(block.column("digest")))[of]
        of, h = of[ok], h[ok]
        yield pa.RecordBatch.from_arrays([block.column("id").take(pa.array(of)), pa.array(d1[of]), pa.array(n[of].astype(np.int64)), pa.array(h.view(np.int64))], names=["id", "d1", "n", "h"])


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the wanted ids. They are sent to the scan only while they are few; otherwise both sides are shuffled."""
    texts = fresh(docs, "doc_id", "text").withColumnRenamed("doc_id", "id")
    return texts.join(F.broadcast(ids), "id", "left_semi") if ids.count() <= 200_000 else texts


def may_link(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of sets (id, d1), those that may link with another one of them, by the prefix filter, which loses no link.

    Sets of sizes p and q with Jaccard of at least 0.75 share a shingle among the p - ceil(0.75 p) + 1 rarest of one and
    the q - ceil(0.75 q) + 1 rarest of the other, in any one order of the shingles. The order is by frequency in these
    sets, so a set whose rarest quarter is its own alone links with none.
    """
    wanted = sets.select("id", F.col("d1").alias("digest"))
    rows = wanted.join(_texts(docs, wanted.select("id").distinct()), "id").select("id", "digest", "text")
    each = saved(rows.mapInArrow(_exploded, "id long, d1 long, n long, h long"), "shingles")
    often = each.groupBy("h").agg(F.count("*").alias("df"))
    rank = F.row_number().over(W.partitionBy("id", "d1").orderBy("df", "h"))
    ranked = each.join(often, "h").withColumn("rank", rank).filter("rank <= n - ceil(0.75 * n) + 1 and df > 1")
    keep = saved(ranked.select("id", "d1", "h"), "prefixes")
    twice = keep.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    out = saved(keep.join(twice, "h", "left_semi").select("id", "d1").distinct(), "linkable")
    dropped(each)
    dropped(keep)
    return out


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of pairs (c, cd, m, md) of ids with the first digests of their sets, those (a, b) whose full sets link.

    Each centre's members form groups of about GROUP, each with one copy of the centre's text, so a centre with any
    number of members is many groups; a group streams through one worker, which holds one centre's set and a block.
    """
    spark = docs.sparkSession
    sized = pairs.groupBy("c", "cd").agg(F.count("*").alias("members"))
    parts = pairs.join(sized, ["c", "cd"]).withColumn("s", F.pmod(F.xxhash64("m"), F.ceil(F.col("members") / GROUP)))
    members = parts.select("c", "cd", "s", F.lit(1).alias("role"), F.col("m").alias("id"), F.col("md").alias("digest"))
    centres = parts.select("c", "cd", "s").distinct().select("c", "cd", "s", F.lit(0).alias("role"), F.col("c").alias("id"), F.col("cd").alias("digest"))
    wanted = saved(members.union(centres), "wanted")
    rows = wanted.join(_texts(docs, wanted.select("id").distinct()), "id").repartition(tasks(spark), "c", "cd", "s").sortWithinPartitions("c", "cd", "s", "role")
    rows = rows.select("c", "cd", "s", "role", "id", "digest", "text")
    return rows.mapInArrow(_verified, "a long, b long")


def _links(ids: list[int], comps: list[int], sides: list[int], of: np.ndarray, h: np.ndarray, across: bool) -> list[tuple[int, int]]:
    """A spanning forest of the links between components in one group, from exact intersection sizes by inverted lists."""
    m = len(ids)
    n = np.bincount(of, minlength=m)
    _, code = np.unique(h, return_inverse=True)
    order = np.argsort(code, kind="stable")
    lists, size = of[order], np.bincount(code)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    at = np.concatenate([[0], np.cumsum(n)])
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    side, found = np.array(sides), []
    for p in range(m):
        mine = code[at[p] : at[p + 1]]
        mine = mine[size[mine] > 1]
        if not len(mine):
            continue
        long = size[mine]
        where = np.repeat(first[mine] - np.concatenate([[0], np.cumsum(long)[:-1]]), long) + np.arange(long.sum())
        both = np.bincount(lists[where], minlength=m)
        ok = 100 * both >= 75 * (n + n[p] - both)
        ok[: p + 1] = False
        if across:
            ok &= side != side[p]
        for q in np.flatnonzero(ok):
            x, y = root(comps[p]), root(comps[q])
            if x != y:
                parent[max(x, y)] = min(x, y)
                found.append((ids[p], ids[q]))
    return found


def _grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group (g, i, j), at most 2 * BLOCK of them each: yields the links that _links() finds."""
    key, ids, comps, sides, ofs, hs = None, [], [], [], [], []

    def ended():
        found = _links(ids, comps, sides, np.concatenate(ofs), np.concatenate(hs), key[1] != key[2]) if len(ids) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

    for block in text_blocks(batches, limit=AT_ONCE):
        of, h = shingle_sets(block.column("text"))
        n = np.bincount(of, minlength=len(block))
        at = np.concatenate([[0], np.cumsum(n)])
        full = np.flatnonzero(n)
        d1 = np.zeros(len(block), np.int64)
        if len(full):
            d1[full] = _digests(h, at[full])[0]
        want = np.asarray(block.column("digest"))
        gs, iz, js, doc, comp, side = (block.column(x).to_pylist() for x in ("g", "i", "j", "id", "comp", "side"))
        for r in range(len(block)):
            if (gs[r], iz[r], js[r]) != key:
                if ids:
                    yield ended()
                key, ids, comps, sides, ofs, hs = (gs[r], iz[r], js[r]), [], [], [], [], []
            if d1[r] == want[r]:
                ofs.append(np.full(n[r], len(ids)))
                hs.append(h[at[r] : at[r + 1]].copy())
                ids.append(doc[r])
                comps.append(comp[r])
                sides.append(side[r])
    if ids:
        yield ended()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    1. One pass over whole texts: the set's size, a 128-bit digest, the circulant signature, the band keys.
    2. Equal sets collapse to the smallest id (a partial minimum by digest, so groups of copies of any size are cheap).
    3. Two rounds of stars: in every bucket of a band each set is paired with one centre (least id, then least hash),
       if not yet in its component; distinct pairs are verified on full sets and the components are closed.
    4. Of the sets in buckets that still hold several components, the prefix filter removes those that link with no
       other. Sets joined by such buckets are compared exactly by inverted lists, block against block in groups of
       bounded size, and each group yields a spanning forest of its links across components, never its pairs.
    Pairs inside a component need no verification, so no group of copies yields all its pairs.

    Null or empty texts, and texts of white space, have no shingles and link with nothing. Rows with a null id link
    with nothing and are returned with component_id null and kept true. Rows that repeat an id are one node. Further
    columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = fresh(docs, "doc_id", "text")
    signed = saved(texts.mapInArrow(_signed, "doc_id long, n long, d1 long, d2 long, bands array<long>"), "signed")
    known = signed.filter("doc_id is not null and n > 0")
    reps = known.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands"), F.count("*").alias("copies"))
    reps = saved(reps.select("n", "d1", "d2", "rep", "copies", "bands"), "reps")
    copies = known.join(reps.filter("copies > 1").select("n", "d1", "d2", "rep"), ["n", "d1", "d2"]).filter("doc_id <> rep")
    links = saved(copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct(), "copies")

    keyed = reps.select(F.col("rep").alias("id"), "d1", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    buckets = saved(keyed.join(shared, "key").select("key", "id", "d1"), "buckets")
    comp = components(links)
    tried = None
    for order in (lambda: F.struct("id", "d1"), lambda: F.struct(F.xxhash64("id", "d1"), "id", "d1")):
        open_ = buckets.join(comp, "id", "left").withColumn("comp", F.coalesce("component_id", "id")).drop("component_id")
        many = open_.groupBy("key").agg(F.min_by(F.struct("id", "d1", "comp"), order()).alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key", "c")
        pairs = open_.join(many, "key").filter("comp <> c.comp")
        first, second = F.struct(F.col("c.id").alias("id"), F.col("c.d1").alias("d1")), F.struct("id", "d1")
        pairs = pairs.select(F.least(first, second).alias("x"), F.greatest(first, second).alias("y"))
        pairs = pairs.select(F.col("x.id").alias("c"), F.col("x.d1").alias("cd"), F.col("y.id").alias("m"), F.col("y.d1").alias("md")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["c", "cd", "m", "md"], "left_anti")
        pairs = saved(pairs, "pairs")
        links = saved(verified(docs, pairs).union(links), "links")
        tried = pairs if tried is None else tried.union(pairs)
        comp = components(links)

    open_ = buckets.join(comp, "id", "left").withColumn("comp", F.coalesce("component_id", "id")).drop("component_id")
    many = open_.groupBy("key").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    rest = open_.join(many.select("key"), "key", "left_semi")
    rest = saved(rest.join(may_link(docs, rest.select("id", "d1").distinct()), ["id", "d1"], "left_semi"), "rest")
    many = rest.groupBy("key").agg(F.min("id").alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    rest = saved(rest.join(many.select("key", "c"), "key").select("id", "d1", "comp", "c").distinct(), "rest")
    if rest.limit(1).count():
        near = components(rest.select(F.col("id").alias("a"), F.col("c").alias("b")))
        each = rest.select("id", "d1", "comp").distinct().join(near, "id", "left").withColumn("g", F.coalesce("component_id", "id"))
        size = each.groupBy("g").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        each = each.join(size, "g").withColumn("side", F.pmod(F.xxhash64("id", "d1"), F.col("blocks")).cast("int"))
        each = each.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        each = each.select("g", F.least("side", "o").alias("i"), F.greatest("side", "o").alias("j"), "side", "id", F.col("d1").alias("digest"), "comp")
        each = saved(each, "groups")
        dealt = each.join(_texts(docs, each.select("id").distinct()), "id").repartition(tasks(spark), "g", "i", "j").sortWithinPartitions("g", "i", "j")
        links = saved(dealt.mapInArrow(_grouped, "a long, b long").union(links), "links")
        comp = components(links)
    dropped(buckets)
    out = signed.select("doc_id", F.col("n").alias("n_shingles")).join(comp, signed.doc_id == comp.id, "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document of the table: doc_id, n_shingles, component_id, kept."""
    return near_duplicates(table(spark, sf_dir, "documents"))


#: A link shares a shingle, so all pairs that share one are counted; feasible for small tables only.
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s), e AS MATERIALIZED (SELECT doc_id, hash(x) AS h FROM (SELECT doc_id, unnest(s) AS x FROM s)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM e a JOIN e b USING (h) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 75 * (x.n + y.n - m)),
r(id, o) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.o),
c AS (SELECT id, min(o) AS component_id FROM r GROUP BY id)
SELECT id AS doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, id = component_id AS kept FROM c JOIN n ON n.doc_id = id
"""
