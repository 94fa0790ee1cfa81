import random

import numpy as np
import pyarrow as pa

from feedloom.llm import forest, minhash, mixing, topk, warc, wordpiece


def test_loser_tree_merges():
    rng = random.Random(2)
    for k in range(0, 9):
        runs = [sorted(rng.randint(0, 20) for _ in range(rng.randint(0, 30))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_archives_round_trip(spark):
    rows = [(3, "https://b.example.org/x?q=1", "<p>ä\r\n\r\nWARC/1.1\r\n</p>", "e"), (1, "http://www.a.example.org:80", "same", None), (2, None, "same", None), (9, "http://a.example.org/z", "same", None), (4, "u", None, None), (5, "u", "", None), (None, "u", "n", None), (6, "u", "x" * 100_000 + "\r\n", None), (3, "u", "again", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    out = warc.histories(pages).collect()
    assert len(out) == len(rows)
    kinds = {(r.page_id, r.payload_bytes): (r.record_type, r.refers_to) for r in out}
    assert kinds[(1, 4)] == ("response", None) and kinds[(2, 4)] == ("revisit", 1) and kinds[(9, 4)] == ("revisit", 1)
    assert kinds[(4, 0)] == ("response", None) and kinds[(5, 0)] == ("revisit", 4)
    out.sort(key=lambda r: r.position)
    assert [r.position for r in out] == list(range(len(out)))
    keys = [(r.url_key, r.captured) for r in out]
    assert keys == sorted(keys) and ("org,example,b)/x?q=1" in {k for k, _ in keys})
    path, boundary = warc.write(pages)
    back = {(r.page_id, r.payload) for r in warc.read(spark, path, boundary).filter("record_type = 'response'").collect()}
    assert back == {(3, rows[0][2]), (1, "same"), (4, ""), (None, "n"), (6, rows[7][2]), (3, "again")}
    assert warc.histories(pages.limit(0)).count() == 0


def test_index_is_the_global_order(spark):
    """Null ids and times, many small batches of one archive, a url with most captures: as one sort of all rows."""
    rng = random.Random(5)
    rows = [(rng.choice(["a)/", "hot)/", "hot)/", "z)/x"]), rng.choice([None, 3, 1, 2, 7]), None if rng.random() < 0.5 else rng.randint(0, 99), "one") for _ in range(3000)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    out = warc.index(spark.createDataFrame(rows, "url_key string, captured int, page_id long, archive string").repartition(3)).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    key = lambda r: tuple((x is not None, x or 0) for x in r[:3])
    assert [r.position for r in sorted(out, key=lambda r: r.position)] == list(range(3000))
    assert [key(r) for r in sorted(out, key=lambda r: r.position)] == sorted(map(key, rows))


def greedy(word: str, begin: set, go_on: set) -> int:
    at, n = 0, 0
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in (begin if at == 0 else go_on)), 0)
        if not size:
            return 1
        at, n = at + size, n + 1
    return n


def test_linear_match_equals_greedy_match():
    rng = random.Random(4)
    for _ in range(60):
        make = lambda: {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 15))}
        begin, go_on = make(), make()
        m = wordpiece.LinMax(begin, go_on)
        for _ in range(200):
            w = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(0, 12)))
            assert m.count(w) == greedy(w, begin, go_on), (w, begin, go_on)


def test_token_counts(spark):
    docs = spark.createDataFrame([(1, "Hello hello wörld", 1), (2, None, 1), (3, "", 1), (None, "x " * 1000, 1)], "doc_id long, text string, n_tokens int")
    begin, go_on = map(set, wordpiece.pieces_of(wordpiece.vocabulary()))
    out = {r.doc_id: (r.n_words, r.n_tokens) for r in wordpiece.token_counts(docs).collect()}
    assert out[1] == (3, 2 * greedy("hello", begin, go_on) + greedy("wörld", begin, go_on)) and out[2] == out[3] == (0, 0) and out[None][0] == 1000
    assert wordpiece.token_counts(docs.limit(0)).count() == 0


def water(children: dict, budget: float) -> dict:
    """Budget by weight under capacities, by rounds of redistribution."""
    got, open_ = {k: 0.0 for k in children}, set(children)
    budget = min(budget, sum(c for c, _ in children.values()))
    while open_ and budget > 1e-9:
        weight = sum(children[k][1] for k in open_)
        give = {k: min(children[k][0] - got[k], budget * children[k][1] / weight) for k in open_}
        for k, g in give.items():
            got[k] += g
        budget -= sum(give.values())
        open_ = {k for k in open_ if got[k] < children[k][0] - 1e-9}
    return got


def test_budgets_and_prefixes(spark):
    rng = random.Random(8)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 30))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "s4", "hot", "hot", "hot", None])) for i in range(600)]
    rows += [(5, "again and again", "en", "hot"), (None, "no id", "en", "s1"), (601, None, "en", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for share, epochs in ((0.6, 2), (1.7, 2), (0.1, 1), (3.0, 1)):
        out = mixing.mixture(docs, share=share, epochs=epochs).collect()
        supply: dict = {}
        for r in docs.select("*", mixing.domain(docs.source).alias("domain"), mixing.tokens(docs.text).alias("n")).collect():
            if r.n:
                supply[(r.domain, r.lang or "(null)", r.source or "(null)")] = supply.get((r.domain, r.lang or "(null)", r.source or "(null)"), 0) + r.n
        budget = {(): float(int(share * sum(supply.values())))}
        for depth in (1, 2, 3):
            for parent in [p for p in budget if len(p) == depth - 1]:
                kids = {p[:depth] for p in supply if p[: depth - 1] == parent}
                got = water({k: (epochs * sum(v for p, v in supply.items() if p[:depth] == k), mixing.WEIGHTS.get(k, 1.0)) for k in kids}, budget[parent])
                budget |= got
        taken: dict = {}
        for r in out:
            taken[(r.domain, r.lang, r.source)] = taken.get((r.domain, r.lang, r.source), 0) + r.taken
            assert 0 < r.taken <= epochs * r.n_tokens
        for leaf in supply:
            assert abs(taken.get(leaf, 0) - budget[leaf]) <= 1.001, (leaf, share)
    mixed = mixing.mixed(docs, share=0.5, epochs=2)
    assert mixed.columns == docs.columns
    clash = docs.withColumn("row", docs.doc_id * 0).withColumn("taken", docs.doc_id).withColumn("n_tokens", docs.doc_id)
    assert mixing.mixed(clash, share=0.5, epochs=2).select(docs.columns).exceptAll(mixed).count() == 0 and mixing.mixed(clash, share=0.5).columns == clash.columns
    same = spark.createDataFrame([(None, "a b c", "en", "s")] * 100, docs.schema)
    assert sum(r.taken for r in mixing.mixture(same, share=0.5, epochs=1).collect()) == 150
    assert abs(mixed.select(mixing.tokens(mixed.text).alias("n")).agg({"n": "sum"}).first()[0] - sum(r.taken for r in mixing.mixture(docs, share=0.5).collect())) == 0
    assert mixing.mixture(docs.limit(0)).count() == 0


def test_near_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(40):
        centre = rng.normal(size=16)
        rows += [(len(rows) + i, (centre + rng.normal(size=16) * 0.12 * (i % 4)).astype(float).tolist(), c % 2, 0) for i in range(30)]
    rows += [(2000 + i, rows[5][1], 0, 0) for i in range(50)] + [(3000, None, 0, 0), (3001, [0.0] * 16, 0, 0), (3002, [float("nan")] * 16, 0, 0), (3003, [None] * 16, 0, 0), (3004, rows[5][1], None, 0), (None, rows[5][1], 0, 0)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links int")
    out = {r.vec_id: r for r in forest.near_vectors(v, leaf=100, block=60).collect()}
    live = [r for r in rows if r[0] is not None and r[0] < 3000]
    x = np.array([r[1] for r in live])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = (x @ x.T >= 0.93) & (np.array([r[2] for r in live])[:, None] == np.array([r[2] for r in live])[None])
    want = same.sum(1) - 1
    got = np.array([out[r[0]].n_links for r in live])
    assert (got <= want).all() and got.sum() >= 0.95 * want.sum()
    assert all(out[i].n_links == 0 and out[i].kept and out[i].component_id == i for i in range(3000, 3005))
    assert out[2049].component_id == out[5].component_id and not out[2049].kept
    assert forest.near_vectors(v.limit(0)).count() == 0


def test_deep_trees_find_most_links_and_ignore_widths():
    """Trees of nine levels on near pairs at the threshold: recall; and leaves that don't depend on the batch's width."""
    rng = np.random.default_rng(9)
    n, depth, trees = 30_000, 9, forest.TREES
    x = rng.normal(size=(n, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = rng.normal(size=x.shape)
    other -= (other * x).sum(1, keepdims=True) * x
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    near = 0.94 * x + np.sqrt(1 - 0.94**2) * other
    splits = [forest.learn(x[:8000], depth, t) for t in range(trees)]
    a, b = (forest._leaves(y[:4000], depth, splits, trees) for y in (x, near))
    pairs = set(zip(a[0].tolist(), a[1].tolist())) & set(zip(b[0].tolist(), b[1].tolist()))
    assert len({i for i, _ in pairs}) >= 0.98 * 4000
    wider = np.hstack([x[:100], np.zeros((100, 5))])
    assert all((p == q).all() for p, q in zip(forest._leaves(x[:100], depth, splits, trees), forest._leaves(wider, depth, splits, trees)))


def test_vectors_of_unlike_lengths(spark):
    rows = [(i, [1.0, float(i % 7), 0.5][: 2 + i % 2], 1) for i in range(60)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = {r.vec_id: r for r in forest.near_vectors(v, leaf=16).collect()}
    x = np.array([[*r[1], 0.0][:3] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.93).sum(1) - 1
    got = np.array([out[i].n_links for i in range(60)])
    assert (got <= want).all() and got.sum() >= 0.9 * want.sum()


def test_top_k_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, np.round(rng.normal(size=6), 1).tolist(), 0) for i in range(300)] + [(301, None, 0), (350, [float("inf")] * 6, 0), (400, [None] * 6, 0), (None, [1.0] * 6, 0), (450, [9.0], 0)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    out = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.search(v, v.filter("vec_id % 50 = 0")).collect())
    live = {i: [int(np.floor(256 * a)) for a in x] for i, x, _ in rows if i is not None and x and None not in x and np.isfinite(x).all()}
    want = []
    for q in (i for i in live if i % 50 == 0):
        s = sorted((-sum(a * b for a, b in zip(live[q], live[c])), c) for c in live if c != q)[:5]
        want += [(q, r + 1, c, -n) for r, (n, c) in enumerate(s)]
    assert out == sorted(want)
    assert topk.search(v.limit(0), v.limit(0)).count() == 0
    assert topk.search(v.filter("vec_id < 3"), v.filter("vec_id = 0")).count() == 2


def test_threshold_prunes_lists_and_loses_no_pair():
    rng = np.random.default_rng(8)
    for scale in (256, 2**29):  # sums in doubles, and beyond 2**53
        for wide in (1, 3, 16, 50):
            centre = rng.normal(size=(20, wide))
            x = np.floor(scale * (centre[rng.integers(0, 20, 400)] + 0.1 * rng.normal(size=(400, wide))))
            q = np.concatenate([x[:6], np.zeros((1, wide))])
            full = [[sum(int(a) * int(b) for a, b in zip(u, v)) for v in x] for u in q]
            kth = [sorted(f)[-5] for f in full]
            at, row, score, done = topk.reaching(q, x, topk._cutoffs(kth))
            found = {(int(i), int(j)): int(s) for i, j, s in zip(at, row, score)}
            assert all(found[i, j] == full[i][j] for i, j in found)
            assert {(i, j) for i, f in enumerate(full) for j, s in enumerate(f) if s >= kth[i]} <= set(found)
            few = topk.reaching(q[:6], x, topk._cutoffs(kth[:6]))[3]
            assert wide < 16 or few < 0.6 * topk.LISTS * 6 * 400  # a good part of the list sums is never made
            assert len(topk.reaching(-q, x, topk._cutoffs([None] * 7))[0]) == 7 * 400


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(6)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop")
    rows = []
    for c in range(12):
        base = [word() for _ in range(rng.choice([3, 6, 40, 120]))]
        for _ in range(12):
            t = list(base)
            for _ in range(rng.randint(0, 5)):
                t[rng.randrange(len(t))] = word()
            rows.append((len(rows), " ".join(t), 0))
    rows += [(900, None, 0), (901, "", 0), (902, " \n", 0), (903, "One  two", 0), (904, "one two", 0), (905, "one two three", 0), (None, rows[0][1], 0), (7, "quite another text of some words", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    out = minhash.near_duplicates(docs).collect()

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    live = [(i, shingles(t)) for i, t, _ in rows if i is not None]
    parent = {i: i for i, _ in live}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(live)):
        for b in range(a):
            x, y = live[a][1], live[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((root(live[a][0]), root(live[b][0])))
                parent[q] = p
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == root(r.doc_id) and r.kept == (r.doc_id == r.component_id), r
    assert {(r.doc_id, r.n_shingles) for r in out if r.doc_id is not None} == {(i, len(s)) for i, s in live}
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_in_group_comparison_finds_what_links():
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base), " ".join([*base[:58], "x", "y"]), "other words that have nothing to do with it at all", " ".join(base[:20])]
    of, h = minhash.shingle_sets(pa.array(texts))
    assert minhash._links([10, 11, 12, 13], [10, 11, 12, 13], [0, 0, 0, 0], of, h, False) == [(10, 11)]
    assert minhash._links([10, 11, 12, 13], [10, 10, 12, 13], [0, 0, 0, 0], of, h, False) == []
