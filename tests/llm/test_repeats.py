"""Repeated passages against brute force; the suffix array and its interval tree against their definitions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from feedloom.llm import repeats


def brute(docs):
    whole = [(t or "").encode() for _, t in docs]
    n = Counter(b[i : i + 200] for b in whole for i in range(len(b) - 199))
    out = []
    for (d, _), b in zip(docs, whole, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if n[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))  # noqa: B905
    return sorted(out, key=str)


def made(spark, docs, **more):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in repeats.deduplicated(df).collect()), key=str)


def corpus(rng, n=60):
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    text = lambda k: " ".join(word() for _ in range(k))
    passage = [text(rng.randint(40, 120)) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = [text(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passage)
            a, b = rng.randint(0, len(p) // 2), rng.randint(len(p) // 2, len(p))
            parts += [p[a:b] if rng.random() < 0.5 else p, text(rng.randint(0, 30))]
        docs.append((i, "".join(parts)))
    x = text(200)
    docs += [(100, x), (101, x), (100, x), (None, x), (102, x[:300] + "!" + x[301:]), (103, x + x), (104, x[:199]), (105, x[:200]), (106, None), (107, ""), (None, "short")]
    docs += [(108, "a" * 700), (109, "a" * 201), (110, "ab" * 300), (111, "é" * 150), (112, "b" + "é" * 150), (113, "xyz" * 66), (114, "q" * 200)]
    return docs


def test_equals_brute_force(spark):
    docs = corpus(random.Random(5))
    got = made(spark, docs)
    assert got == brute(docs) and sum(r[2] for r in got) > 10_000


def test_many_fragments_of_an_anchor_are_halved(spark, monkeypatch):
    """One passage in many contexts; every key is over the limit until its fragments are equal."""
    monkeypatch.setattr(repeats, "MANY", 4)
    rng = random.Random(8)
    text = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    p = text(260)
    docs = [(i, text(rng.randint(0, 150)) + p[rng.randint(0, 40) : 260 - rng.randint(0, 40)] + text(rng.randint(0, 150))) for i in range(40)]
    docs += [(50, docs[0][1]), (None, docs[1][1])]
    assert made(spark, docs) == brute(docs)


def test_pieces_of_long_texts_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(repeats, "AT_ONCE", 1000)
    texts = [t or "" for _, t in corpus(random.Random(6), 25)]
    texts.append(" ".join(texts))
    seen = Counter()
    for at in range(0, len(texts), 7):
        block = pa.array(texts[at : at + 7])
        for data, off, rows, place in repeats._pieces(block):
            doc, first, size, m, _ = repeats.fragments(data, off)
            for d, a, n, anchor in zip(doc, first, size, m, strict=True):
                assert a <= anchor <= a + repeats.LENGTH - repeats.GRAM
                whole = texts[at + rows[d]].encode()
                for i in range(n):
                    start = a - off[d] + place[d] + i
                    assert whole[start : start + 200] == data[a + i : a + i + 200].tobytes() and len(whole) >= start + 200
                    seen[at + rows[d], start] += 1
    want = {(i, k) for i, t in enumerate(texts) for k in range(len(t.encode()) - 199)}
    assert set(seen) == want and set(seen.values()) == {1}


def test_blocks_of_keys_and_batches_do_not_matter(monkeypatch):
    rng = random.Random(11)
    shared = [bytes(rng.randrange(97, 100) for _ in range(220)) for _ in range(8)]
    rows = []
    for key in range(8):
        for c in range(rng.randint(1, 5)):
            left, right = rng.randint(0, 12), rng.randint(0, 12)
            rows.append((key, c, 0, 50 - left, shared[key][left : 220 - right] + bytes(rng.randrange(97, 100) for _ in range(rng.randint(0, 9)))))
    schema = pa.schema([("key", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("m", pa.int32()), ("bytes", pa.binary())])
    batches = lambda k: [pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows[i : i + k]], schema) for i in range(0, len(rows), k)]
    found = []
    for block, k in ((1 << 20, 100), (1, 3), (600, 1)):
        monkeypatch.setattr(repeats, "BLOCK", block)
        found.append(sorted(tuple(r.values()) for b in repeats._repeats(batches(k)) for r in b.to_pylist()))
    assert found[0] == found[1] == found[2] and found[0]


def test_empty_tables_and_clashing_columns(spark):
    assert made(spark, []) == []
    docs = [(1, "w" * 300), (2, "other")]
    df = spark.createDataFrame([(*d, 1, "s", 2) for d in docs], "doc_id long, text string, k1 int, spans string, anchor int")
    assert sorted((tuple(r) for r in repeats.deduplicated(df).collect()), key=str) == brute(docs)


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array_and_interval_tree(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab\x00") for _ in range(rng.randint(1, 40))) for _ in range(4)]
    strings = [("".join(rng.choice([*base, "c", "d"]) for _ in range(rng.randint(1, 6)))).encode() for _ in range(12)]
    sa = repeats.SuffixArray(strings)
    suffix = [strings[sa.of[p]][p - sa.start[sa.of[p]] :] for p in sa.order]
    assert suffix == sorted(s[i:] for s in strings for i in range(len(s)))
    for i in range(1, len(suffix)):
        a, b = suffix[i - 1], suffix[i]
        same = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert sa.lcp[i] == same
    least = 5
    deepest, length, groups = repeats.intervals(sa, least)
    # by definition: strings of at least `least` bytes that occur twice and can be made longer on neither side
    place = {}
    for t, s in enumerate(strings):
        for i in range(len(s)):
            for k in range(least, len(s) - i + 1):
                place.setdefault(s[i : i + k], []).append((t, i))
    want = {}
    for w, at in place.items():
        before = {strings[t][i - 1] if i else None for t, i in at}
        after = {strings[t][i + len(w)] if i + len(w) < len(strings[t]) else None for t, i in at}
        if len(at) > 1 and (len(before) > 1 or None in before) and (len(after) > 1 or None in after):
            want[w] = len(at)
    assert {suffix[lo][:size]: hi - lo + 1 for size, lo, hi, _ in groups} == want
    for g, (size, lo, hi, parent) in enumerate(groups):
        assert parent < 0 or (groups[parent][0] < size and groups[parent][1] <= lo and hi <= groups[parent][2])
        assert all(length[i] >= size for i in range(lo, hi + 1))
    # what the groups cover is what repeats
    cover = [np.zeros(len(s), bool) for s in strings]
    for p, k in zip(sa.order, length, strict=True):
        t = sa.of[p]
        cover[t][p - sa.start[t] : p - sa.start[t] + k] = True
    for t, s in enumerate(strings):
        gone = np.zeros(len(s), bool)
        for i in range(len(s) - least + 1):
            if len(place[s[i : i + least]]) > 1:
                gone[i : i + least] = True
        assert (cover[t] == gone).all()


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    p = rng.integers(97, 101, 400, dtype=np.uint8)
    data = np.concatenate([rng.integers(97, 101, 300, dtype=np.uint8), p, rng.integers(97, 101, 77, dtype=np.uint8), p])
    least = repeats.leftmost_least(repeats.grams(data))
    a, b = 300, 300 + 400 + 77
    for i in range(201):
        assert least[a + i] - a == least[b + i] - b
