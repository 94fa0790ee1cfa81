"""Collocations against counts by brute force, at every width of the sketch."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from feedloom.llm import phrases


def brute(docs, least=10, subsumed=50):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = lang or "und"
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    out = []
    often = {(lang, p): a for (lang, p), a in f.items() if len(p) > 1 and a >= least}
    for (lang, p), a in often.items():
        if len(p) == 2 and any(100 * b >= subsumed * a for (x, q), b in often.items() if x == lang and len(q) == 3 and p in (q[:2], q[1:])):
            continue
        score, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    return sorted(out)


def texts(rng, n):
    vocabulary = [f"w{i}" for i in range(40)] + ["Éa", "ÀB", "x\x1cy", "z z", "STRASSE", "straße", "日本"]
    out = []
    for _ in range(n):
        words = [rng.choice(vocabulary[: rng.choice([3, 8, 47])]) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            words += ["New", "york", "city"]
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", " \t ", ", ", ".", "\n", "! ", "\x0b"]) for w in words)
        out.append((text, rng.choice(["en", "en", "en", "de", None])))
    return out


@pytest.mark.parametrize("bits", [16, None])
def test_equals_brute_force(spark, bits, monkeypatch):
    monkeypatch.setattr(phrases, "AT_ONCE", 5000)
    docs = texts(random.Random(4), 500) + [(None, "en"), ("", "en"), ("   ", "fr"), ("...", "fr"), ("a b", "fr"), ("hot pair " * 3000, "es"), ("x" * 50_000, None)] + [("The same text, again. New York City", "en")] * 20
    df = spark.createDataFrame(docs, "text string, lang string").repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(df, bits=bits).collect())
    assert got == brute(docs) and len(got) > 50
    assert any(r[1] == "new york city" for r in got) and not any(r[1] == "new york" for r in got if r[0] == "en")


def test_narrow_sketch_loses_nothing(spark, monkeypatch):
    """With more phrases than cells all pass; the exact counts stay the same."""
    monkeypatch.setattr(phrases, "PIECE", 64)
    docs = texts(random.Random(9), 200)
    df = spark.createDataFrame(docs, "text string, lang string")
    assert sorted(tuple(r) for r in phrases.collocations(df, bits=6).collect()) == brute(docs)


def test_sums_are_never_below_counts():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 2**63, 300, dtype=np.uint64)
    parts = [rng.choice(values, 2000, p=np.arange(1, 301) / 45150) for _ in range(4)]
    total = np.zeros((phrases.DEPTH, 1 << 7), np.uint16)
    for p in parts:
        one = np.zeros((phrases.DEPTH, 1 << 7), np.uint8)
        for half in np.array_split(p, 3):
            phrases.sketched(one, half)
        total = np.minimum(total + one, 255)
    count = Counter(np.concatenate(parts).tolist())
    for row in range(phrases.DEPTH):
        at = phrases.cells(values, row, 7)
        assert all(total[row, c] >= min(count[int(v)], 255) for v, c in zip(values, at, strict=True))
    ok = phrases.passes(np.packbits(total >= 10, axis=1), values)
    assert all(ok[i] for i, v in enumerate(values) if count[int(v)] >= 10)


def test_large_counts_are_exact(spark, monkeypatch):
    """Products beyond 64 bits."""
    a = 4 * 10**14
    words = spark.createDataFrame([("en", "x", a + 1), ("en", "y", a + 3), ("en", "z", a)], "lang string, phrase string, f long")
    found = spark.createDataFrame([("en", "x", "y", None, a - 7), ("en", "y", "z", None, a - 9), ("en", "x", "y", "z", 11)], "lang string, w1 string, w2 string, w3 string, f long")
    monkeypatch.setattr(phrases, "counts", lambda *_: (words, found))
    got = {r.phrase: r for r in phrases.collocations(spark.createDataFrame([("", "")], "text string, lang string")).collect()}
    assert got["x y"].score == 1000000 * (a - 7) ** 2 // ((a + 1) * (a + 3)) and got["y z"].score == 1000000 * (a - 9) ** 2 // ((a + 3) * a)
    assert (got["x y z"].score, got["x y z"].l, got["x y z"].r) == (0, a + 1, a - 9)


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(none).collect() == []
    docs = spark.createDataFrame([("a b c", "en", 1, "p", 2)] * 12, "text string, lang string, f int, phrase string, n int")
    assert [tuple(r) for r in phrases.collocations(docs).collect()] == brute([("a b c", "en")] * 12)
