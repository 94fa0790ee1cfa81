import math
import tracemalloc

import numpy as np
import pyarrow as pa

from feedloom.llm import kneser, language
from feedloom.llm.common import crc_fold
from feedloom.llm.language import identify


def brute(corpus: list[str], order: int, v: int):
    """Probability of a character after a context by the definition, from all (order-1)-edged windows."""
    from collections import Counter

    raw = Counter()
    for w in corpus:
        t = "_" + w + "_"
        for i in range(1, len(t)):
            n = min(i + 1, order)
            raw[t[i + 1 - n : i + 1]] += 1
    level = {order: Counter({g: c for g, c in raw.items() if len(g) == order})}
    for n in range(order - 1, 0, -1):
        level[n] = Counter({g: c for g, c in raw.items() if len(g) == n})
        for g in level[n + 1]:
            level[n][g[1:]] += 1

    def p(g: str) -> float:
        n = len(g)
        if n == 0:
            return 1 / v
        counts = level[n]
        n1, n2 = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
        d = min(0.95, max(0.05, n1 / (n1 + 2 * n2) if n1 else 0.5))
        mine = {x: c for x, c in counts.items() if x[:-1] == g[:-1]}
        total = sum(mine.values())
        if not total:
            return p(g[1:])
        return max(mine.get(g, 0) - d, 0) / total + d * len(mine) / total * p(g[1:])

    return p


def test_scores_follow_the_definition(spark):
    corpus = ["banana", "bandana", "ananas", "cab", "a", "nab"]
    df = spark.createDataFrame([(" ".join(corpus), "x"), ("zz zy", "y")], "text string, class string")
    base, strings = kneser.estimated(kneser.counts(df, 3), 3)
    rows = strings.toArrow()
    model = kneser.Held.of(base, rows.column("h"), rows.column("of"))
    p = brute(corpus, 3, 10)  # nine characters of both classes with the edge, and one for the unknown
    for context in ("ab", "na", "_c", "zz", ""):
        assert abs(sum(p(context + c) for c in "abcdnsyz_q") - 1) < 1e-9, context
    got, size = model.word_scores(["banana", "cabana", "q", "bä"])
    for w, s in zip(["banana", "cabana"], got[:2, model.classes.index("x")]):
        t = "_" + w + "_"
        want = sum(math.log(p(t[max(0, i - 2) : i + 1])) for i in range(1, len(t)))
        assert abs(want - s) < 1e-9, w
    assert size.tolist() == [7, 7, 2, 3]
    # for a context that is known, the probabilities of the alphabet and of one unknown character sum to 1
    for ctx in ("an", "_b", "na"):
        total = 0.0
        for c in [*"abcdnszy_", "q"]:
            s = kneser.Spots(np.array([0]), np.array([3]), np.array([ord(x) for x in ctx + c], np.uint64), np.array([2]))
            total += math.exp(model.spot_scores(s)[0, model.classes.index("x")])
        assert 0.9 < total < 1.1


def test_identify(spark):
    en, de = "the thing that was there with the others and then", "der die das und nicht eine schöne straße für alle"
    rows = [(i, (en if i % 2 else de) + f" {'the' if i % 2 else 'und'}" * (i % 5), "en" if i % 2 else "de", "e") for i in range(120)]
    rows += [(500, None, "en", None), (501, "", "en", None), (502, " 12 !! ", None, None), (None, "the there", None, None), (503, "then the other", None, None), (503, "nicht für alle", "de", None), (504, "жжж щщщ ъъъ", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = identify(docs).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(120))
    assert all(got[i].held_out == (crc_fold(i, 3) == 1) for i in range(120))
    assert [got[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3 and got[None].lang_pred == "en"
    assert {r.lang_pred for r in out if r.doc_id == 503} == {"en", "de"}
    assert all(0 <= r.score <= 1 for r in out)
    assert got[504].rejected and not any(got[i].rejected for i in range(120))


def test_identify_without_rows_or_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert identify(empty).count() == 0
    out = identify(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)]


def test_every_gram_is_kept_and_looked_up(spark):
    """The table of counts gives the probabilities of the definition, whole or reduced to what some words look up."""
    common, rare = ["banana", "bandana", "ananas", "cab"], ["日本語", "本日"]
    df = spark.createDataFrame([(" ".join(common * 50), "x"), (" ".join(rare), "y")], "text string, class string")
    base, strings = kneser.estimated(kneser.counts(df, 3), 3)
    rows = strings.toArrow()
    assert base.classes == ["x", "y"] and len(rows) == len(set(rows.column("h").to_pylist()))
    words = ["日本", "banana", "cabana", "q"]
    keys = set(kneser.needed(words, 3).view(np.int64).tolist())
    some = rows.filter(pa.array([h in keys for h in rows.column("h").to_pylist()]))
    assert 0 < len(some) < len(rows)
    v = len({c for w in common + rare for c in w}) + 2
    for k, corpus in enumerate((common * 50, rare)):
        p = brute(corpus, 3, v)
        for table in (rows, some):
            got, _ = kneser.Held.of(base, table.column("h"), table.column("of")).word_scores(words)
            for w, s in zip(words, got[:, k], strict=True):
                t = "_" + w + "_"
                assert abs(sum(math.log(p(t[max(0, i - 2) : i + 1])) for i in range(1, len(t))) - s) < 1e-9, (w, k)


def different_words(n: int) -> list[str]:
    return ["".join(chr(97 + i // 26**k % 26) for k in range(4)) + "ßä日"[i % 3] * (i % 5) + ("'" + "xyz"[i % 3] * 3) * (i % 2) for i in range(n)]


def peak_mb(run) -> float:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_words_are_held_in_portions():
    """A worker that met 1 MB of different words at once took over 100 bytes for each of their characters."""
    words = different_words(100_000)
    assert peak_mb(lambda: kneser.needed(words)) < 40
    assert peak_mb(lambda: sum(len(x) for x in kneser.grams(words, np.ones(len(words)), "x"))) < 40


def test_portions_change_nothing(monkeypatch):
    words, times = ["", "x" * 50, *different_words(300), "banana", "12"], np.arange(304) % 7
    keys, grams = kneser.needed(words), pa.Table.from_batches(kneser.grams(words, times, "x"))
    monkeypatch.setattr(kneser, "AT_ONCE", 40)
    portions = list(kneser.portions(words))
    assert len(portions) > 50 and [w for p in portions for w in words[p]] == words
    assert kneser.needed(words).tolist() == keys.tolist()
    assert pa.Table.from_batches(kneser.grams(words, times, "x")).equals(grams)
    assert list(kneser.portions([])) == [] and not len(kneser.needed([])) and not list(kneser.grams([], times[:0], "x"))


def test_blocks_of_bags_hold_few_words(monkeypatch):
    """Many different words end a block; each text keeps its words, and each block what they look up."""

    class Task:
        @staticmethod
        def get():
            return type("Context", (), {"partitionId": lambda self: 0})()

    monkeypatch.setattr(language, "TaskContext", Task)
    monkeypatch.setattr(language, "SLICE", 100)
    monkeypatch.setattr(language, "MOST", 40)
    texts = [" ".join(different_words(200)[i : i + 6] + ["the"] * (i % 3)) for i in range(0, 190, 3)] + [None, ""]
    n = len(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array(["x"] * n), pa.array([False] * n), pa.array(texts, pa.string())], names=["row", "doc_id", "lang", "held_out", "text"])
    blocks, got = {}, []
    for bag in language._bags([batch]):
        (r,) = bag.to_pylist()
        names, keys = blocks.setdefault(r["block"], ([], []))
        names += r["names"]
        keys += r["keys"]
        per = language._unpacked(r["per"], len(r["row"]))
        step, times = (language._unpacked(r[x], per.sum()) for x in ("step", "times"))
        for count, end in zip(per, np.cumsum(per)):
            code = np.cumsum(step[end - count : end])
            got.append(sorted(names[c] for c, t in zip(code, times[end - count : end]) for _ in range(t)))
    assert got == [sorted((t or "").split()) for t in texts]
    assert len(blocks) > 3
    for names, keys in blocks.values():
        assert len(names) == len(set(names)) <= 40 + 2 * 14
        assert sorted(keys) == sorted(kneser.needed(names).view(np.int64).tolist())


def test_small_tables_start_no_python_workers(spark, monkeypatch):
    made = []
    real = type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: made.append(type(data).__name__) or real(self, data, *a, **k))
    docs = real(spark, [(i, f"some words of number {i}", "en") for i in range(50)], "doc_id long, text string, lang string")
    assert language.identify(docs).count() == 50
    assert made and set(made) == {"Table"}
