import numpy as np
import pyarrow as pa

from feedloom.llm import kneser, quality, toxicity
from feedloom.llm.common import crc_fold


def _risk(x, p, w, prior):
    """The risk and its gradient by the definition."""
    z = x @ w
    plus, minus = np.logaddexp(0, -z), np.logaddexp(0, z)
    negative = minus.mean() - prior * minus[p].mean()
    s = 1 / (1 + np.exp(-z))
    g = prior * x[p].T @ (s[p] - 1) / p.sum() + x.T @ s / len(x) - prior * x[p].T @ s[p] / p.sum()
    return prior * plus[p].mean() + max(0, negative) + quality.DECAY / 2 * (w @ w), negative, g + quality.DECAY * w


def test_fit_is_the_minimum_of_the_non_negative_risk():
    rng = np.random.default_rng(1)
    x = np.hstack([np.vstack([rng.normal(1.0, 1, (2000, 2)), rng.normal(-1.0, 1, (1000, 2))]), np.ones((3000, 1))])
    p = np.arange(3000) < 800
    for prior in (2 / 3, 0.4):
        w = quality.fit(lambda w: quality.sums(x, p, w), 3, prior)
        slow = np.zeros(3)
        for _ in range(6000):  # plain gradient descent
            slow -= 0.1 * _risk(x, p, slow, prior)[2]
        risk, negative, g = _risk(x, p, w, prior)
        assert negative >= 0 and np.abs(g).max() < 1e-3 and risk <= _risk(x, p, slow, prior)[0] + 1e-4
    assert (((x @ quality.fit(lambda w: quality.sums(x, p, w), 3, 2 / 3)) > 0) == (np.arange(3000) < 2000)).mean() > 0.9
    # with a prior that is too high the part in the maximum would turn negative: the fit stops before
    w = quality.fit(lambda w: quality.sums(x, p, w), 3, 0.97)
    assert np.isfinite(w).all() and _risk(x, p, w, 0.97)[1] >= 0


def test_describe_handles_odd_texts():
    x = quality.describe(pa.array([None, "", " \n", "a " * 50_000, "Ünï 中文 !!!"]))
    assert x.shape == (5, len(quality.FEATURES)) and np.isfinite(x).all()
    assert x[0].tolist() == x[1].tolist() and x[0][quality.FEATURES.index("no_text")] == 1


def _docs(spark):
    good, junk = "the thing that was there with others and then some more of it.", "BUY!! NOW!! CHEAP!! CHEAP!! CHEAP!!"
    rows = [(i, (junk if i % 4 == 0 else good) + f" x{i}", i) for i in range(400)] + [(900, None, 1), (901, "", 1), (None, good, 1), (5, good, 1)]
    labels = [(i, int(i % 4 > 0), int(i % 8 == 1)) for i in range(0, 400)] + [(7, None, None), (None, 1, 1), (5, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, score int"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_of_held_out_texts(spark):
    docs, labels = _docs(spark)
    out = quality.score(docs, labels).collect()
    assert len(out) == 404 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert held and all(r.held_out == (crc_fold(r.doc_id, 3) == 1) for r in held)
    assert np.mean([r.predicted == int(r.doc_id % 4 > 0) for r in held]) > 0.95


def test_quality_without_labels_or_rows(spark):
    docs, labels = _docs(spark)
    assert {r.score for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score(docs.limit(0), labels).count() == 0


def _channel(spark, text):
    grams = pa.Table.from_batches(list(kneser.grams(text.split(), np.ones(len(text.split()), np.int64), "")))
    base, strings = kneser.estimated(spark.createDataFrame(grams.to_pandas()), hashed=False)
    return toxicity.Channel(base, {r.s: (r.c, r.total, r.types) for r in strings.collect()})


def _words(c, texts):
    """(document, word) of the restored texts."""
    doc, code, names, odd = toxicity.written(pa.array(texts))
    of = [c.restored(w) if o else [w] for w, o in zip(names, odd)]
    return [(d, w) for d, k in zip(doc.tolist(), code.tolist()) for w in of[k]]


def test_channel_restores_disguised_words(spark):
    text = "you idiot and the moron with the stupid clown in the trash said the loser was pathetic scum lol pool see book " * 3
    c = _channel(spark, text)
    for shown, want in (("1d10t", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("cl0wn!!", "clown"), ("i.d.i.o.t", "idiot"), ("losssser", "loser"), ("idiot,", "idiot"), ("the", "the"), ("2024", "2024"), ("", "")):
        assert c.restore(shown) == want, shown
    assert (0, "loser") in _words(c, ["a plain l o s e r here", None, ""])


def test_decode_is_the_best_path(spark):
    from itertools import product

    c = _channel(spark, "silly billy will spill the milk with all his skill " * 3)
    for word in ("s1l1y", "m1|k", "sp1lll", "w.1.l.l", "b1llly"):
        best = None
        for path in product(*c.lattice(word)):
            text, cost, s = "".join(x for x, _ in path), sum(y for _, y in path), "_"
            for ch in text + "_":
                cost += c.p((s + ch)[-4:])
                s = (s + ch)[-3:]
            best = max(best or (-1e9, ""), (cost, text))
        assert c.decode(word) == best[1], word


def test_toxicity(spark):
    good = "the weather is fine today and the garden is green"
    bad = good + " idiot"
    rows = [(i, (bad if i % 4 == 0 else good) + f" {'abcdefghij'[i % 10]}x" + " z" * (i % 7), 0) for i in range(400)]
    rows += [(900, "you are an 1d10t", 0), (901, None, 0), (902, "", 0), (None, bad, 0), (903, "i d i o t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits int")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert all(out[i].predicted == int(i % 4 == 0) for i in range(400))
    assert out[900].predicted == 1 and out[903].predicted == 1 and out[None].predicted == 1 and out[901].predicted == out[902].predicted == 0
    assert all(0 <= r.score <= 1 for r in out.values())
    assert toxicity.score(docs, labels.limit(0)).filter("score > 0").count() == 0
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_what_restoring_looks_up_is_all_that_it_needs(spark):
    c = _channel(spark, "you idiot and the moron with the stupid clown in the trash said the loser " * 3)
    for w in ("1d10t", "stuupid", "i.d.i.o.t!!", " thel0ser", "mmoronn", "idi" + "o" * 200 + "t"):
        keys = c.needed([w])
        part = toxicity.Channel(c.base, {s: x for s, x in c.strings.items() if s in keys})
        assert part.restored(w) == c.restored(w), w
        assert set(part.strings) < set(c.strings)


def test_joined_disguised_words_weigh_as_broadcast_ones(spark):
    rows = [(1, "you 1d10t and i d i o t and 1d10t", False), (2, None, False), (3, "", True), (None, "an idiot stuupid", True), (1, "no", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    restored = spark.createDataFrame([("1d10t", ["idiot"]), (" idiot", ["idiot"]), ("stuupid", ["stupid"])], "w string, words array<string>")
    lexicon = {"idiot$": 2.0, "stupid$": 1.5}
    some = [sorted(map(tuple, toxicity.weighed(docs, lexicon, restored, few=few).collect()), key=str) for few in (10, 0)]
    assert some[0] == some[1] and (1, False, 6.0, 3, 10) in some[0] and (None, True, 3.5, 2, 3) in some[0]


def test_cover_leaves_out_words_of_a_group_of_copies():
    held = [[0, 1, 2]] * 50 + [[0]] * 20
    assert toxicity.cover(held, np.array([0.01, 0.0, 0.0]), np.array([70, 500, 500])) == [0]


def test_doubled_letters_of_any_script_are_restored(spark):
    text = "you idiot and the moron with the stupid clown in the trash said the loser дурак большой " * 3
    c = _channel(spark, text)
    for shown, want in (("stuupid", "stupid"), ("iddiiot", "idiot"), ("mmoronn", "moron"), ("дураак", "дурак"), ("дураааак!", "дурак")):
        assert c.restore(shown) == want, shown
        assert (0, want) in _words(c, [f"a {shown} here"]), shown


def test_long_words_and_spelled_out_passages(spark):
    text = "you idiot and the moron with the stupid clown in the trash said the loser a is so " * 3
    c = _channel(spark, text)
    assert c.restore("idi" + "o" * 100 + "t") == "idiot"
    assert c.restore("1d10t." * 30) == "idiot" * 30
    for shown, want in (("you stupid", ["you", "stupid"]), ("a stupid", ["a", "stupid"]), ("is stupid", ["is", "stupid"]), ("the m0r0n", ["the", "moron"])):
        assert [w for _, w in _words(c, [" ".join(shown.replace(" ", ""))])][-len(want) :] == want, shown
    passage = "you stupid clown and the moron with the loser " * 20
    found = _words(c, [None, " ".join(passage.replace(" ", "")), " ".join("the?idiot")])
    assert sum(x == (1, "stupid") for x in found) == 20 and (2, "idiot") in found and (2, "the") in found
