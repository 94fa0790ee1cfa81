import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from feedloom.llm import packing
from feedloom.llm.pieces import Pieces


@pytest.fixture(scope="module")
def pieces():
    return Pieces(packing.vocabulary())


def test_ids_equal_the_tokenizer(pieces):
    rng = random.Random(3)
    alphabet = "abcXYZ019 .,!?'|%*\t\n\x0b\x0c\réßÄñ×ÿ"
    wild = alphabet + "\x1c\x1f\x85\xa0 Σςİ́eKſﬁ😀中‍"
    texts = ["", " ", "it's we'll 'd", "<|endoftext|> x<|endoftext|>y <|ENDOFTEXT|>", "A" * 3000, None]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += ["".join(rng.choice(wild) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    offsets, ids = pieces.encode(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == pieces.tokenizer.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_first_fit_decreasing_against_a_plain_scan():
    rng = random.Random(5)
    for _ in range(50):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(1, 80))]
        bins: list[int] = []
        want = [0] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            b = next((b for b, room in enumerate(bins) if room >= sizes[i]), len(bins))
            if b == len(bins):
                bins.append(100)
            bins[b] -= sizes[i]
            want[i] = b
        assert packing.first_fit_decreasing(sizes, 100) == want


def test_pack_round_trip(spark, pieces):
    texts = ["a b c " * 2000, "one two", "", None, "x", "x", " "] + [f"word{i} " * (i * 7 % 90) for i in range(60)]
    rows = [(None if i == 4 else i % 50, t, "extra") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    out = packing.pack(docs, length=256, group=20).collect()
    byseq: dict = {}
    for r in out:
        byseq.setdefault(r.sequence_id, []).append(r)
    for seq in byseq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    want = []
    for i, t, _ in rows:
        ids = [*pieces.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want += [(i, s, len(ids[s : s + 256]), zlib.crc32(np.array(ids[s : s + 256], "<u4").tobytes()), len(ids)) for s in range(0, len(ids), 256)]
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(want, key=key) == sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out), key=key)


def test_pack_of_an_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_worker_remembers_few_words_and_no_lists(monkeypatch):
    monkeypatch.setattr("feedloom.llm.pieces.REMEMBERED", 500)
    own = Pieces(packing.vocabulary())
    for k in range(0, 6000, 1000):
        texts = [f"often w{i}x'{i % 7} q{i}é" for i in range(k, k + 1000)]
        offsets, ids = own.encode(pa.array(texts))
        for i in (0, 1, 500, 999):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == own.tokenizer.encode(texts[i], add_special_tokens=False).ids
        assert len(own.recent) <= 500 and len(own.older) <= 500
    assert own.recent and all(isinstance(x, bytes) for x in own.recent.values())
