"""[5] Toxicity: noisy-channel restoration of disguised words by Viterbi decoding, then a score of the restored text."""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import kneser
from feedloom.llm.common import crc_mod, dropped, fresh, listed, release, saved, table, text_blocks, words

FOLDS, HELD_OUT = 5, 0
#: What a written sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: Log costs of the channel: a sign for a letter, a dropped separator, a repetition read as one or as two letters.
SIGN, GAP, ONCE, TWICE = -1.0, -0.5, -0.3, -1.0
#: Signs that may stand between the letters of one word.
GAPS = "._-*~'`^·,"
#: Single characters apart by white space are one word from this many on.
SPACED = 4
#: Features: words, and beginnings of 4 to 7 letters of words of more than 6.
HEADS, SHORT = (4, 5, 6, 7), 6
#: Toxic and other training texts that the fits take at most, by a seeded hash.
MOST_TOXIC, MOST_OTHER = 20_000, 40_000
#: A feature must be this many times as frequent among the words of toxic training texts, and explain at least this many
#: of these texts beyond chance and beyond what earlier ones explain, and so many deviations of chance.
LEAST_LIFT, LEAST_NEW, LEAST_DEVIATIONS = 3.0, 4, 4.0
#: Bytes of distinct disguised words, and of training texts, that are restored together.
TOGETHER, TEXTS_TOGETHER = 256 << 10, 4 << 20
#: Bytes of text whose words are collected at once.
BLOCK = 8 << 20
#: Disguised words with a weight are broadcast up to so many and so many bytes; beyond, they are joined.
FEW, FEW_BYTES = 200_000, 16 << 20

_CLEAN = r"^[\pL]*[.,;:!?)\"'-]*$"
_TRAIL = re.compile(r"^([\"'(\[]*)(.*?)([.,;:!?)\"'\]]*)$", re.S)
_REMEMBERED = 200_000
#: The mark before the single characters of a spelled-out run, among written words.
RUN = " "


class Channel:
    """Restores words: the likeliest letters under the character model and the channel's costs.

    strings: (c, total, types) of the model's strings that the words look up: count as a gram, and as a context the sum
    and the number of the grams that continue it.
    """

    def __init__(self, base: kneser.Base, strings: dict[str, tuple[int, int, int]]):
        self.base, self.strings, self.order = base, strings, base.order
        self.chance: dict[str, float] = {"": 1.0 / base.vocabulary}
        self.known: dict[str, float] = {}

    def probability(self, gram: str) -> float:
        """Interpolated Kneser-Ney probability of the last character of a gram of up to the model's order."""
        got = self.chance.get(gram)
        if got is None:
            n, base = len(gram), self.base
            got = self.probability(gram[1:])
            _, total, types = (0, base.total[0], base.types[0]) if n == 1 else self.strings.get(gram[:-1], _NEVER)
            if total > 0:
                d = float(base.discount[n, 0])
                got = float((max(self.strings.get(gram, _NEVER)[0] - d, 0.0) + d * types * got) / total)
            if len(self.chance) > _REMEMBERED:
                self.chance = {"": 1.0 / base.vocabulary}
            self.chance[gram] = got
        return got

    def p(self, gram: str) -> float:
        got = self.known.get(gram)
        if got is None:
            if len(self.known) > _REMEMBERED:
                self.known.clear()
            got = self.known[gram] = math.log(self.probability(gram))
        return got

    def lattice(self, word: str) -> list[list[tuple[str, float]]]:
        """For each run of one character, the readings and their costs."""
        out = []
        i = 0
        while i < len(word):
            c, j = word[i], i
            while j < len(word) and word[j] == c:
                j += 1
            n, i = j - i, j
            if c.isalpha():
                reads = [(c, 0.0)] if n == 1 else [(c * 2, 0.0), (c, ONCE)] if n == 2 else [(c, ONCE), (c * 2, TWICE)]
            else:
                reads = [(x * k, SIGN * k) for x in LEET.get(c, "") for k in ((1,) if n == 1 else (1, 2))]
                if c in GAPS or c.isspace():
                    reads.append(("", GAP))
                if not reads:
                    return []
            out.append(reads)
        return out

    def decode(self, word: str) -> str:
        """Viterbi over the lattice; a state is the last characters that the model looks at. No reading: the word itself."""
        steps = self.lattice(word)
        return (self._path(steps) if steps else "") or word

    def words_of(self, run: str) -> list[str]:
        """Words of single characters apart by white space: an edge may follow any of them. A character without a
        reading ends a word and is left out."""
        found = kneser.EDGE.join(self._path(x) for x in self._lattices(RUN + run))
        return [w for w in found.split(kneser.EDGE) if w]

    def _lattices(self, written: str) -> list[list[list[tuple[str, float]]]]:
        """The lattices of a written word or run."""
        if not written.startswith(RUN):
            core = _core(written)
            return [x for x in [self.lattice(core)] if x] if core else []
        parts = "".join(c if c.isalpha() or c in LEET or c in GAPS else " " for c in written[1:]).split()
        return [self._edged(self.lattice(x)) for x in parts]

    def needed(self, written: Iterable[str]) -> set[str]:
        """All strings of a model that restoring the written words and runs may look up."""
        keep, edge, grams = self.order - 1, kneser.EDGE, set()
        for word in written:
            for steps in self._lattices(word):
                states = {edge}
                for reads in steps:
                    after = set()
                    for s in states:
                        for letters, _ in reads:
                            t = s
                            for c in letters:
                                grams.add(t + c)
                                t = edge if c == edge else (t + c)[-keep:]
                            after.add(t)
                    states = after
                grams.update(s + edge for s in states)
        tails = {g[i:] for g in grams for i in range(len(g))}
        return tails | {g[:-1] for g in tails if len(g) > 1}

    def restored(self, written: str) -> list[str]:
        """The words that a written word or run stands for."""
        return self.words_of(written[1:]) if written.startswith(RUN) else [self.restore(written)]

    @staticmethod
    def _edged(steps: list[list[tuple[str, float]]]) -> list[list[tuple[str, float]]]:
        """The lattice with an edge of words after or inside any reading of letters."""
        out = []
        for i, reads in enumerate(steps):
            reads = reads + [(x[0] + kneser.EDGE + x[1], cost) for x, cost in reads if len(x) == 2]
            out.append(reads + [(x + kneser.EDGE, cost) for x, cost in reads if x and i < len(steps) - 1])
        return out

    def _path(self, steps: list[list[tuple[str, float]]]) -> str:
        """The best path. Paths are chains (chain before, letters), so steps of any number take memory in proportion,
        and what no best path uses goes at once."""
        keep, edge = self.order - 1, kneser.EDGE
        states: dict[str, tuple[float, tuple | None]] = {edge: (0.0, None)}
        for reads in steps:
            after: dict[str, tuple[float, tuple | None]] = {}
            for state, (cost, chain) in states.items():
                for letters, channel in reads:
                    total, s = cost + channel, state
                    for c in letters:
                        total += self.p(s + c)
                        s = edge if c == edge else (s + c)[-keep:]
                    old = after.get(s)
                    # a tie goes to the reading that comes first in the alphabet
                    if old is None or total > old[0] or (total == old[0] and _earlier((chain, letters), old[1])):
                        after[s] = (total, (chain, letters))
            states = after
        best = None
        for s, (cost, chain) in states.items():
            cost += 0.0 if s == edge and chain and chain[1].endswith(edge) else self.p(s + edge)
            if best is None or cost > best[0] or (cost == best[0] and _earlier(best[1], chain)):
                best = (cost, chain)
        out, chain = [], best[1]
        while chain:
            chain, letters = chain
            out.append(letters)
        return "".join(reversed(out))

    def restore(self, word: str) -> str:
        """A lower-cased word: marks at its ends stay marks unless that leaves no reading; letters of which none comes
        twice in a row stay as they are."""
        if word.isalpha() and not _repeats(word):
            return word
        core = _core(word)
        return self.decode(core) if core else _TRAIL.match(word).group(2) if any(map(str.isalpha, word)) else word


_NEVER = (0, 0, 0)


def _core(word: str) -> str:
    """What of a word is decoded: without the marks at its ends; nothing if that has no letter, or only letters of which
    none comes twice in a row."""
    core = _TRAIL.match(word).group(2)
    return "" if core.isalpha() and not _repeats(core) or not any(map(str.isalpha, core)) else core


def _earlier(a: tuple | None, b: tuple | None) -> bool:
    """Whether the text of chain a comes before that of chain b, of as many steps; read back to where they part."""
    x, y = [], []
    while a is not b:
        x.append(a[1])
        y.append(b[1])
        a, b = a[0], b[0]
    return "".join(reversed(x)) < "".join(reversed(y))


def _repeats(word: str) -> bool:
    return any(a == b and a.isalpha() for a, b in zip(word, word[1:], strict=False))


_ASCII = np.array([chr(i).isalpha() and i < 128 for i in range(256)])


def _repeating(names: pa.Array) -> np.ndarray:
    """_repeats() of each word, none of which holds a line break."""
    out = np.zeros(len(names), bool)
    wide = np.int32 if pa.types.is_string(names.type) else np.int64
    at = np.frombuffer(names.buffers()[1], wide)[names.offset : names.offset + len(names) + 1].astype(np.int64)
    data = np.frombuffer(names.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    twice = np.flatnonzero((data[1:] == data[:-1]) & _ASCII[data[1:]])
    word = np.searchsorted(at, twice, "right") - 1
    out[word[twice + 1 < at[word + 1]]] = True
    # bytes are not letters beyond ASCII
    wide = np.unique(np.searchsorted(at, np.flatnonzero(data >= 0x80), "right") - 1)
    wide = wide[~out[wide]]
    if len(wide):
        raw = np.frombuffer(("\n".join(listed(names.take(pa.array(wide)))) + "\n").encode("utf-32-le", "replace"), np.uint32)
        twice = np.flatnonzero((raw[1:] == raw[:-1]) & kneser.letters()[raw[1:]])
        out[wide[np.cumsum(raw == 10)[twice]]] = True
    return out


def _disguise(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which words are letters alone with marks behind them, none twice in a row; which of the others are disguised."""
    plain = np.asarray(pc.match_substring_regex(names, _CLEAN)) & ~_repeating(names)
    return plain, ~plain & np.asarray(pc.match_substring_regex(names, r"\pL"))


_MARKS = ".,;:!?)\"'-"


def _runs(doc: np.ndarray, code: np.ndarray, names: pa.Array) -> tuple[list[int], list[int], list[str]]:
    """Documents, codes and texts of runs of SPACED or more single characters; a run ends with its document."""
    single = (np.asarray(pc.utf8_length(names)) == 1)[code]
    if not single.any():
        return [], [], []
    some = np.flatnonzero(single)
    new = np.ones(len(some), bool)
    new[1:] = (some[1:] != some[:-1] + 1) | (doc[some[1:]] != doc[some[:-1]])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(some)))
    raw, extra, of, more = None, {}, [], []
    for at, n in zip(some[first[size >= SPACED]].tolist(), size[size >= SPACED].tolist(), strict=True):
        raw = raw or {c: names[c].as_py() for c in np.unique(code[some]).tolist()}
        more.append(extra.setdefault(RUN + "".join(raw[c] for c in code[at : at + n].tolist()), len(extra)))
        of.append(int(doc[at]))
    return of, more, list(extra)


def written(text: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Words as written, lower-cased: document and code of each, the words, and which of them are disguised - those are
    whole, the others without marks at their ends. Runs of SPACED or more single characters, of any length, come as
    further disguised words that begin with RUN."""
    doc, code, names = words(pc.utf8_lower(pc.fill_null(text, "")), lower=False)
    if not len(doc):
        return doc, code, [], np.zeros(0, bool)
    plain, odd = _disguise(names)
    of, more, extra = _runs(doc, code, names)
    out = listed(pc.if_else(pa.array(plain), pc.utf8_trim(names, _MARKS), names))
    if extra:
        doc, code = np.concatenate([doc, of]), np.concatenate([code, np.array(more) + len(out)])
        out, odd = out + extra, np.concatenate([odd, [any(map(str.isalpha, x)) for x in extra]])
    return doc, code, out, odd


def features(word: str) -> list[str]:
    return [word + "$"] if len(word) <= SHORT else [*(word[:n] for n in HEADS), word + "$"]


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of all words (class ''), and the disguised words (class 'w')."""
    for block in text_blocks(batches, limit=BLOCK):
        doc, code, names, odd = written(block.column("text"))
        if len(names):
            times = np.bincount(code, minlength=len(names))
            letters = [x[1:] if x.startswith(RUN) else x for x in names]
            yield from kneser.grams(letters, np.where([x.startswith(RUN) for x in names], 0, times), "")
            found = [names[i] for i in np.flatnonzero(odd)]
            yield pa.RecordBatch.from_arrays([pa.array(["w"] * len(found), pa.string()), pa.array(found, pa.string()), pa.array([1] * len(found), pa.int64())], names=["class", "gram", "n"])
        del doc, code, names, odd


def _needed(base: kneser.Base):
    def run(group: pa.Table) -> pa.Table:
        found = sorted(Channel(base, {}).needed(group.column("w").to_pylist()))
        return pa.table({"block": pa.array([group.column("block")[0].as_py()] * len(found), pa.int64()), "s": pa.array(found, pa.string())})

    return run


def _restored(base: kneser.Base):
    def run(group: pa.Table, strings: pa.Table) -> pa.Table:
        channel = Channel(base, dict(zip(strings.column("s").to_pylist(), zip(*(strings.column(x).to_pylist() for x in ("c", "total", "types")), strict=True), strict=True)))
        names = group.column("w").to_pylist()
        out = pa.table({"w": pa.array(names, pa.string()), "words": pa.array([channel.restored(w) for w in names], pa.list_(pa.string()))})
        release()
        return out

    return run


def restored_words(disguised: DataFrame, base: kneser.Base, strings: DataFrame) -> DataFrame:
    """(w, words) of distinct disguised words (w): each is restored once, in blocks of TOGETHER bytes that are joined with
    the model's strings that their lattices look up, so a worker holds these and never a whole model."""
    blocks = max(1, -(-int(disguised.agg(F.sum(F.octet_length("w") + 4)).first()[0] or 0) // TOGETHER))
    dealt = disguised.select("w", F.pmod(F.xxhash64("w"), F.lit(blocks)).alias("block"))
    asked = saved(dealt.groupBy("block").applyInArrow(_needed(base), "block long, s string"), "asked")
    found = asked.join(strings, "s").select("block", "s", "c", "total", "types")
    out = saved(dealt.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_restored(base), "w string, words array<string>"), "restored")
    dropped(asked)
    return out


def _asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct disguised words of each block of texts; rows come with their block's number."""
    for batch in batches:
        number = np.asarray(batch.column("block"))
        for b in np.unique(number):
            for part in text_blocks([batch.filter(pa.array(number == b))]):
                _, _, names, odd = written(part.column("text"))
                found = [names[i] for i in np.flatnonzero(odd)]
                yield pa.RecordBatch.from_arrays([pa.array([int(b)] * len(found), pa.int64()), pa.array(found, pa.string())], names=["block", "w"])


def _rewritten(texts: pa.Table, restored: pa.Table) -> pa.Table:
    """Texts with what their disguised words stand for in place of these."""
    of = dict(zip(restored.column("w").to_pylist(), restored.column("words").to_pylist(), strict=True))
    out = []
    for block in text_blocks(texts.to_batches()):
        doc, code, names, odd = written(block.column("text"))
        names = [" ".join(of.get(w, [w])) if o else w for w, o in zip(names, odd, strict=True)]
        order = np.argsort(doc, kind="stable")
        ends = np.searchsorted(doc[order], np.arange(len(block) + 1))
        code = code[order]
        new = [" ".join([names[c] for c in code[a:b].tolist()]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        out.append(pa.table({"digest": block.column("digest"), "toxic": block.column("toxic"), "text": pa.array(new, pa.string())}))
    release()
    return pa.concat_tables(out) if out else texts.select(["digest", "toxic", "text"])


def _pairs(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Distinct (document, feature) pairs of restored texts and how often each occurs; the features' names; words by
    document."""
    doc, code, restored = words(text, lower=False)
    number: dict[str, int] = {}
    per = [[number.setdefault(f, len(number)) for f in features(w)] for w in listed(restored)]
    size = np.fromiter(map(len, per), np.int64, len(per))
    flat = np.fromiter((x for y in per for x in y), np.int64, int(size.sum()))
    if not len(flat):
        return doc[:0], code[:0], code[:0], [], np.zeros(len(text), np.int64)
    at, long = np.cumsum(size) - size, size[code]
    where = np.repeat(at[code] - (np.cumsum(long) - long), long) + np.arange(long.sum())
    pair, times = np.unique(np.repeat(doc, long) * len(number) + flat[where], return_counts=True)
    return pair // len(number), pair % len(number), times, list(number), np.bincount(doc, minlength=len(text))


#: The feature that stands for all words.
ALL = ""


def _evidence(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches):
        doc, feature, times, names, size = _pairs(block.column("text"))
        bad = np.asarray(block.column("toxic")).astype(bool)
        count = lambda ok, w=None: np.bincount(feature[ok], weights=w, minlength=len(names)).astype(np.int64)  # noqa: E731, B023
        t = bad[doc] if len(doc) else np.zeros(0, bool)
        columns = [count(t), count(~t), count(t, times[t]), count(~t, times[~t])]
        whole = [int(bad.sum()), int((~bad).sum()), int(size[bad].sum()), int(size[~bad].sum())]
        yield pa.RecordBatch.from_arrays([pa.array([*names, ALL], pa.string()), *(pa.array([*c.tolist(), w], pa.int64()) for c, w in zip(columns, whole, strict=True))], names=["f", "t", "n", "ct", "cn"])


def _holding(chosen):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {f: i for i, f in enumerate(chosen.value)}
        for block in text_blocks(batches):
            doc, feature, _, names, _ = _pairs(block.column("text"))
            known = np.array([number.get(x, -1) for x in names], np.int64)
            held: list[list[int]] = [[] for _ in range(len(block))]
            mine = known[feature] if len(feature) else feature
            for d, f in zip(doc[mine >= 0].tolist(), mine[mine >= 0].tolist(), strict=True):
                held[d].append(f)
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.int64()))], names=["held"])

    return run


def cover(held: list[list[int]], chance: np.ndarray, evidence: np.ndarray) -> list[int]:
    """Features that explain toxic texts no earlier feature explains, the most texts beyond chance first.

    held: the features of each toxic text; chance: the share of other texts that hold a feature. Words that only some
    group of copies has explain nothing that its real features don't, so they stay out. What is new must be LEAST_NEW
    texts and LEAST_DEVIATIONS deviations of chance, however many texts there are.
    """
    of: dict[int, list[int]] = {}
    for d, fs in enumerate(held):
        for f in fs:
            of.setdefault(f, []).append(d)
    left, out = np.ones(len(held), bool), []
    texts = {f: np.array(d) for f, d in of.items()}
    queue = [(-(len(d) - chance[f] * len(held)), -evidence[f], f) for f, d in texts.items()]
    heapq.heapify(queue)
    while queue:
        gain, e, best = heapq.heappop(queue)
        rest = left.sum()
        now = left[texts[best]].sum() - chance[best] * rest
        if now < max(LEAST_NEW, LEAST_DEVIATIONS * np.sqrt(chance[best] * rest)):
            continue  # its gain only falls
        if now < -gain - 1e-9:  # a feature is counted anew only when it leads
            heapq.heappush(queue, (-now, e, best))
            continue
        out.append(best)
        left[texts[best]] = False
    return out


def _weigher(weight: dict[str, float]):
    def of(word: str) -> tuple[float, int]:
        """Weight of a restored word's features, and whether one of them is in the lexicon with a weight above 0."""
        found = [w for f in features(word) if (w := weight.get(f)) is not None]
        return sum(found), sum(w > 0 for w in found)

    return of


def _disguised(lexicon):
    """(w, weight, hits) of the disguised words that stand for words with a weight."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _weigher(lexicon.value)
        for batch in batches:
            each = [[of(w) for w in found] for found in batch.column("words").to_pylist()]
            total, hits = np.array([sum(x for x, _ in e) for e in each]), np.array([sum(n for _, n in e) for e in each], np.int64)
            some = pa.array((hits > 0) | (total != 0), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("w").filter(some), pa.array(total, pa.float64()).filter(some), pa.array(hits).filter(some)], names=["w", "weight", "hits"])

    return run


def _weighed(lexicon, disguised):
    """Weight, lexicon words and size of each text. Disguised words weigh as in `disguised`; without that, they come in
    `odd`, with their numbers, and weigh nothing."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, heads = _Lookup({f[:-1]: w for f, w in lexicon.value.items() if f.endswith("$")}), {}
        for n in HEADS:
            heads[n] = _Lookup({f: w for f, w in lexicon.value.items() if len(f) == n and not f.endswith("$")})
        known = disguised.value if disguised else {}
        odds = _Lookup({w: x for w, (x, _) in known.items()})
        found = np.array([n for _, n in known.values()] + [0], float)
        for block in text_blocks(batches, limit=BLOCK):
            rows = len(block)
            doc, code, names = words(pc.utf8_lower(pc.fill_null(block.column("text"), "")), lower=False)
            size = np.bincount(doc, minlength=rows).astype(np.int64)
            total, hits, others = np.zeros(rows), np.zeros(rows), [[] for _ in range(rows)]
            if len(doc):
                of, more, extra = _runs(doc, code, names)
                bare = pc.utf8_trim(names, _MARKS)
                weight, hit = np.zeros(len(names) + len(extra)), np.zeros(len(names) + len(extra))
                long = np.asarray(pc.utf8_length(bare)) > SHORT
                for n, look in ((0, whole), *heads.items()):
                    if len(look.known):
                        where, w = look(pc.utf8_slice_codeunits(bare, 0, n) if n else bare)
                        ok = (where >= 0) & (long | (n == 0))
                        weight[: len(names)] += np.where(ok, w, 0.0)
                        hit[: len(names)] += ok & (w > 0)
                some = np.flatnonzero(weight[: len(names)])
                if len(some):  # what is disguised weighs as what it stands for
                    plain, odd = _disguise(names.take(pa.array(some)))
                    weight[some[odd]] = hit[some[odd]] = 0
                if len(odds.known):
                    where, w = odds(pa.concat_arrays([names, pa.array(extra, names.type)]))
                    weight += np.where(where >= 0, w, 0.0)
                    hit += np.where(where >= 0, found[where], 0.0)
                at = np.concatenate([doc, np.array(of, np.int64)])
                code = np.concatenate([code, np.array(more, np.int64) + len(names)])
                total, hits = np.bincount(at, weights=weight[code], minlength=rows), np.bincount(at, weights=hit[code], minlength=rows)
                if not disguised:
                    odd = np.concatenate([_disguise(names)[1], [any(map(str.isalpha, x)) for x in extra]]).astype(bool)
                    written_ = listed(names) + extra
                    pair, times = np.unique(at[odd[code]] * len(odd) + code[odd[code]], return_counts=True)
                    for p, n in zip(pair.tolist(), times.tolist(), strict=True):
                        others[p // len(odd)].append({"w": written_[p % len(odd)], "n": n})
            columns = [block.column("row"), block.column("doc_id"), block.column("held_out"), pa.array(total), pa.array(hits.astype(np.int64)), pa.array(size)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(others, pa.list_(pa.struct({"w": pa.string(), "n": pa.int64()})))], names=["row", "doc_id", "held_out", "weight", "hits", "size", "odd"])

    return run


class _Lookup:
    """Weights of words, by hash: places in `known` (-1 for none) and weights."""

    def __init__(self, weights: dict[str, float]):
        self.known, self.weights = pa.array(list(weights), pa.string()), np.array([*weights.values(), 0.0])

    def __call__(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        where = np.asarray(pc.fill_null(pc.index_in(names, value_set=self.known), -1))
        return where, self.weights[where]


_WEIGHED = "row long, doc_id long, held_out boolean, weight double, hits long, size long, odd array<struct<w:string,n:bigint>>"


def weighed(docs: DataFrame, lexicon: dict[str, float], restored: DataFrame, few: int = FEW, few_bytes: int = FEW_BYTES) -> DataFrame:
    """doc_id, held_out, weight, hits, size of every text. The disguised words with a weight are broadcast while they are
    few; otherwise those of the texts are joined with them."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(lexicon)
    bad = saved(restored.mapInArrow(_disguised(shared), "w string, weight double, hits long"), "disguised")
    n, size = bad.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("w")), F.lit(0))).first()
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    if n <= few and size <= few_bytes:
        known = spark.sparkContext.broadcast({r.w: (r.weight, r.hits) for r in bad.toLocalIterator()})
        return saved(texts.mapInArrow(_weighed(shared, known), _WEIGHED).drop("row", "odd"), "weighed")
    each = saved(texts.mapInArrow(_weighed(shared, None), _WEIGHED), "written")
    more = each.select("row", F.explode("odd").alias("o")).select("row", "o.w", "o.n").join(bad, "w")
    more = more.groupBy("row").agg(F.sum(F.col("n") * F.col("weight")).alias("more"), F.sum(F.col("n") * F.col("hits")).alias("found"))
    none = lambda c: F.coalesce(c, F.lit(0))
    out = each.drop("odd").join(more, "row", "left")
    return saved(out.select("doc_id", "held_out", (F.col("weight") + none("more")).alias("weight"), (F.col("hits") + none("found")).alias("hits"), "size"), "weighed")


def _inputs(weight, size, log, most):
    """What the last fit sees of a text, for arrays and for columns alike."""
    return [log(weight + 1), most(weight / (size + 1) * 100, 100.0), most(weight, 1.0), log(size + 1), log(weight + 1) * log(size + 1)]


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression by damped Newton steps on standardised inputs."""
    mean, dev = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.hstack([(x - mean) / dev, np.ones((len(x), 1))])
    loss = lambda w: np.logaddexp(0, z @ w).sum() - y @ (z @ w) + 0.5 * (w[:-1] ** 2).sum()
    w, ridge = np.zeros(z.shape[1]), np.diag([1.0] * x.shape[1] + [1e-9])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + ridge, z.T @ (y - p) - ridge @ w)
        rate = 1.0
        while rate > 1e-6 and loss(w + rate * step) > loss(w):
            rate /= 2
        w = w + rate * step
        if np.abs(rate * step).max() < 1e-7:
            break
    w[:-1] /= dev
    w[-1] -= (w[:-1] * mean).sum()
    return w


def draw(column: str, seed: int, n: int, most: int):
    """Keeps about 0.97 * most of n rows by a seeded hash, or all if they are fewer."""
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, 0.97 * most / max(n, 1))) + 1


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, hits (its words in the learned lexicon).

    1. One pass over all documents (no labels) gathers the n-grams of a Kneser-Ney character model, pre-aggregated, and
       the distinct disguised words: those with digits, signs, inner separators, a letter twice or more in a row, or
       spelled out by spaces. Other words of letters alone have one path, themselves.
    2. The channel: disguised words become lattices, and the Viterbi path under model and channel costs is the restored
       word, of any length; what is spelled out may be several words, whose edges the path sets. Each distinct word is
       restored once, beside the model's strings that it looks up (restored_words), so no model is broadcast.
    3. Over at most MOST_TOXIC and MOST_OTHER labelled training texts (crc32 of the id modulo 5 is not 0; drawn by a
       seeded hash of the id, so only bounded ids are broadcast and only these texts are shuffled), restored, equal
       texts once: how many toxic and other texts hold a feature, and how often. A greedy cover of the toxic ones keeps
       the features that explain texts by themselves. A feature weighs its log lift.
    4. Every whole text is weighed: its words by the lexicon, its disguised words by what they were restored to; a
       logistic fit on at most MOST_TOXIC and MOST_OTHER labelled training texts turns weight and length into the score,
       by expressions of the engine.

    Null and empty texts have no features. Null ids count as the empty text for the fold. Null labels are not learned
    from; an id labelled twice is toxic if any label says so. With no labelled text of either kind every score is 0. An
    empty table gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    docs = fresh(docs, "doc_id", "text").withColumn("held_out", crc_mod("doc_id", FOLDS) == HELD_OUT)
    nothing = docs.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0).cast("long").alias("hits"))
    gathered = docs.filter("text is not null").select("text").mapInArrow(_gathered, kneser._GRAMS)
    gathered = saved(gathered.groupBy("class", "gram").agg(F.sum("n").alias("n")), "gathered")
    base, strings = kneser.estimated(gathered.filter("class = ''"), hashed=False)
    if not base.classes:
        return nothing
    restored = restored_words(gathered.filter("class = 'w'").select(F.col("gram").alias("w")), base, strings)
    marked = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    learned = marked.filter(crc_mod("id", FOLDS) != HELD_OUT)
    labelled = {r.toxic: r["count"] for r in learned.groupBy("toxic").count().collect()}
    some = [learned.filter(F.col("toxic") == y).filter(draw("id", 4, labelled.get(y, 0), most)) for y, most in ((1, MOST_TOXIC), (0, MOST_OTHER))]
    picked = saved(some[0].union(some[1]), "picked")
    train = docs.filter("not held_out and text is not null").join(F.broadcast(picked), docs.doc_id == picked.id)
    train = train.groupBy(F.sha2("text", 256).alias("digest")).agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    train = saved(train.select("digest", "toxic", "text"), "training")
    blocks = max(1, -(-int(train.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // TEXTS_TOGETHER))
    train = train.withColumn("block", F.pmod(F.xxhash64("digest"), F.lit(blocks)))
    asked = train.select("block", "text").mapInArrow(_asked, "block long, w string").distinct().join(restored, "w").select("block", "w", "words")
    train = saved(train.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(_rewritten, "digest string, toxic int, text string"), "rewritten")
    seen = train.select("text", "toxic").mapInArrow(_evidence, "f string, t long, n long, ct long, cn long").groupBy("f").agg(*(F.sum(c).alias(c) for c in ("t", "n", "ct", "cn")))
    seen = saved(seen, "evidence")
    whole = seen.filter(F.col("f") == ALL).first()
    if whole is None or not whole.t or not whole.n:
        return nothing
    lift = (F.col("ct") / max(whole.ct, 1)) / ((F.col("cn") + 0.5) / max(whole.cn, 1))
    # bounded as the sample is: features of at least LEAST_NEW of its toxic texts
    top = seen.filter(F.col("f") != ALL).withColumn("lift", lift).filter(F.col("t") >= LEAST_NEW).filter(F.col("lift") >= LEAST_LIFT)
    top = top.filter(F.col("t") - F.col("n") / whole.n * whole.t >= LEAST_NEW).toPandas().sort_values("f", ignore_index=True)
    chosen = spark.sparkContext.broadcast(top["f"].tolist())
    held = train.filter("toxic = 1").select("text").mapInArrow(_holding(chosen), "held array<long>").toPandas()["held"]
    kept = cover(list(held), top["n"].to_numpy(float) / whole.n, top["lift"].to_numpy(float)) if len(top) else []
    lexicon = {top["f"][f]: float(min(np.log(top["lift"][f]), 6.0)) for f in kept}
    each = weighed(docs, lexicon, restored)
    known = each.filter("not held_out").join(marked, each.doc_id == marked.id)
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    # ids may repeat, so that the draw alone bounds nothing
    by = F.xxhash64("doc_id", "weight", "size")
    sample = [known.filter(F.col("toxic") == y).filter(draw("id", 6, counts.get(y, 0), most)).orderBy(by, "weight", "size").limit(most).select("weight", "size").toPandas() for y, most in ((1, MOST_TOXIC), (0, MOST_OTHER))]
    x = np.vstack([np.stack(_inputs(d["weight"].to_numpy(float), d["size"].to_numpy(float), np.log, np.minimum), 1) for d in sample])
    w = logistic(x, np.repeat([1.0, 0.0], [len(d) for d in sample]))
    # the sample may hold the toxic ones at another rate
    w[-1] += np.log(counts.get(1, 1) / max(len(sample[0]), 1)) - np.log(counts.get(0, 1) / max(len(sample[1]), 1))
    columns = _inputs(F.col("weight"), F.col("size").cast("double"), F.log, lambda a, b: F.least(a, F.lit(b)))
    z = F.lit(float(w[-1]))
    for a, b in zip(columns, w[:-1], strict=True):
        z = z + a * float(b)
    out = each.withColumn("score", 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-40.0)), F.lit(40.0)))))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document of the table: doc_id, held_out, score, predicted, hits."""
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
