"""[2] Token counts by greedy longest match: a vocabulary trie with failure links and counts of popped tokens."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import fresh, listed, table, text_blocks, words

#: Words that a worker remembers between blocks.
REMEMBERED = 500_000
#: The mark of a word's first piece in the vocabulary file.
FIRST = "▁"


class LinMax:
    """Numbers of pieces that greedy longest match cuts words into, in time linear in a word's length.

    A trie holds the pieces that begin words, and under a second root those that go on with them. A node that has no
    edge for the next letter pops the pieces of the greedy match of its text and goes to its failure node; both are
    known in advance, so no piece is ever built.
    """

    def __init__(self, begin: Iterable[str], go_on: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}, {}]
        ends = [False, False]
        for root, pieces in ((0, begin), (1, go_on)):
            for piece in pieces:
                at = root
                for c in piece:
                    at = self._step(at, c, ends)
                ends[at] = at > 1
        n = len(self.edges)
        self.fail, self.pops = [-1] * n, [0] * n
        queue = deque((child, root, c) for root in (0, 1) for c, child in self.edges[root].items())
        while queue:  # by depth, so that failures of shorter texts are known
            node, parent, c = queue.popleft()
            if ends[node]:
                self.fail[node], self.pops[node] = 1, 1
            else:
                # follow the failures of the parent until one has an edge for c
                z, pops = self.fail[parent], self.pops[parent]
                while z >= 0 and c not in self.edges[z]:
                    pops += self.pops[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[node], self.pops[node] = self.edges[z][c], pops
            queue.extend((child, node, d) for d, child in self.edges[node].items())

    def _step(self, at: int, c: str, ends: list[bool]) -> int:
        child = self.edges[at].get(c)
        if child is None:
            child = self.edges[at][c] = len(self.edges)
            self.edges.append({})
            ends.append(False)
        return child

    def count(self, word: str) -> int:
        """Pieces of a word; 1 (one unknown piece) if greedy match can't go through, 0 for the empty word."""
        if not word:
            return 0
        edges, fail, pops = self.edges, self.fail, self.pops
        at = total = 0
        for c in word:
            while c not in edges[at]:
                total += pops[at]
                at = fail[at]
                if at < 0:
                    return 1
            at = edges[at][c]
        while at != 1:  # what is left must be pieces to the end
            total += pops[at]
            at = fail[at]
            if at < 0:
                return 1
        return total


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def pieces_of(path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin words and those that go on, from a piece file: control, unknown and byte pieces left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [p[1:] for p in plain if p.startswith(FIRST) and len(p) > 1], [p for p in plain if not p.startswith(FIRST)]


_LOADED: dict[str, LinMax] = {}


def _counted(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = LinMax(*pieces_of(path))
        count, seen = _LOADED[path].count, {}
        for block in text_blocks(batches, limit=8 << 20):
            doc, code, names = words(pc.utf8_lower(pc.fill_null(block.column("text"), "")), lower=False)
            if len(seen) > REMEMBERED:
                seen.clear()
            sizes = []
            for w in listed(names):
                n = seen.get(w)
                if n is None:
                    n = seen[w] = count(w)
                sizes.append(n)
            rows = len(block)
            total = np.bincount(doc, weights=np.array(sizes, float)[code], minlength=rows) if len(doc) else np.zeros(rows)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(np.bincount(doc, minlength=rows).astype(np.int64)), pa.array(total.astype(np.int64))], names=["doc_id", "n_words", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens of its whole text, in one pass without a shuffle.

    Words are what stands between ASCII white space, lower-cased; a word that greedy match can't cut counts as one
    unknown token. Null and empty texts have 0 of both. Null ids and repeated rows are kept; further columns are
    ignored; a word of any length takes linear time. An empty table gives an empty result.
    """
    return fresh(docs, "doc_id", "text").mapInArrow(_counted(path or vocabulary()), "doc_id long, n_words long, n_tokens long")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
