"""Token ids of whole texts by a BPE file with word ends (lower case, white space dropped), block by block."""

from __future__ import annotations

import re
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from feedloom.llm.common import listed, words

#: Texts of these characters need no Unicode normalisation: ASCII and the Latin letters of one byte in ISO 8859-1.
_PLAIN = r"^[\t-\r -~À-ÿ]*$"
#: How the file's pre-tokenizer cuts, for lower-cased plain words.
_CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")
#: Words and parts of words that a worker remembers as recent ones; as many older ones stay until these are full. A worker
#: lives on beside later stages with what it remembers.
REMEMBERED = 80_000


def _bytes_as_letters() -> dict[int, str]:
    """The usual byte-level alphabet: printable bytes stand for themselves, the others for code points from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Pieces:
    """Ids of texts; equal to the tokenizer's own encode() without special tokens, but each different word is cut once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _bytes_as_letters()
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _remember(self, word: str, ids: bytes) -> bytes:
        if len(self.recent) >= REMEMBERED:
            self.recent, self.older = {}, self.recent
        self.recent[word] = ids
        return ids

    def _plain_words(self, names: list[str]) -> list[bytes]:
        """Ids of each word, four bytes each. A part of a word is cut as it would be as a word by itself."""
        cut, tokenize, letters, remember = _CUT.findall, self.model.tokenize, self.letters, self._remember

        def part_ids(part: str) -> bytes:
            found = tokenize(part if part.isascii() else "".join([letters[b] for b in part.encode()]))
            return pack(f"<{len(found)}I", *[t.id for t in found])

        out = []
        for word in names:
            ids = self.recent.get(word)
            if ids is None:
                ids = self.older.get(word)
                if ids is None:
                    parts = cut(word)
                    if parts == [word]:
                        ids = part_ids(word)
                    else:
                        ids = b"".join([self.recent.get(x) or self.older.get(x) or remember(x, part_ids(x)) for x in parts])
                remember(word, ids)
            out.append(ids)
        return out

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) and ids of all texts, end to end."""
        text = pc.fill_null(text, "")
        plain = np.asarray(pc.and_(pc.match_substring_regex(text, _PLAIN), pc.invert(pc.match_substring(text, "<|"))))
        parts = []
        for mask, lower in ((plain, True), (~plain, False)):
            where = np.flatnonzero(mask)
            if not len(where):
                continue
            some = text.take(pa.array(where))
            doc, code, names = words(pc.utf8_lower(some) if lower else some, lower=False)
            names = listed(names)
            ids = self._plain_words(names) if lower else [pack(f"<{len(e.ids)}I", *e.ids) for e in self.tokenizer.encode_batch(names, add_special_tokens=False)]
            parts.append((where[doc], code, ids))
        n = np.zeros(len(text), np.int64)
        flats = []
        for doc, code, ids in parts:
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            flat = np.frombuffer(b"".join(ids), "<u4")
            at = np.cumsum(size) - size
            long = size[code]
            where = np.repeat(at[code] - (np.cumsum(long) - long), long) + np.arange(long.sum())
            mine = np.bincount(doc, weights=long, minlength=len(text)).astype(np.int64)
            n += mine
            flats.append((mine, flat[where]))
        offsets = np.concatenate([[0], np.cumsum(n)])
        if len(flats) == 1:
            return offsets, flats[0][1]
        out = np.empty(offsets[-1], np.uint32)
        for mine, flat in flats:
            out[np.repeat(mine > 0, n)] = flat
        return offsets, out


_LOADED: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    """One tokenizer for each worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]
