"""Pages as trees: a tolerant tokenizer to nodes numbered by intervals, and selectors as tests of containment."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import let

#: Elements without an end, and those whose text no reader sees.
VOID = "area base br col embed hr img input link meta param source track wbr".split()
UNSEEN = ["script", "style", "template"]

#: A node is an element or a piece of text (tag '#text'). begin and end are places in the order of the page: a node lies in
#: another if its begin lies between the other's.
_S, _I = T.StringType(), T.IntegerType()
NODE = T.ArrayType(T.StructType().add("tag", _S).add("attributes", T.MapType(_S, _S)).add("begin", _I).add("end", _I).add("parent", _I).add("text", _S))


#: Stands for an ampersand while a page is read as it is written; no text of the engine holds half of a surrogate pair.
_HELD = "\udc26"


class _Nodes(HTMLParser):
    def __init__(self, decoded: bool = True):
        super().__init__(convert_charrefs=True)
        self.decoded = decoded
        self.nodes: list[list] = []
        self.open: list[int] = []
        self.unseen = 0

    def _add(self, tag: str, attributes: dict, text: str | None) -> None:
        at = len(self.nodes)
        if not self.decoded:
            tag, text = tag.replace(_HELD, "&"), text and text.replace(_HELD, "&")
            attributes = {k.replace(_HELD, "&"): v.replace(_HELD, "&") for k, v in attributes.items()}
        self.nodes.append([tag, attributes, at, at, self.open[-1] if self.open else -1, text])

    def handle_starttag(self, tag, attrs):
        attributes: dict = {}
        for name, value in attrs:
            attributes.setdefault(name, value or "")
        self._add(tag, attributes, None)
        if tag not in VOID:
            self.open.append(len(self.nodes) - 1)
            self.unseen += tag in UNSEEN

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self) -> str:
        node = self.nodes[self.open.pop()]
        node[3] = len(self.nodes) - 1
        self.unseen -= node[0] in UNSEEN
        return node[0]

    def handle_endtag(self, tag):
        """Closes the innermost open element of that name and all within it; without one the end is left out."""
        if any(self.nodes[i][0] == tag for i in self.open):
            while self._close() != tag:
                pass

    def handle_data(self, data):
        text = " ".join(data.split()) if self.decoded else data
        if text and not self.unseen:
            self._add("#text", {}, text)

    def done(self) -> list[tuple]:
        self.close()
        while self.open:
            self._close()
        return [tuple(n) for n in self.nodes]


def nodes_of(html: str, decoded: bool = True) -> list[tuple]:
    p = _Nodes(decoded)
    p.feed(html if decoded else html.replace("&", _HELD))
    return p.done()


@F.pandas_udf(NODE)
def _tree(html: pd.Series) -> pd.Series:
    return html.map(nodes_of, na_action="ignore")


@F.pandas_udf(NODE)
def _tree_as_written(html: pd.Series) -> pd.Series:
    return html.map(lambda x: nodes_of(x, decoded=False), na_action="ignore")


def tree(html: Column, decoded: bool = True) -> Column:
    """The nodes of a page in their order; null for null. Ends without a start are left out, starts without an end reach
    to the end of what encloses them; texts are in single spaces, references decoded, scripts and styles without any.
    decoded=False: texts and attributes as the page writes them, with their references and white space."""
    return _tree(html) if decoded else _tree_as_written(html)


_NAME = r"[A-Za-z_][\w-]*|\*"
_PART = re.compile(rf"""\s*(>)?\s*({_NAME})?((?:\#[\w-]+|\.[\w-]+|\[[\w-]+(?:[~|^$*]?=(?:"[^"]*"|'[^']*'|[\w-]+))?\])*)""")
_TEST = re.compile(r"""#([\w-]+)|\.([\w-]+)|\[([\w-]+)(?:([~|^$*]?)=(?:"([^"]*)"|'([^']*)'|([\w-]+)))?\]""")


def selector(text: str) -> list[tuple[bool, str, list[tuple[str, str, str]]]]:
    """The parts of a selector: whether it is a child of the part before (else a descendant), its tag ('' for any), and
    tests (attribute, operation, value) of tags, ids, classes and attributes. Others are a ValueError."""
    parts, at = [], 0
    text = text.strip()
    while at < len(text):
        m = _PART.match(text, at)
        if not m or m.end() == at or not (m[2] or m[3]) or (m[1] and not parts):
            raise ValueError(f"cannot read the selector {text!r}")
        tests = [("id", "=", t[1]) if t[1] else ("class", "~=", t[2]) if t[2] else (t[3].lower(), (t[4] or "") + "=" if t[5] is not None or t[6] is not None or t[7] is not None else "", t[5] or t[6] or t[7] or "") for t in _TEST.finditer(m[3])]
        parts.append((bool(m[1]), "" if m[2] in (None, "*") else m[2].lower(), tests))
        at = m.end()
    if not parts:
        raise ValueError("a selector is empty")
    return parts


def _holds(node: Column, tag: str, tests: list[tuple[str, str, str]]) -> Column:
    ok = node["tag"] == tag if tag else node["tag"] != "#text"
    for name, op, value in tests:
        has, got = F.map_contains_key(node["attributes"], F.lit(name)), F.coalesce(F.try_element_at(node["attributes"], F.lit(name)), F.lit(""))
        v, never = F.lit(value), F.lit(False)
        test = {
            "": F.lit(True), "=": got == v, "~=": F.array_contains(F.split(F.trim(got), r"\s+"), v) if value else never, "|=": (got == v) | got.startswith(value + "-"),
            "^=": got.startswith(value) if value else never, "$=": got.endswith(value) if value else never, "*=": got.contains(value) if value else never,
        }[op]
        ok = ok & has & test
    return ok


def matches(nodes: Column, text: str) -> Column:
    """The nodes that a selector finds, in the order of the page. Each part is one filter over the nodes, against the
    intervals that the part before has found."""
    found = None
    for child, tag, tests in selector(text):
        found = _within(nodes, found, child, tag, tests)
    return found


def _within(nodes: Column, up: Column | None, child: bool, tag: str, tests: list[tuple[str, str, str]]) -> Column:
    """The nodes that hold, below those of `up` where there are any."""
    if up is None:
        return F.filter(nodes, lambda n: _holds(n, tag, tests))

    def below(n: Column, some: Column) -> Column:
        return F.exists(some, lambda u: (u["begin"] == n["parent"]) if child else (u["begin"] < n["begin"]) & (n["begin"] <= u["end"]))

    return let(up, lambda some: F.filter(nodes, lambda n: _holds(n, tag, tests) & below(n, some)))


def text_of(nodes: Column, node: Column) -> Column:
    """The texts within a node, in single spaces."""
    inside = F.filter(nodes, lambda n: (n["tag"] == "#text") & n["begin"].between(node["begin"], node["end"]))
    return F.array_join(F.transform(inside, lambda n: n["text"]), " ")


def select_all(nodes: Column, *selectors: str) -> Column:
    """The distinct texts of all that the first selector with any finds, in their order; selectors that can't be read
    find nothing."""
    each = []
    for s in selectors:
        try:
            texts = F.transform(matches(nodes, s), lambda m: text_of(nodes, m))
        except ValueError:
            continue
        texts = F.array_distinct(F.filter(texts, lambda x: x != ""))
        each.append(F.when(F.size(texts) > 0, texts))
    return F.coalesce(*each, F.array().cast("array<string>"))


def select_first(nodes: Column, *selectors: str) -> Column:
    """The text of the first node that the first selector with a text there finds, else ''."""
    each = []
    for s in selectors:
        try:
            each.append(F.nullif(F.get(F.transform(F.slice(matches(nodes, s), 1, 1), lambda m: text_of(nodes, m)), 0), F.lit("")))
        except ValueError:
            continue
    return F.coalesce(*each, F.lit(""))
