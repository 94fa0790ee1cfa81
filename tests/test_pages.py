"""Trees of pages and selectors, against a walk over the nodes; many pages at once."""

import random

import pytest
from pyspark.sql import functions as F

from feedloom.functions import pages

HTML = """<!doctype html><html><head><title>T &amp; U</title><style>p{}</style><script>var x="</p>"</script></head><body class='a  b'>
<div class="t x" id=one data-k="v w">A <b>B</b><div class="t">inner</div> tail</div></span><p>open<p>two<br/>lines<ul><li><a href="/x">one</a><li><a href="/y/z">two</a></ul>
<div class="ad">&eacute;t&eacute;&nbsp;x</div><img class="t" src=i><td><unknown-tag data-x>u</unknown-tag></body></html> after"""


def by_hand(html, parts):
    """Texts that a selector finds, by going up from each node."""
    nodes = pages.nodes_of(html)
    up = lambda n: [] if n[4] < 0 else [nodes[n[4]], *up(nodes[n[4]])]

    def holds(n, tag, tests):
        if n[0] == "#text" or tag and n[0] != tag:
            return False
        return all(k in n[1] and (op == "" or op == "=" and n[1][k] == v or op == "~=" and v in n[1][k].split() or op == "^=" and n[1][k].startswith(v)) for k, op, v in tests)

    def found(n, i):
        child, tag, tests = parts[i]
        if not holds(n, tag, tests):
            return False
        return i == 0 or any(found(u, i - 1) for u in (up(n)[:1] if child else up(n)))

    inside = lambda n: " ".join(m[5] for m in nodes if m[0] == "#text" and n in up(m))
    return [inside(n) for n in nodes if found(n, len(parts) - 1)]


SELECTORS = ["div.t", "div", "body div.t", "div > div.t", "ul > li a", "li", "#one", "[data-k~=w]", "[data-k='v w'] b", "a[href^='/y']", "p", "*", "ul li > a", "div.ad", "unknown-tag[data-x]", "body > div", "nothing", ".a.b > p"]


def test_selectors_equal_a_walk_over_the_nodes(spark):
    rng = random.Random(3)
    made = [HTML, "", "plain", "<div><div><div class=t>x</div></div>y"]
    for _ in range(30):
        made.append("".join(rng.choice(["<div class=t>", "<div>", "</div>", "<p>", "</p>", "<ul><li>", "</ul>", "<a href='/y'>", "</a>", "w ", "<br>", "<body class='a b'>", "</b>", "<b>"]) for _ in range(rng.randint(1, 40))))
    df = spark.createDataFrame([(i, h) for i, h in enumerate(made)] + [(99, None)], "i int, h string").withColumn("n", pages.tree(F.col("h")))
    got = df.select("i", *(F.transform(pages.matches(F.col("n"), s), lambda m: pages.text_of(F.col("n"), m)).alias(f"s{k}") for k, s in enumerate(SELECTORS))).collect()
    for r in got:
        for k, s in enumerate(SELECTORS):
            if r.i == 99:
                assert r[f"s{k}"] is None
            else:
                assert r[f"s{k}"] == by_hand(made[r.i], pages.selector(s)), (made[r.i], s)


def test_texts(spark):
    df = spark.createDataFrame([(HTML,)], "h string").withColumn("n", pages.tree(F.col("h")))
    first = lambda *s: pages.select_first(F.col("n"), *s)
    r = df.select(first("div.t").alias("a"), first("div..t", "div.none", "li").alias("b"), pages.select_all(F.col("n"), "none", "div.t").alias("c"), first("title").alias("d"), first("script").alias("e"), first("div.ad").alias("f")).first()
    assert tuple(r) == ("A B inner tail", "one two", ["A B inner tail", "inner"], "T & U", "", "été x")
    for bad in ("", "> a", "a:not(b)", "div..x", "a, b", "a >", "[x"):
        with pytest.raises(ValueError):
            pages.selector(bad)


def test_intervals_nest(spark):
    for html in (HTML, "<a><b></a></b><i>", "</a>x<p"):
        nodes = pages.nodes_of(html)
        assert [n[2] for n in nodes] == list(range(len(nodes)))
        for n in nodes:
            assert n[3] >= n[2] and (n[4] < 0 or nodes[n[4]][2] < n[2] <= n[3] <= nodes[n[4]][3])


def test_texts_as_written(spark):
    n = pages.tree(F.col("h"), decoded=False)
    df = spark.createDataFrame([('<div class="a&amp;b" id="&quot;">x &amp; <b> &quot;y&amp</b></div><title>&lt;t</title>',), (None,)], "h string").withColumn("n", n)
    r, none = df.select("n", pages.select_first(F.col("n"), "b").alias("b"), pages.select_first(F.col("n"), "title").alias("t")).collect()
    assert (r.b, r.t, r.n[0].attributes) == (" &quot;y&amp", "&lt;t", {"class": "a&amp;b", "id": "&quot;"}) and none.n is None
