"""Every registered feed query against its SQL at the smallest scale, and what the queries don't reach."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import feedloom.queries as registered
from feedloom import plans, streaming
from feedloom.functions import chain, predicate, text, venue
from feedloom.operators import combine, enrich
from feedloom.sources import ics

SF = os.environ.get("FEEDLOOM_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents pages conversations labels".split()


def _plain(v):
    return round(v, 6) if isinstance(v, float) else v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(registered.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = registered.QUERIES[name](spark, SF)
    got = sorted((tuple(_plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=str)
    rel = duck.sql(registered.ORACLES[name])
    names = rel.columns
    want = sorted((tuple(_plain(r[names.index(c)]) for c in sorted(names)) for r in rel.fetchall()), key=str)
    assert sorted(names) == sorted(df.columns) and got == want


def _rows_and_sql(spark, tmp_path, name, table, rows, schema):
    """The rows of a query over one small table, and what its SQL gives there."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.sql(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
    want = con.sql(registered.ORACLES[name])
    return sorted(map(tuple, registered.QUERIES[name](spark, str(tmp_path)).select(*want.columns).collect()), key=str), sorted(want.fetchall(), key=str)


PAGE = "<html><head><style>p{{}}</style><script>var t=\"</p>\";</script></head><body><nav><ul>{}</ul></nav><article><h1>{}</h1><p>x</p></article><div class=\"ad\">{}</div></body></html>"


def test_page_selected_decodes_what_its_sql_does(spark, tmp_path):
    link = '<li><a href="/x">{}</a></li>'
    rows = [
        (1, PAGE.format(link.format("a"), "token = &quot;5a&quot;", "&copy; ad")),
        (2, PAGE.format(link.format("a") + link.format(" a ") + link.format("") + link.format("b&amp;c") + link.format("b&c"), "the&amp;&amp;&amp", " a&nbsp;&nbsp;b\n c ")),
        (3, PAGE.format("", "a &amp;amp; b &amp;nbsp; c&#38; &", "no\u00a0break")),
        (4, PAGE.format(link.format("&nbsp;") + link.format("d &nbsp; e"), " ", "")),
    ]
    got, want = _rows_and_sql(spark, tmp_path, "page_selected", "pages", rows, "page_id long, html string")
    assert got == want and got[0][1] == "token = &quot;5a&quot;" and got[1][1] == "the&&&amp"


LINES = ["Der berßer, mit schtepf,&&& äß", "Ann Lee,  University of X", "Keit,MIT!! ER", "Bo mit Cy, Di", " a , \u00a0MIT ", "Ann Lee, ETH\nmore"]
DOCUMENTS = [(len(LINES) * k + i, x, lang, f"src{k}", len(x) * 20) for k, lang in enumerate(["de", "en", "fr"]) for i, x in enumerate(LINES)]
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def test_listing_items_names_speakers_as_its_sql_does(spark, tmp_path):
    got, want = _rows_and_sql(spark, tmp_path, "listing_items", "documents", DOCUMENTS, DOCUMENT)
    assert got == want and {"Ann Lee, University of X", "Keit,MIT!! ER", "a , MIT"} <= {r[6] for r in got}


def test_feed_transform_gives_speakers_as_its_sql_does(spark, tmp_path):
    got, want = _rows_and_sql(spark, tmp_path, "feed_transform", "documents", DOCUMENTS, DOCUMENT)
    assert got == want and {"Ann Lee, University of X", "Keit,MIT!! ER", "a , MIT"} <= {r[4] for r in got}


def test_entities_decodes_what_its_sql_does(spark, tmp_path):
    rows = [(1, "<title>token = &quot</title>"), (2, "&amp;amp;quot; &ampx &amp &am &AMP; &quot;&copy;&middot;"), (3, "a\u00a0b&nbsp;c &lt;p&gt; &#38; &eacute;"), (4, None), (5, "")]
    got, want = _rows_and_sql(spark, tmp_path, "entities", "pages", rows, "page_id long, html string")
    assert got == want and got[0][1] == "<title>token = &quot</title>"


def test_run_counts_placeholders_as_its_sql_does(spark, tmp_path):
    more = [(100 + i, x, lang, f"src{i % 4}", n) for i, (x, lang, n) in enumerate((x, lang, n) for x in ("", " \n second", "\u00a0\nmore", "TBA", "To be announced\n.", "Aa bb n/a") for lang in ("de", "es", None) for n in (9, 900))]
    got, want = _rows_and_sql(spark, tmp_path, "run_counts", "documents", DOCUMENTS + more, DOCUMENT)
    assert got == want


def test_registry_listing_rounds_halves_to_even(spark, tmp_path):
    rows = [(i, f"S{i}", 1, x) for i, x in enumerate((-12.5, -13.5, -0.5, -0.3, -1.49, 0.0, 7.5))]
    spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    con = duckdb.connect()
    con.sql(f"create view supplier as select * from '{tmp_path}/supplier.parquet/*.parquet'")
    got = sorted(map(tuple, registered.QUERIES["registry_listing"](spark, str(tmp_path)).select("source", "said").collect()))
    assert got == sorted(con.sql(f"select source, said from ({registered.ORACLES['registry_listing']})").fetchall())
    assert got[:2] == [("s0", "Owes 12."), ("s1", "Owes 14.")]


def test_refusals(spark):
    df = spark.createDataFrame([("a", "b")], "id string, title string")
    with pytest.raises(ValueError):
        predicate.compiled({"nothing": {"equals": "x"}}, df)
    with pytest.raises(ValueError):
        predicate.compiled({"title": {"like": "x"}}, df)
    with pytest.raises(ValueError):
        combine.merged(df, {"id": F.col("id")}, {"t": F.col("title")}, ["id"])
    with pytest.raises(ValueError):
        venue.validate(("whole", "sentinel"))
    with pytest.raises(ValueError):
        venue.validate(("unambiguous_room", "comma_room", "whole"))
    for bad in ("(a+)+", r"(?<=x)y", r"(a)\1", "x" * 401):
        with pytest.raises(ValueError):
            chain.lint(bad)


def test_ics_fields(spark):
    body = "BEGIN:VCALENDAR\r\nPRODID:-//a//b\r\nBEGIN:VEVENT\r\nUID:1\r\nDTSTART;TZID=Europe/Rome:20260101T100000\r\nSUMMARY:a long li\r\n ne\\nnext\r\nnonsense\r\nCATEGORIES:x\\,y,z\r\nCATEGORIES: w\r\nLOCATION:first\r\nLOCATION:last\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n"
    df = spark.createDataFrame([("s", body)], "source string, text string")
    r = ics.records(df).first()
    assert (r.uid, r.summary, r.location, r.categories, r.dtstart, r.dtstart_params) == ("1", "a long line\nnext", "last", ["x,y", "z", "w"], "20260101T100000", "TZID=Europe/Rome")
    assert r.properties["UID"] == "1" and df.select(ics.prodid(F.col("text"))).first()[0] == "-//a//b"


def test_scrape_statuses(spark):
    rows = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u3"), (4, ""), (5, "u5"), (6, "u6")], "id long, url string")
    pages = spark.createDataFrame([("u1", 200, '<div class="t x">A <b>B</b></div>'), ("u1", 200, "again"), ("u2", 403, ""), ("u5", 200, "<p>none</p>"), ("u6", 200, '<div class="t">spam</div>')], "url string, code int, body string")
    got = {r.id: (r.status, r.value) for r in enrich.scraped(rows, pages.filter("body <> 'again'"), "url", enrich.select_first(F.col("body"), "t"), "spam").collect()}
    assert got == {1: ("filled", "A B"), 2: ("http_error", ""), 3: ("network_error", ""), 4: ("no_url", ""), 5: ("selector_miss", ""), 6: ("rejected", "")}


def test_last_good(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2)], "source string, n int")
    old = spark.createDataFrame([("a", 9), ("b", 8)], "source string, n int")
    failed = spark.createDataFrame([("b",)], "source string")
    assert sorted(map(tuple, plans.with_last_good(new, old, failed).collect())) == [("a", 1), ("b", 8)]


def test_stream_keeps_the_newest(spark, tmp_path):
    schema = "id long, at long, v string"
    for k, rows in enumerate([[(1, 1, "a"), (2, 1, "b")], [(1, 2, "c"), (2, 0, "late")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).json(f"{tmp_path}/in")
        q = streaming.publish(stream, f"{tmp_path}/out", ["id"], F.col("at"), f"{tmp_path}/check")
        assert q.awaitTermination(60), k
    last = streaming.latest(spark, f"{tmp_path}/out", spark.createDataFrame([], schema).schema)
    assert sorted(map(tuple, last.collect())) == [(1, 2, "c"), (2, 1, "b")]


def test_merge_plan_has_one_exchange_and_no_python(spark):
    d = registered.QUERIES["combine_merge"](spark, SF)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_compare_form(spark):
    df = spark.createDataFrame([("Winds, Waves — and  Wakes", "winds,  waves - and wakes"), ("a​b", "AB")], "a string, b string")
    assert df.filter(text.compare_form(F.col("a")) == text.compare_form(F.col("b"))).count() == 2


def test_calendar_lines_are_folded(spark):
    from pyspark.sql import functions as F

    from feedloom.sources import ics

    at = F.timestamp_seconds(F.lit(0))
    for n in (0, 66, 67, 68, 141, 142, 300):
        df = spark.createDataFrame([("x" * n,)], "s string")
        text = df.select(ics.calendar(F.lit("u"), at, at, F.col("s"), F.lit(None).cast("string"), F.lit(None).cast("string"))).first()[0]
        assert text.endswith("END:VCALENDAR\r\n") and max(map(len, text.split("\r\n"))) <= 75 and "URL" not in text
        assert f"SUMMARY:{'x' * n}\r\n" in text.replace("\r\n ", "")


def test_load_time_refusals():
    """What a chain, a view or a target declares wrongly is refused before any plan is built."""
    from feedloom.plans import config

    one = {"id": "a", "when": {"matches": "p"}, "capture": {"x": "title"}}
    patterns = {"p": "(?P<x>a)", "q": "(?P<x>a)(?P<y>b)"}
    chain.validate([one], ("title",), patterns)
    for bad in (
        {"when": {"like": "x"}}, {"when": {"all": [{"in": "x"}]}}, {"when": {"contains": ["x"]}}, {"when": {"not": {"predicate": "none"}}}, {"when": {"any": []}}, {"when": {}},
        {"when": {"matches": "none"}}, {"when": {"matches": "q"}}, {"when": {"contains": "x"}}, {"capture": {"z": "title"}}, {"capture": {"x": "nothing"}},
    ):
        with pytest.raises(ValueError):
            chain.validate([one | bad], ("title",), patterns)
    registry = config.Registry({"a": {}, "b": {}}, alias={"f": "fpo"}, purposes={"web"})
    assert config.combos([{"name": "x", "include": ["*"], "exclude_where": {"tags": {"contains": "fpo"}}}], registry)[0].key == ("starts_at", "title")
    for bad in ({"include": ["c"]}, {"include": ["a"], "key": ["guid"]}, {"include": ["a"], "key": []}, {"include": ["a"], "where": {"tags": {"in": ["none"]}}}, {"include": ["a"], "enabled": False}, {"include": ["a"], "odd": 1}):
        with pytest.raises(ValueError):
            config.combos([{"name": "x", **bad}], registry)
    for bad in ({"selectors": ["a"]}, {"field": "title"}, {"field": "title", "selectors": ["a"], "odd": 1}):
        with pytest.raises(ValueError):
            config.Registry({"a": {"enrich": [bad]}})


def test_capture_without_a_match_fails_its_source(spark):
    df = spark.createDataFrame([("Ann Lee",), ("x",)], "s string")
    r = chain.applied(F.col("s"), [{"id": "a", "when": {"starts_with": "ann"}, "assign": {"title": "summary"}}], ("title",), {}, on_no_match="fail")
    assert [x.r.rule_id for x in df.select(r.alias("r")).collect()] == ["a", None]


def test_exclude_where_and_eight_fields(spark):
    """Events that differ in one of the eight compared fields stay apart; what isn't compared doesn't matter."""
    base = {"id": "a:1", "source": "a", "sources": ["a"], "purposes": ["web"], "tags": ["x"], "starts_at": "s", "ends_at": "e", "title": "Winds – Waves", "speaker": "Ann", "series": "S", "location": ("Hall", "1"), "url": "u", "content": "c", "bio": ""}
    rows = [base, base | {"id": "b:2", "source": "b", "sources": ["b"], "title": "winds  - waves", "purposes": ["news"], "bio": "other"}]
    for i, change in enumerate(({"ends_at": "f"}, {"speaker": "Bo"}, {"series": "T"}, {"location": ("Hall", "2")}, {"url": "v"}, {"content": "d"})):
        rows.append(base | {"id": f"c:{i}", "source": "c", "sources": ["c"]} | change)
    rows.append(base | {"id": "d:1", "source": "d", "sources": ["d"], "tags": ["fpo"]})
    schema = "id string, source string, sources array<string>, purposes array<string>, tags array<string>, starts_at string, ends_at string, title string, speaker string, series string, location struct<name:string,detail:string>, url string, content string, bio string"
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    chosen = combine.chosen(df, exclude_where={"tags": {"contains": "fpo"}})
    out = {r.id: r for r in combine.merged(chosen, combine.keyed(["starts_at", "title"]), combine.details(), ["id"], sets=("sources", "purposes")).collect()}
    assert sorted(out) == ["a:1", *(f"c:{i}" for i in range(6))] and out["a:1"].sources == ["a", "b"] and out["a:1"].purposes == ["news", "web"] and out["a:1"].n == 2
    apart = combine.divergences(chosen, combine.keyed(["starts_at", "title"]), combine.details()).collect()
    assert len(apart) == 1 and apart[0].differing == ["ends_at", "speaker", "series", "location", "url", "content"] and len(apart[0].ids) == 8
