"""Configuration, fetching, the run and its files."""

import json

import pytest
from pyspark.sql import functions as F

from feedloom.__main__ import main
from feedloom.functions import tags, text
from feedloom.operators import edition, enrich, health
from feedloom.plans import config, publish, run
from feedloom.sources import fetch, rss


def test_layers_and_closed_keys(tmp_path):
    assert config.layered({"a": {"x": 1, "y": [1]}, "b": 2}, {"a": {"y": [3], "z": 4}, "b": None}) == {"a": {"x": 1, "y": [3], "z": 4}}
    (tmp_path / "c.yaml").write_text("sources: {}\nodd: 1\n")
    with pytest.raises(ValueError):
        config.read(tmp_path / "c.yaml", {"sources"})
    (tmp_path / "c.yaml").write_text("a: [")
    with pytest.raises(ValueError):
        config.read(tmp_path / "c.yaml", {"a"}, required=False)
    assert config.read(tmp_path / "none.yaml", set(), required=False) == {}
    assert config.fingerprint({"b": 1, "a": 2}) == config.fingerprint({"a": 2, "b": 1})


def test_registry_refuses_what_nobody_declared():
    for bad in ({"platform": "atom"}, {"purposes": ["none"]}, {"rolle": "title"}, {"publish_where": {"title": {"like": "x"}}}, {"venues": ["whole", "sentinel"]}):
        with pytest.raises(ValueError):
            config.Registry({"a": bad}, purposes={"web"})
    with pytest.raises(ValueError):
        config.Registry({"a": {"feed_url": "u"}, "b": {"feed_url": "u"}})
    with pytest.raises(ValueError):
        tags.aliases({"a": ["x"], "b": ["X"]})
    with pytest.raises(ValueError):
        config.Templates({"day": 1}, {"day": {"default": True}, "inline": {}})
    assert [s.slug for s in config.Registry({"a": None, "b": {"status": "unavailable"}}).live] == ["a"]


def test_fetch_retries_only_what_may_pass():
    calls, pauses = [], []

    def transport(answers):
        it = iter(answers)

        def f(url, headers):
            calls.append(headers)
            code = next(it)
            if code is None:
                raise OSError
            return code, {"ETag": "e"}, b"body"

        return f

    for answers, want in (([200], "ok"), ([500, 200], "ok"), ([None, None, 200], "ok"), ([403, 200], "http_error"), ([304], "not_modified"), ([None] * 3, "network_error"), ([503] * 3, "http_error")):
        assert fetch.fetched("u", {}, transport(answers), sleep=pauses.append)[0] == want, answers
    assert pauses[:1] == [0.5] and max(pauses) == 1.0
    assert fetch.conditions(True, "e", "m", {"If-None-Match": "own"}) == {"If-None-Match": "own", "If-Modified-Since": "m"}
    assert fetch.conditions(False, "e", "m", {}) == {}


def test_captures(spark, tmp_path):
    (tmp_path / "f.ics").write_text("BEGIN:VCALENDAR")
    rows = [("a", f"file://{tmp_path}/f.ics", False, "", "", None), ("b", f"file://{tmp_path}/f.ics", False, None, None, {}), ("c", "file:///nowhere/x", False, "", "", None)]
    df = spark.createDataFrame(rows, "source string, url string, captured boolean, etag string, last_modified string, headers map<string,string>")
    got = {r.source: (r.outcome, r.body) for r in fetch.captures(df, retries=0).collect()}
    assert got == {"a": ("ok", "BEGIN:VCALENDAR"), "b": ("ok", "BEGIN:VCALENDAR"), "c": ("network_error", None)}


_ICS = "BEGIN:VCALENDAR\r\nPRODID:x\r\n{}END:VCALENDAR\r\n"
_ONE = "BEGIN:VEVENT\r\nUID:{}\r\nDTSTART{}\r\nSUMMARY:{}\r\nLOCATION:Hall 12\r\nCATEGORIES:Talks\r\nURL:http://u/1\r\nEND:VEVENT\r\n"


def test_a_run_from_feeds_to_files(spark, tmp_path):
    feeds = tmp_path / "feeds"
    feeds.mkdir()
    (feeds / "good.txt").write_text(_ICS.format(_ONE.format(2, ":20260102T100000Z", "Café &amp; more") + _ONE.format(1, ";TZID=Europe/Rome:20260101T100000", "TBD")), newline="")
    (feeds / "bad.txt").write_text(_ICS.format(_ONE.format(1, ";TZID=Nowhere/City:20260101T100000", "x")), newline="")
    (feeds / "none.txt").write_text(_ICS.format(""), newline="")
    (tmp_path / "r.yaml").write_text("purposes: [web]\ndefaults: {purposes: [web]}\nsources:\n  good: {label: Good}\n  bad: {}\n  none: {}\n  gone: {status: unavailable, reason: 'No feed. None.'}\n")
    args = ["--registry", str(tmp_path / "r.yaml"), "--feeds", str(feeds), "--out", f"file://{tmp_path}/out", "--at", "2026-01-03T00:00:00Z"]
    assert main(["publish", *args], spark) == 4
    good = json.loads((tmp_path / "out/feeds/good/events.json").read_text())
    assert [(e["id"], e["startsAt"], e["title"], e["titleIsPlaceholder"]) for e in good] == [("good:1", "2026-01-01T09:00:00Z", "A Talks Talk", True), ("good:2", "2026-01-02T10:00:00Z", "Café & more", False)]
    assert list(good[0]) == list(publish.WIRE) and "\\u00e9" in (tmp_path / "out/feeds/good/events.json").read_text()
    status = json.loads((tmp_path / "out/status.json").read_text())
    assert {f["path"].split("/")[1]: f["status"] for f in status["feeds"]} == {"good": "ok", "bad": "failed", "none": "empty", "gone": "disabled"}
    assert status["summary"] == {"disabled": 1, "empty": 1, "failed": 1, "ok": 1, "events": 2, "stale": 0}
    assert "timezone Nowhere/City is not known" in (tmp_path / "out/summary.md").read_text()
    before = (tmp_path / "out/feeds/good/events.json").read_bytes()
    assert main(["publish", *args, "--source", "good"], spark) == 0 and (tmp_path / "out/feeds/good/events.json").read_bytes() == before
    assert main(["build", "--registry", str(tmp_path / "r.yaml")], spark) == 2 and main(["check", "--registry", str(tmp_path / "no.yaml")], spark) == 3
    assert main(["sources", *args], spark) == 0 and main(["publish", *args, "--source", "gone"], spark) == 3
    back = publish.read_manifest(spark, f"file://{tmp_path}/out/status.json")
    assert back.count() == 4 and publish.read_manifest(spark, f"file://{tmp_path}/none.json").count() == 0
    (tmp_path / "broken.json").write_text("{")
    assert publish.read_state(spark, f"file://{tmp_path}/broken.json").count() == 0


def test_rss_namespace_properties_and_errors(spark):
    item = '<rss xmlns:ev="http://n" xmlns:o="http://other"><channel><item><title>T</title><link>l</link><ev:date>{}</ev:date><ev:kind> Talk </ev:kind><o:location>no</o:location><ev:location>Hall</ev:location></item></channel></rss>'
    df = spark.createDataFrame([("a", item.format("Thursday, October 8, 2026 - 16:15")), ("b", item.format("Friday, October 8, 2026 - 16:15"))], "source string, text string")
    got = {r.source: r for r in rss.records(df, uri="http://n").collect()}
    assert got["a"].location == "Hall" and got["a"].properties["kind"] == "Talk" and got["a"].error is None
    assert got["b"].error == "cannot read Friday, October 8, 2026 - 16:15"


def test_enrichment_writes_what_it_may(spark):
    df = spark.createDataFrame([("1", "", "", False, [("F", "")]), ("2", "Own", "ics", False, [])], "guid string, title string, title_source string, title_is_placeholder boolean, speakers array<struct<name:string,affiliation:string>>")
    got = df.withColumns(enrich.applied("title", F.lit("New")) | enrich.applied("speakers", F.array(F.lit("Ann Lee, Yale University")), split=True)).collect()
    assert [(r.title, r.title_source) for r in got] == [("New", "enriched"), ("Own", "ics")]
    assert [r.speakers[0].name for r in got] == ["F", "Ann Lee"] and got[1].speakers[0].affiliation == "Yale University"
    html = spark.createDataFrame([('<div class="a">x</div><div class="b">y</div><div class="b q">z</div><div class="b">y</div>',)], "h string")
    assert html.select(enrich.select_all(F.col("h"), "none", "b", "a")).first()[0] == ["y", "z"]


def test_small_views(spark):
    docs = spark.createDataFrame([('{"workflows": [{"name": "n", "path": "p", "state": "active"}]}',), ("{",)], "j string")
    assert [tuple(r) for r in health.workflow_states(docs, "j").collect()] == [("n", "p", "active")]
    page = spark.createDataFrame([("<a>status.json</a>",), (None,)], "h string")
    assert sorted(r.finding for r in health.page_check(page, "h", ["status.json"]).collect()) == ["fail", "ok"]
    one = spark.createDataFrame([("2026-09-10",)], "d string").select(F.col("d").cast("date").alias("d"))
    with pytest.raises(Exception, match="ends before"):
        one.select(edition.resolved(F.col("d"), ("publication", 0), ("week_start", -7), 0)["coverage_end"]).collect()
    assert one.select(text.cell(F.lit("a | b\nc" + "x" * 200))).first()[0].startswith("a \\| b c")


def test_state_document(spark):
    rows = [("b", "e", "", ""), ("a", "", "m", "t"), ("c", "", "", "")]
    df = spark.createDataFrame(rows, publish.STATE)
    assert json.loads(publish.state_document(df, "now"))["sources"] == {"a": {"lastModified": "m", "lastEnrichedAt": "t"}, "b": {"etag": "e"}}


def test_last_good_is_served(spark, tmp_path):
    registry = config.Registry({"a": {}})
    feeds = spark.createDataFrame([("a", _ICS.format(_ONE.format(1, ":20260101T100000Z", "Fine")))], "source string, text string")
    good = run.built(registry, feeds)
    broken = run.built(registry, feeds.withColumn("text", F.replace("text", F.lit("UID:1"), F.lit("UID:"))))
    run.published(spark, registry, broken, f"file://{tmp_path}", "2026-01-03T00:00:00Z", previous=good.events)
    status = json.loads((tmp_path / "status.json").read_text())["feeds"][0]
    assert status["stale"] and status["events"] == 1 and status["status"] == "failed" and "no UID" in status["detail"]


def _tree(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in sorted(root.rglob("*.json")) if p.name == "events.json"}


def _status(root):
    return {f["path"]: f for f in json.loads((root / "status.json").read_text())["feeds"]}


def test_failed_and_unasked_sources_keep_their_feeds(spark, tmp_path):
    """A broken feed, one that lost most of its events and one that wasn't asked: files and last successes stay."""
    feeds, out = tmp_path / "feeds", tmp_path / "out"
    feeds.mkdir()
    many = "".join(_ONE.format(i, f":2026010{i}T100000Z", f"Talk {i}") for i in range(1, 7))
    for name in ("a", "b", "c"):
        (feeds / f"{name}.txt").write_text(_ICS.format(many), newline="")
    (tmp_path / "r.yaml").write_text("defaults: {escape: [title]}\nsources:\n  a: {}\n  b: {page_size: 6}\n  c: {publish_unless: {title: {contains: '6'}}}\n  d: {}\n")
    (tmp_path / "c.yaml").write_text("combos:\n  - {name: all, include: ['*'], exclude: [c]}\n  - {name: later, include: [a], enabled: false, reason: 'No tag.'}\n")
    args = ["publish", "--registry", str(tmp_path / "r.yaml"), "--combos", str(tmp_path / "c.yaml"), "--feeds", str(feeds), "--out", f"file://{out}"]
    assert main([*args, "--at", "2026-01-03T00:00:00Z"], spark) == 0
    first, status = _tree(out), _status(out)
    assert status["feeds/d/events.json"]["status"] == "failed" and "Never published" in status["feeds/d/events.json"]["detail"] and not (out / "feeds/d").exists()
    assert "complete only up to the last start it lists (2026-01-06 10:00 local)" in status["feeds/b/events.json"]["notes"][0]
    assert status["feeds/c/events.json"]["notes"] == ["declined: 1 event(s) present in the upstream feed are deliberately not published here, per this source's publish_unless (title contains '6').", "unmapped_tags: 5"] and status["feeds/c/events.json"]["events"] == 5
    every = json.loads(first["combos/all/events.json"])
    assert [e["sources"] for e in every] == [["a", "b"]] * 6 and status["combos/all/events.json"]["sources"] == ["a", "b", "d"] and status["combos/later/events.json"]["status"] == "disabled"
    assert status["combos/all/events.json"]["notes"][0].startswith("6 event(s) were published by more than one source")

    (feeds / "a.txt").write_text(_ICS.format(_ONE.format(1, ":20260101T100000Z", "Talk 1")), newline="")  # five of six vanished
    (feeds / "b.txt").write_text(_ICS.format(many.replace("UID:2", "UID:")), newline="")
    assert main([*args, "--at", "2026-01-04T00:00:00Z"], spark) == 4
    second, status = _tree(out), _status(out)
    assert {k: v for k, v in second.items() if k.startswith("feeds/")} == {k: v for k, v in first.items() if k.startswith("feeds/")}
    assert second["combos/all/events.json"] == first["combos/all/events.json"] and status["combos/all/events.json"]["stale"] and "the last good copy of a" in status["combos/all/events.json"]["detail"]
    a, b, c = (status[f"feeds/{x}/events.json"] for x in "abc")
    assert (a["status"], a["stale"], a["events"], a["lastSuccessAt"]) == ("failed", True, 6, "2026-01-03T00:00:00Z") and "5 of 6 events disappeared" in a["detail"]
    assert b["stale"] and "no UID" in b["detail"] and c["lastSuccessAt"] == "2026-01-04T00:00:00Z"

    assert main([*args, "--at", "2026-01-05T00:00:00Z", "--source", "a", "--allow-large-diff"], spark) == 0
    third, status = _tree(out), _status(out)
    assert len(json.loads(third["feeds/a/events.json"])) == 1 and third["feeds/b/events.json"] == first["feeds/b/events.json"] and third["feeds/c/events.json"] == first["feeds/c/events.json"]
    assert status["feeds/b/events.json"]["stale"] and status["feeds/c/events.json"]["lastSuccessAt"] == "2026-01-04T00:00:00Z" and status["feeds/a/events.json"]["status"] == "ok"
    assert len(json.loads(third["combos/all/events.json"])) == 6


def test_fetch_and_pages(spark, tmp_path):
    """Feeds and pages by a counting transport: validators, cadence, windows, new events within a window."""
    log = tmp_path / "log"
    event = "BEGIN:VEVENT\r\nUID:{0}\r\nDTSTART:20260101T100000Z\r\nSUMMARY:TBD\r\nLOCATION:Hall 12\r\nCATEGORIES:Talks\r\nURL:http://p/{0}\r\nEND:VEVENT\r\n"
    (tmp_path / "n").write_text("2")

    def transport(url, headers):
        with open(log, "a") as f:
            f.write(url + "\n")
        if url.startswith("http://p/"):
            return (403, {}, b"") if url.endswith("9") else (200, {}, f"<body><div class='top t'><b>On</b> {url[-1]}</div><div class=who>Ann Lee, Yale University</div><div class=who>Bo</div>".encode())
        if url == "http://bad/f":
            return 500, {}, b""
        n = int((tmp_path / "n").read_text())
        return (304, {}, b"") if headers.get("If-None-Match") == f"e{n}" else (200, {"ETag": f"e{n}"}, _ICS.format("".join(event.format(i) for i in range(n))).encode())

    target = "[{field: title, selectors: [div.none, body > div.t]}, {field: speakers, selectors: [div.who], split: true}, {field: raw_details, selectors: [body], reject: 'on 1'}]"
    (tmp_path / "r.yaml").write_text(f"sources:\n  a: {{feed_url: 'http://a/f', cadence: 2h, enrich: {target}}}\n  bad: {{feed_url: 'http://bad/f'}}\n")
    (tmp_path / "feeds").mkdir()
    args = ["publish", "--registry", str(tmp_path / "r.yaml"), "--feeds", f"file://{tmp_path}/feeds", "--out", f"file://{tmp_path}/out", "--fetch", "--enrich"]

    def publish_at(at, *more):
        log.write_text("")
        code = main([*args, "--at", at, *more], spark, lambda url, headers: transport(url, headers))
        return code, sorted(set(log.read_text().split())), len(log.read_text().split()), json.loads((tmp_path / "out/feeds/a/events.json").read_text())

    code, asked, calls, events = publish_at("2026-01-01T00:00:00Z")
    assert code == 4 and asked == ["http://a/f", "http://bad/f", "http://p/0", "http://p/1"] and calls == 6  # the failing one is tried three times
    assert [(e["title"], e["titleSource"], e["speaker"], e["rawEventDetails"]) for e in events] == [("On 0", "enriched", "Ann Lee, Yale University; Bo", "On 0 Ann Lee, Yale University Bo"), ("On 1", "enriched", "Ann Lee, Yale University; Bo", "")]
    assert json.loads((tmp_path / "out/state.json").read_text())["sources"]["a"] == {"etag": "e2", "lastEnrichedAt": "2026-01-01T00:00:00Z"}
    assert "HTTP 500" in _status(tmp_path / "out")["feeds/bad/events.json"]["detail"]
    (tmp_path / "n").write_text("3")
    code, asked, _, events = publish_at("2026-01-01T06:00:00Z")  # within the window: only the new event's page
    assert asked == ["http://a/f", "http://bad/f", "http://p/2"] and [e["title"] for e in events] == ["On 0", "On 1", "On 2"]
    code, asked, _, again = publish_at("2026-01-01T06:30:00Z")  # not due: the capture on disk
    assert asked == ["http://bad/f"] and again == events
