"""Shapes of text that the tables lack: rows, and what is expected of them."""

import pytest
from pyspark.sql import functions as F

from feedloom.functions import chain, display, text, timex, titles, venue
from feedloom.operators import health

CASES: dict = {}


def shape(columns: str, rows: list[tuple]):
    """rows: the input and what is expected of it."""

    def add(f):
        CASES[f.__name__] = (f, columns.split(", "), rows)
        return f

    return add


@shape("raw, name, detail, rule", [
    ("101 - Maple Hall", "Maple Hall", "101", "detail_dash_name"), ("North Quad J Wing/J223", "North Quad J Wing", "J223", "slash_room"),
    ("Birch Hall 222", "Birch Hall", "222", "unambiguous_room"), ("Birch Hall", "Birch Hall", "", "whole"), ("TBD", "", "", "sentinel"), (" n/a ", "", "", "sentinel"),
    ("Alder Hall, Room 216", "Alder Hall", "216", "comma_room"), ("E105 South-Bio", "South-Bio", "E105", "unambiguous_room"), ("South-Lab F212", "South-Lab", "F212", "unambiguous_room"),
    ("Cedar Hall (C112 + Atrium C102)", "Cedar Hall", "C112 + Atrium C102", "parenthetical"), ("", "", "", "declined"), ("Oak House - A01", "A01", "Oak House", "detail_dash_name"), ("Ash Hall, Suite 12", "Ash Hall", "12", "comma_room"), ("Ivy Court, Ste. B4", "Ivy Court", "B4", "comma_room"),
    ("101 202", "101 202", "", "whole"), ("Elm Hall, 002 Auditorium", "Elm Hall, 002 Auditorium", "", "whole"),
])
def venue_split(df):
    return df.select("raw", venue.parsed(F.col("raw")).alias("v")).select("raw", "v.name", "v.detail", "v.rule")


@shape("raw, article", [("university", "A"), ("FPO", "An"), ("S. S. Wills Lecture", "An"), ("honest talk", "An"), ("evening seminar", "An"), ("One World", "A"), ("talk", "A"), ("European day", "A"), ("", "A"), ("UFO", "A"), ("useful day", "A"), ("utter day", "An"), ("Ukrainian day", "A"), ("hour", "An"), ("house", "A")])
def article_choice(df):
    return df.select("raw", titles.article(F.col("raw")).alias("article"))


@shape("raw, title, title_source", [
    ("Energy,More|Ann Lee", "An Energy seminar by Ann Lee", "fallback-speaker"), ("Energy|", "An Energy seminar", "fallback-template"), ("Bridge|", "A Bridge seminar", "fallback-template"), ("Opera" + "x" * 130 + "|Ann Lee", "Ann Lee", "fallback-speaker"), ("Opera" + "x" * 130 + "|", "An Opera" + "x" * 130 + " Talk", "fallback-series"),
])
def title_fallback(df):
    part = lambda i: F.element_at(F.split("raw", r"\|"), i)
    return df.select("raw", titles.fallback("{a_an} {series} seminar by", part(1), part(2), F.lit("s")).alias("t")).select("raw", "t.title", "t.title_source")


@shape("raw, is_person", [("Ann Lee", True), ("Mary-Jane O'Neil Smith", True), ("Quantum Colloquium", False), ("Ann", False), ("ann lee", False), ("What is Life?", False), ("J. R. Smith", False), ("Ann van Berg", True), ("Bo Li *22", True), ("Ann O’Neil-Roy", True), ("Energy and Lee", False), ("The Long Talk", False)])
def person_name_shape(df):
    return df.select("raw", text.person_name_shape(F.col("raw"), ["the", "colloquium", "seminar", "talk", "quantum"]).alias("is_person"))


@shape("raw, name, affiliation", [("Ann Lee, Penn University", "Ann Lee", "Penn University"), ("Lee, Ann", "Lee, Ann", ""), ("Bo Li, Phys, MIT Lab", "Bo Li, Phys", "MIT Lab"), ("Solo", "Solo", ""), ("Ann Lee, MIT", "Ann Lee", "MIT"), ("X Y, Research Scientist", "X Y, Research Scientist", ""), ("Li *22, Yale University", "Li *22", "Yale University"), (", Yale University", ", Yale University", ""), ("Eva Roth, Universität Ulm", "Eva Roth", "Universität Ulm")])
def split_speaker(df):
    return df.select("raw", text.split_speaker(F.col("raw")).alias("s")).select("raw", "s.name", "s.affiliation")


PATTERNS = {"series_colon": r"(?P<series>[A-Z][A-Za-z ]+ (?:Colloquium|Seminar)): (?P<title>.+)", "dash": r"(?P<speaker>[A-Z][a-z]+ [A-Z][a-z]+) - (?P<title>.+)"}
RULES = [
    {"id": "series-colon", "when": {"matches": "series_colon"}, "capture": {"series": "series", "title": "title"}, "tag": ["talk"]},
    {"id": "dash", "when": {"matches": "dash"}, "capture": {"speaker": "speaker", "title": "title"}},
    {"id": "person", "when": {"all": [{"predicate": "person_name_shape"}, {"not": {"contains": "hall"}}]}, "assign": {"speaker": "summary"}},
    {"id": "defense", "when": {"any": [{"starts_with": "fpo"}, {"ends_with": "defense"}, {"in": ["exam", "quals"]}]}, "assign": {"title": "summary", "series": "Defense"}, "unresolved": True},
]


@shape("raw, rule_id, title, speaker, series, tags, unresolved", [
    ("Physics Colloquium: Time: a (short) history", "series-colon", "Time: a (short) history", "", "Physics Colloquium", "talk", ""),
    ("Math Seminar: TBD", "series-colon", "", "", "Math Seminar", "talk", ""), ("Ann Lee - On Graphs", "dash", "On Graphs", "Ann Lee", "", "", ""),
    ("  Ann   Lee ", "person", "", "Ann Lee", "", "", ""), ("FPO of Bo", "defense", "FPO of Bo", "", "Defense", "", "FPO of Bo"), ("Quals", "defense", "Quals", "", "Defense", "", "Quals"),
    ("an open day", "no-match-title", "an open day", "", "", "", ""),
])
def rule_chain(df):
    r = chain.applied(F.col("raw"), RULES, ("title", "speaker", "series"), PATTERNS)
    return df.select("raw", r.alias("r")).select("raw", "r.rule_id", "r.title", "r.speaker", "r.series", F.array_join("r.tags", ",").alias("tags"), "r.unresolved")


@shape("raw, rules, n", [("x", "dash,no-match-title,person", 3)])
def rule_chain_distribution(df):
    rows = df.select(F.explode(F.array(*(F.lit(x) for x in ("Ann Lee - On Graphs", "Ann Lee", "an open day", "Bo Li")))).alias("s"))
    got = rows.select(chain.applied(F.col("s"), RULES, ("title", "speaker", "series"), PATTERNS)["rule_id"].alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))
    return got.agg(F.array_join(F.array_sort(F.collect_list("rule")), ",").alias("rules"), F.count("*").cast("int").alias("n")).select(F.lit("x").alias("raw"), "rules", "n")


@shape("raw, canonical, unmapped", [("Talks Fall 2026|Physics|Odd Thing", "physics,talk", "Odd Thing"), ("physics colloquia|PHYSICS", "physics", ""), ("", "", "")])
def tags_normalize(df):
    alias = {"talks": "talk", "talk": "talk", "physics": "physics", "physics colloquia": "physics"}
    names = F.create_map(*(F.lit(x) for kv in alias.items() for x in kv))
    cats = F.filter(F.split("raw", r"\|"), lambda x: x != "")
    tags = F.array_sort(F.array_distinct(F.filter(F.transform(cats, lambda c: F.try_element_at(names, text.tag_key(c))), lambda x: x.isNotNull())))
    rest = F.filter(F.transform(cats, lambda c: F.trim(c)), lambda c: F.try_element_at(names, text.tag_key(c)).isNull())
    return df.select("raw", F.array_join(tags, ",").alias("canonical"), F.array_join(rest, ",").alias("unmapped"))


@shape("raw, decoded", [("a &amp; b", "a & b"), ("a &amp;gt; b", "a &gt; b"), ("no&nbsp;break\xa0here", "no break here"), ("plain", "plain"), ("&eacute;t&#233; &unknown; &", "été &unknown; &")])
def entities(df):
    return df.select("raw", text.decode_entities(F.col("raw")).alias("decoded"))


@shape("raw, form", [("Cafe\u0301 Stra\u00dfe", "caf\u00e9 strasse"), ("CAF\u00c9  STRASSE", "caf\u00e9 strasse"), ("\u1ec7 e\u0323\u0302", "\u1ec7 \u1ec7"), ("\u03a3\u03c2", "\u03c3\u03c3"), ("\ufb01n", "fin"), ("a\u200bb \u2014 \u201cc\u201d", 'ab - "c"')])
def compare_shapes(df):
    return df.select("raw", text.compare_form(F.col("raw")).alias("form"))


@shape("raw, line", [("2026-09-28T16:30:00|2026-09-28T18:00:00|Hall 306", "4:30 — 6 p.m. Monday, Sept. 28, in Hall 306"), ("2026-10-03T00:00:00|2026-10-04T00:00:00|", "All day Saturday, Oct. 3, location TBA"), ("2026-10-03T11:00:00|2026-10-03T12:00:00|x", "11 a.m. — 12 p.m. Saturday, Oct. 3, in x")])
def when_and_where(df):
    part = lambda i: F.element_at(F.split("raw", r"\|"), i)
    at = lambda i: part(i).cast("timestamp_ntz")
    return df.select("raw", display.when_and_where(at(1), at(2), part(3)).alias("line"))


@shape("raw, hours", [("-1", "the last commit is dated 1.0 days ahead"), ("3", "last commit 3.0 days ago, inside the 35-day threshold"), ("40", "last commit 40.0 days ago, past the 35-day threshold and 20.0 days from the schedules being disabled"), ("61", "last commit 61.0 days ago, past GitHub's 60-day limit — the scheduled workflows have most likely already been disabled")])
def keepalive(df):
    return df.select("raw", health.keepalive(F.col("raw").cast("double"))["reason"].alias("hours"))


@shape("raw, reason", [("45.15", "last commit 45.1 days ago, past the 35-day threshold and 14.9 days from the schedules being disabled"), ("-23.25", "the last commit is dated 23.2 days ahead"), ("0.35", "last commit 0.3 days ago, inside the 35-day threshold")])
def keepalive_rounding(df):
    return df.select("raw", health.keepalive(F.col("raw").cast("double"))["reason"].alias("reason"))


@shape("raw, ago", [("0", "less than a minute ago"), ("1", "1 minute ago"), ("89", "89 minutes ago"), ("90", "2 hours ago"), ("150", "3 hours ago")])
def minutes_ago(df):
    return df.select("raw", timex.ago(F.col("raw").cast("int")).alias("ago"))


@shape("raw, minutes", [("30m", 30), ("2h", 120), ("1d", 1440), ("soon", 60), ("", 60)])
def cadence_parse(df):
    return df.select("raw", timex.cadence_minutes(F.col("raw")).cast("int").alias("minutes"))


@shape("raw, escaped, back, collapsed", [("a, b; c", "a\\, b\\; c", "a, b; c", "a, b; c"), ("x\\, y", "x\\, y", "x, y", "x\\, y"), (" p  q\t", " p  q\t", " p  q\t", "p q")])
def escapes(df):
    return df.select("raw", text.escape(F.col("raw")).alias("escaped"), text.unescape(text.escape(F.col("raw"))).alias("back"), text.collapse(F.col("raw")).alias("collapsed"))


@shape("raw, value", [("a\\, b\\; c\\nd", "a, b; c\nd"), ("back\\\\nslash", "back\\nslash"), ("odd\\x", "odd\\x"), ("N\\Nn", "N\nn")])
def ics_text(df):
    return df.select("raw", text.ics_unescape(F.col("raw")).alias("value"))


@shape("raw, instant", [("20260915T203000Z|UTC", "2026-09-15T20:30:00Z"), ("20260915T163000|America/New_York", "2026-09-15T20:30:00Z"), ("20261003|America/New_York", "2026-10-03T04:00:00Z"), ("nonsense|UTC", None)])
def ics_instants(df):
    part = lambda i: F.element_at(F.split("raw", r"\|"), i)
    return df.select("raw", timex.stamp(timex.ics_instant(part(1), part(2))).alias("instant"))


@shape("raw, first", [("One two.\n\nThree.", "One two."), ("Abstract: what follows\n\nx", ""), ("x" * 10, "x" * 10), ("A" * 300 + ". " + "b" * 300, "A" * 300 + "."), ("c" * 500, "c" * 420 + "…"), ("A" * 300 + "! " + "b" * 300, "A" * 300 + "! " + "b" * 118 + "…"), ("Talk Abstract: x", "")])
def first_paragraph(df):
    return df.select("raw", text.first_paragraph(F.col("raw")).alias("first"))


_DOUBLES = ["45.15", "23.25", "0.35", "1.45", "16.05", "0.25", "0.75", "2.5", "0.05", "0.04", "-0.05", "9.95", "9.96", "99.949", "0", "-7", "123456789.05", "1e-9", "0.15000000000000002", "5.5", "62.5"]


@shape("raw, none, one, three", [(x, *(f"{float(x):.{n}f}" for n in (0, 1, 3))) for x in _DOUBLES])
def decimals(df):
    x = F.col("raw").cast("double")
    return df.select("raw", text.decimals(x, 0).alias("none"), text.decimals(x).alias("one"), text.decimals(x, 3).alias("three"))


@shape("raw, reason", [("6.25", "scraped 6.2h ago, window is 6h"), ("1.45", "scraped 1.4h ago, window is 6h"), ("0.35", "scraped 0.3h ago, window is 6h"), ("0.75", "scraped 0.8h ago, window is 6h"), (None, "never scraped")])
def elapsed_window(df):
    return df.select("raw", timex.elapsed_window(F.col("raw").cast("double"), F.lit(6))["reason"].alias("reason"))


_ITEM = "<rss><channel><item><title>On Graphs</title><link>http://u</link><guid>{}</guid><e:date>{}</e:date><e:speaker>Ann</e:speaker><e:speaker>Bo</e:speaker><e:speakerOrg>X</e:speakerOrg>{}<e:hostOrg>Host</e:hostOrg></item></channel></rss>"


@shape("raw, uid, dtstart, dtend, speakers, series", [
    (_ITEM.format("7", "Thursday, October 8, 2026 - 16:15", "<e:speakerOrg>Y</e:speakerOrg>"), "7", "20261008T161500", "", "Ann, X; Bo, Y", "Host"),
    (_ITEM.format("", "Thursday, October 8, 2026 - 16:15 - Thursday, October 8, 2026 - 17:15", ""), "http://u", "20261008T161500", "20261008T171500", "Ann; Bo", "Host"),
    (_ITEM.format("8", "Friday, October 8, 2026 - 16:15", ""), "8", None, "", "Ann; Bo", "Host"),
])
def rss_parse(df):
    from feedloom.sources import rss

    r = rss.records(df, "raw", "raw")
    return r.select(F.col("source").alias("raw"), "uid", "dtstart", "dtend", text.speaker_display(F.col("speakers")).alias("speakers"), "series")


@pytest.mark.parametrize("name", list(CASES))
def test_shapes(spark, name):
    f, columns, rows = CASES[name]
    out = f(spark.createDataFrame([(r[0],) for r in rows], "raw string"))
    assert sorted(map(str, ([r[c] for c in columns] for r in out.collect()))) == sorted(str(list(r)) for r in rows)
