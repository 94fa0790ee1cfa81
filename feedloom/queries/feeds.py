"""Queries over the driver's tables: documents and events as feed records, orders as rows with predicates and tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom import plans
from feedloom.functions import predicate, text, timex
from feedloom.operators import combine, edition, enrich, health, quality

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def line(c: str = "text") -> Column:
    return F.element_at(F.split(c, "\n"), 1)


def docs(spark, sf) -> DataFrame:
    return t(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source", F.array("source").alias("sources"), line().alias("title"), F.col("text").alias("content"), "lang", "n_chars")


CF = "replace(lower(trim(regexp_replace(translate(nfc_normalize({}), '–—‘’“”', '--''''\"\"'), '[\\s\\x{{A0}}]+', ' ', 'g'))), 'ß', 'ss')"


@query(f"""SELECT min(doc_id) AS id, arg_min(source, doc_id) AS source, array_to_string(list_sort(list_distinct(list(source))), ',') AS sources, count(*) AS n
FROM (SELECT *, {CF.format("split_part(text, chr(10), 1)")} AS k, {CF.format("text")} AS d FROM documents) GROUP BY k, d""")
def combine_merge(spark, sf):
    d = docs(spark, sf)
    out = combine.merged(d, {"title": text.compare_form(F.col("title"))}, {"content": text.compare_form(F.col("content"))}, ["id"])
    return out.select("id", "source", F.array_join("sources", ",").alias("sources"), "n")


@query("""SELECT min(event_id) AS id, array_to_string(list_sort(list_distinct(list(event_type))), ',') AS sources, count(*) AS n
FROM events GROUP BY CAST(ts AS DATE), user_id, CAST(floor(value / 5) AS BIGINT)""")
def combine_merge_events(spark, sf):
    e = t(spark, sf, "events").select(F.col("event_id").alias("id"), F.array("event_type").alias("sources"), F.to_date("ts").alias("day"), "user_id", F.floor(F.col("value") / 5).alias("v"))
    out = combine.merged(e, {"day": F.col("day"), "user": F.col("user_id")}, {"v": F.col("v")}, ["id"])
    return out.select("id", F.array_join("sources", ",").alias("sources"), "n")


@query("""SELECT k AS key_title, count(DISTINCT (lang, text)) AS variants, array_to_string(list_sort(list(doc_id)), ',') AS ids,
concat_ws(',', CASE WHEN count(DISTINCT lang) > 1 THEN 'lang' END, CASE WHEN count(DISTINCT text) > 1 THEN 'content' END) AS differing
FROM (SELECT *, split_part(text, chr(10), 1) AS k FROM documents) GROUP BY k HAVING count(DISTINCT (lang, text)) > 1""")
def combine_divergence(spark, sf):
    out = combine.divergences(docs(spark, sf), {"title": F.col("title")}, {"lang": F.col("lang"), "content": F.col("content")})
    return out.select("key_title", "variants", F.array_join("ids", ",").alias("ids"), F.array_join("differing", ",").alias("differing"))


@query("""SELECT event_type AS source, count(*) AS n FROM events WHERE event_type IN ('click', 'view', 'purchase') AND event_type NOT IN ('view')
AND contains(props, '1') AND NOT (value < 10) GROUP BY event_type""")
def combine_include_exclude(spark, sf):
    e = t(spark, sf, "events").withColumnRenamed("event_type", "source")
    out = combine.chosen(e, ["click", "view", "purchase"], ["view"], {"props": {"contains": "1"}}).filter(~(F.col("value") < 10))
    return out.groupBy("source").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey AS id FROM orders WHERE contains(o_orderpriority, '-') AND NOT contains(o_orderpriority, '5') AND lower(o_orderstatus) = 'o'
AND o_orderpriority NOT IN ('1-URGENT') AND regexp_matches(o_orderpriority, '^[0-9]-[a-z]', 'i') AND strftime(o_orderdate, '%Y-%m-%d') > '1995-01-01' AND strftime(o_orderdate, '%Y-%m-%d') < '1998-01-01'""")
def predicate_all_ops(spark, sf):
    o = t(spark, sf, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    where = {"o_orderpriority": {"contains": "-", "not_contains": "5", "not_in": ["1-URGENT"], "matches": "^[0-9]-[a-z]"}, "o_orderstatus": {"equals": "O"}, "day": {"after": "1995-01-01", "before": "1998-01-01"}}
    return o.filter(predicate.compiled(where, o)).select(F.col("o_orderkey").alias("id"))


@query("""SELECT o_orderpriority AS source, count(*) FILTER (k) AS kept, count(*) FILTER (NOT k) AS declined FROM
(SELECT *, (o_orderstatus IN ('O', 'F')) AND NOT contains(CAST(o_custkey AS VARCHAR), '7') AS k FROM orders) GROUP BY 1""")
def select_declined(spark, sf):
    o = t(spark, sf, "orders")
    keep = predicate.selected(o, {"o_orderstatus": {"in": ["O", "F"]}}, {"o_custkey": {"contains": "7"}})
    return o.groupBy(F.col("o_orderpriority").alias("source")).agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("declined"))


@query(f"SELECT {CF.format('split_part(text, chr(10), 1)')} AS form, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def compare_form_groups(spark, sf):
    return docs(spark, sf).groupBy(text.compare_form(F.col("title")).alias("form")).agg(F.count("*").alias("n")).filter("n > 1")


@query("""SELECT o_orderpriority AS tag, count(*) AS n FROM orders WHERE lower(trim(o_orderpriority)) NOT IN ('1-urgent', '2-high') GROUP BY 1 ORDER BY n DESC, tag LIMIT 3""")
def unmapped_top3(spark, sf):
    known = ["1-urgent", "2-high"]
    o = t(spark, sf, "orders").filter(~text.tag_key(F.col("o_orderpriority")).isin(known))
    return quality.top_unmapped(o.select(F.col("o_orderpriority").alias("tag")), "tag")


@query("""SELECT conv_id, array_to_string(list(role ORDER BY turn), '; ') AS speaker, CASE WHEN count(DISTINCT role) = 1 THEN min(role) ELSE '' END AS affiliation FROM conversations GROUP BY conv_id""")
def speaker_display(spark, sf):
    c = t(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("x"))
    people = c.select("conv_id", F.transform("x", lambda r: F.struct(r["role"].alias("name"), F.lit("").alias("affiliation"))).alias("s"), F.transform("x", lambda r: F.struct(F.lit("x").alias("name"), r["role"].alias("affiliation"))).alias("a"))
    return people.select("conv_id", text.speaker_display(F.col("s")).alias("speaker"), text.single_affiliation(F.col("a")).alias("affiliation"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS starts_at, strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S') AS start_time FROM events""")
def instant_and_wall_clock(spark, sf):
    e = t(spark, sf, "events").withColumn("at", F.col("ts").cast("timestamp"))
    return e.select("event_id", timex.stamp(F.col("at")).alias("starts_at"), timex.wall_clock(F.col("at"), "America/Bogota").alias("start_time"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' WHEN contains(o_orderpriority, 'URGENT') THEN 'news,web' ELSE 'web' END AS purposes FROM orders""")
def purposes_override(spark, sf):
    o = t(spark, sf, "orders")
    lists = [({"o_orderstatus": {"equals": "P"}}, []), ({"o_orderpriority": {"contains": "URGENT"}}, ["news", "web"])]
    out = F.lit("web")
    for where, values in reversed(lists):
        out = F.when(predicate.compiled(where, o), F.lit(",".join(values))).otherwise(out)
    return o.select("o_orderkey", out.alias("purposes"))


@query(r"""SELECT page_id, CASE WHEN v = '' THEN 'selector_miss' WHEN regexp_matches(v, 'de', 'i') THEN 'rejected' ELSE 'filled' END AS status,
CASE WHEN v = '' OR regexp_matches(v, 'de', 'i') THEN '' ELSE v END AS value FROM (SELECT page_id, trim(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1)) AS v FROM pages)""")
def enrich_pages(spark, sf):
    p = t(spark, sf, "pages")
    value = F.trim(F.regexp_extract("body", "<h1[^>]*>([^<]*)</h1>", 1))
    web = p.select("url", F.lit(200).alias("code"), F.col("html").alias("body"))
    return enrich.scraped(p.select("page_id", "url"), web, "url", value, "de").select("page_id", "status", "value")


@query(r"""SELECT host, count(*) AS attempted, count(*) FILTER (v <> '' AND NOT regexp_matches(v, 'de', 'i')) AS filled, count(*) FILTER (v = '') AS selector_miss,
count(*) FILTER (v <> '' AND regexp_matches(v, 'de', 'i')) AS rejected, 1.0::DOUBLE AS success_rate
FROM (SELECT regexp_extract(url, '://([^/]+)', 1) AS host, trim(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1)) AS v FROM pages) GROUP BY host""")
def enrich_stats(spark, sf):
    p = t(spark, sf, "pages")
    value = F.trim(F.regexp_extract("body", "<h1[^>]*>([^<]*)</h1>", 1))
    web = p.select("url", F.lit(200).alias("code"), F.col("html").alias("body"))
    got = enrich.scraped(p.select("page_id", "url", F.regexp_extract("url", "://([^/]+)", 1).alias("host")), web, "url", value, "de")
    return enrich.stats(got, "host").select("host", "attempted", "filled", "selector_miss", "rejected", "success_rate")


@query("""SELECT source, count(*) FILTER (l.doc_id IS NOT NULL) AS carried, count(*) FILTER (l.doc_id IS NULL) AS to_scrape FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY source""")
def carry_forward(spark, sf):
    held, rest = enrich.carried(t(spark, sf, "documents").select("doc_id", "source"), t(spark, sf, "labels"), "doc_id")
    both = held.select("source", F.lit(1).alias("h")).union(rest.select("source", F.lit(0).alias("h")))
    return both.groupBy("source").agg(F.sum("h").alias("carried"), F.sum(1 - F.col("h")).alias("to_scrape"))


@query("""WITH s AS (SELECT o_orderpriority AS source, count(*) AS n, count(*) - count(DISTINCT o_custkey) AS extra, count(*) FILTER (o_totalprice > 300000) AS ph,
count(*) FILTER (o_orderstatus = 'F') AS np, count(*) FILTER (o_orderstatus = 'P') AS un, count(*) FILTER (NOT regexp_matches(CAST(o_orderkey AS VARCHAR), '^[0-9]*[02468]$')) AS odd FROM orders GROUP BY 1),
r AS (SELECT source, count(*) AS rep FROM (SELECT o_orderpriority AS source, o_custkey FROM orders GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1)
SELECT source, gate, result, failing, n AS total FROM (SELECT s.*, coalesce(rep, 0) AS rep FROM s LEFT JOIN r USING (source)), LATERAL (VALUES
('count_floor', CASE WHEN n >= 1 THEN 'pass' ELSE 'fail' END, 0::BIGINT), ('unique_ids', CASE WHEN rep = 0 THEN 'pass' ELSE 'fail' END, rep), ('time_order', 'pass', 0::BIGINT),
('placeholder_rate', CASE WHEN ph / n <= 0.1 THEN 'pass' ELSE 'fail' END, ph), ('location_declined', CASE WHEN np / n <= 0.3 THEN 'pass' ELSE 'warn' END, np),
('unmapped_tags', CASE WHEN un = 0 THEN 'pass' ELSE 'warn' END, un), ('uid_pattern', CASE WHEN odd = 0 THEN 'pass' ELSE 'warn' END, odd)) AS g(gate, result, failing)""")
def gates(spark, sf):
    o = t(spark, sf, "orders")
    status = F.col("o_orderstatus")
    return quality.gates(o, "o_orderpriority", "o_custkey", F.col("o_orderdate"), F.col("o_orderdate"), F.col("o_totalprice") > 300000, status == "F", status == "P", F.col("o_orderkey").cast("string"), "^[0-9]*[02468]$", max_placeholder=0.1)


@query("""SELECT o_orderpriority AS source, count(*) FILTER (o_orderstatus <> 'P') AS before, count(*) FILTER (o_orderstatus <> 'P' AND o_totalprice <= 100000) AS removed,
count(*) FILTER (o_orderstatus = 'P' AND o_totalprice > 100000) AS added,
CASE WHEN count(*) FILTER (o_orderstatus <> 'P') <= 3 THEN 'pass' WHEN count(*) FILTER (o_orderstatus <> 'P' AND o_totalprice <= 100000) / count(*) FILTER (o_orderstatus <> 'P') <= 0.3 THEN 'pass' ELSE 'fail' END AS result FROM orders GROUP BY 1
HAVING count(*) FILTER (o_orderstatus <> 'P' OR o_totalprice > 100000) > 0""")
def diff_threshold(spark, sf):
    o = t(spark, sf, "orders")
    return quality.diff_threshold(o.filter("o_orderstatus <> 'P'"), o.filter("o_totalprice > 100000"), "o_orderpriority", "o_orderkey", most=0.3)


@query("""SELECT user_id, date_diff('minute', max(ts), TIMESTAMP '2024-01-30 12:00:00') AS waited, (date_diff('minute', max(ts), TIMESTAMP '2024-01-30 12:00:00') < 0
OR date_diff('minute', max(ts), TIMESTAMP '2024-01-30 12:00:00') + 10 >= 1440) AS due FROM (SELECT user_id, date_trunc('minute', ts) AS ts FROM events) GROUP BY user_id""")
def cadence_due(spark, sf):
    last = t(spark, sf, "events").groupBy("user_id").agg(F.max(F.date_trunc("minute", "ts")).alias("last"))
    waited = F.timestamp_diff("MINUTE", F.col("last").cast("timestamp"), F.lit("2024-01-30 12:00:00").cast("timestamp"))
    return last.select("user_id", waited.alias("waited"), timex.due(waited, timex.cadence_minutes(F.lit("1d"))).alias("due"))


REGISTRY = "(VALUES ('click', true), ('view', true), ('purchase', true), ('signup', false), ('silent', true)) AS r(source, live)"
_BUILT = "(SELECT event_type AS source, event_type <> 'purchase' AS ok, count(*) AS events, max(ts) AS seen FROM events GROUP BY 1)"
_PREV = "(SELECT event_type AS source, count(*) AS events_before, min(ts) AS last_success_before FROM events WHERE value > 50 GROUP BY 1)"
_MANIFEST = f"""SELECT r.source AS source, CASE WHEN NOT live THEN 'disabled' WHEN coalesce(ok, false) AND events > 0 THEN 'ok' WHEN coalesce(ok, false) THEN 'empty' ELSE 'failed' END AS status,
live AND NOT coalesce(ok, false) AND events_before IS NOT NULL AS stale, CASE WHEN NOT live THEN 0 WHEN coalesce(ok, false) THEN events ELSE coalesce(events_before, 0) END AS events,
CASE WHEN live AND coalesce(ok, false) THEN seen WHEN live THEN last_success_before END AS last_success FROM {REGISTRY} LEFT JOIN {_BUILT} b ON r.source = b.source LEFT JOIN {_PREV} p ON r.source = p.source"""


def _manifest(spark, sf):
    e = t(spark, sf, "events").withColumnRenamed("event_type", "source")
    registry = spark.createDataFrame([("click", True), ("view", True), ("purchase", True), ("signup", False), ("silent", True)], "source string, live boolean")
    built = e.groupBy("source").agg(F.count("*").alias("events"), F.max("ts").alias("at")).withColumn("ok", F.col("source") != "purchase")
    previous = e.filter("value > 50").groupBy("source").agg(F.count("*").alias("events_before"), F.min("ts").alias("last_success_before"))
    return plans.manifest(registry, built, previous)


@query(_MANIFEST)
def manifest(spark, sf):
    return _manifest(spark, sf)


@query(f"SELECT status, count(*) AS feeds, CAST(sum(events) AS BIGINT) AS events, CAST(sum(stale::INT) AS BIGINT) AS stale FROM ({_MANIFEST}) GROUP BY status")
def manifest_summary(spark, sf):
    return plans.summary(_manifest(spark, sf))


@query(f"""SELECT combo, bool_or(stale OR status = 'failed') AS stale, min(last_success) AS last_success, coalesce(array_to_string(list_sort(list_distinct(list(CASE WHEN stale THEN source END) FILTER (stale))), ','), '') AS degraded
FROM (VALUES ('all', 'click'), ('all', 'view'), ('all', 'purchase'), ('two', 'click'), ('two', 'view')) AS c(combo, source) JOIN ({_MANIFEST}) USING (source) GROUP BY combo""")
def combo_status(spark, sf):
    inputs = spark.createDataFrame([("all", "click"), ("all", "view"), ("all", "purchase"), ("two", "click"), ("two", "view")], "combo string, source string")
    return plans.combo_status(inputs, _manifest(spark, sf))


@query("""SELECT bucket, reason, count(*) AS n FROM (SELECT CASE WHEN event_type = 'purchase' THEN 'excluded' WHEN s BETWEEN lo AND hi THEN 'included' ELSE 'excluded' END AS bucket,
CASE WHEN event_type = 'purchase' THEN 'Does not serve news' WHEN s BETWEEN lo AND hi THEN '' WHEN s < lo THEN 'Starts before the window' ELSE 'Starts after the window' END AS reason
FROM (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS s, '2024-01-08T00:00:00' AS lo, '2024-01-14T23:59:59' AS hi FROM events)) GROUP BY 1, 2""")
def edition_partition(spark, sf):
    bounds = edition.resolved(F.lit("2024-01-04").cast("date"), ("next_week_start", 0), ("next_week_start", 6), 3)
    e = t(spark, sf, "events").withColumn("purposes", F.when(F.col("event_type") == "purchase", F.array(F.lit("web"))).otherwise(F.array(F.lit("news"))))
    b = edition.bucket(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.col("purposes"), "news", bounds["coverage_start"], bounds["coverage_end"])
    return e.select(b.alias("b")).groupBy("b.bucket", "b.reason").agg(F.count("*").alias("n"))


@query("""SELECT CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS n, count(*) FILTER (isodow(ts) <> 2) AS shifted FROM events GROUP BY 1""")
def edition_window(spark, sf):
    day = F.to_date("ts")
    shifted = edition.resolved(day, ("publication", 0), ("week_start", 6), 1)["shifted"]
    return t(spark, sf, "events").groupBy(timex.week_start(day).alias("week")).agg(F.count("*").alias("n"), F.count_if(shifted).alias("shifted"))


@query("""SELECT CASE WHEN quality = 0 OR toxic = 1 THEN 'check' WHEN n_chars < 300 OR lang = 'fr' THEN 'fix' ELSE 'ready' END AS readiness, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def readiness(spark, sf):
    d = t(spark, sf, "documents").join(t(spark, sf, "labels"), "doc_id", "left")
    no = F.lit(False)
    r = edition.readiness(no, F.coalesce(F.col("toxic") == 1, no), F.coalesce(F.col("quality") == 0, no), F.col("n_chars") < 300, F.col("lang") == "fr")
    return d.groupBy(r.alias("readiness")).agg(F.count("*").alias("n"))


@query("""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') || '|' || event_type || ' ' || (user_id % 20) AS collision_key, count(*) AS size, count(*) - 1 AS repeats FROM events GROUP BY 1 HAVING count(*) > 1""")
def collisions(spark, sf):
    e = t(spark, sf, "events")
    start = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm:ss")
    key = edition.collision_key(start, F.concat_ws(" -- ", F.upper("event_type"), (F.col("user_id") % 20).cast("string")), F.lit(False), F.lit(""))
    return edition.collisions(e, key)


@query("""SELECT CAST(ts AS DATE) AS day, count(*) AS n, min(ts) AS first, max(event_id) FILTER (event_id = l) AS last_id FROM (SELECT *, last_value(event_id) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l FROM events) GROUP BY 1""")
def group_by_day(spark, sf):
    d = edition.by_day(t(spark, sf, "events"), "ts", "event_id")
    return d.select("day", "n", F.element_at("items", 1)["ts"].alias("first"), F.element_at("items", -1)["event_id"].alias("last_id"))


def _clock(x: str) -> str:
    return f"CAST((hour({x}) + 11) % 12 + 1 AS VARCHAR) || CASE WHEN minute({x}) = 0 THEN '' ELSE ':' || lpad(CAST(minute({x}) AS VARCHAR), 2, '0') END"


def _half(x: str) -> str:
    return f"CASE WHEN hour({x}) < 12 THEN 'a.m.' ELSE 'p.m.' END"


@query(f"""SELECT event_id, CASE WHEN (hour(s), minute(s), hour(e), minute(e)) = (0, 0, 0, 0) AND CAST(e AS DATE) > CAST(s AS DATE) THEN 'All day'
ELSE {_clock("s")} || CASE WHEN {_half("s")} = {_half("e")} THEN '' ELSE ' ' || {_half("s")} END || ' — ' || {_clock("e")} || ' ' || {_half("e")} END AS time_range,
strftime(s, '%A') || ', ' || list_extract(['Jan.', 'Feb.', 'March', 'April', 'May', 'June', 'July', 'Aug.', 'Sept.', 'Oct.', 'Nov.', 'Dec.'], CAST(month(s) AS INT)) || ' ' || day(s) AS day
FROM (SELECT event_id, date_trunc('hour', ts) AS s, date_trunc('hour', ts) + to_minutes(CAST(event_id % 24 * 30 AS INT)) AS e FROM events)""")
def time_range_text(spark, sf):
    s = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    e = t(spark, sf, "events").select("event_id", s.alias("s")).withColumn("e", F.timestamp_seconds(F.unix_seconds("s") + F.col("event_id") % 24 * 1800))
    return e.select("event_id", timex.time_range(F.col("s"), F.col("e")).alias("time_range"), timex.short_date(F.col("s")).alias("day"))


@query("""SELECT event_type AS source, age, CASE WHEN age > 90 THEN 'fail' WHEN age < -5 THEN 'warn' ELSE 'ok' END AS fresh, CASE WHEN age > 360 THEN 'fail' ELSE 'warn' END AS stale
FROM (SELECT event_type, date_diff('minute', date_trunc('minute', max(ts)), TIMESTAMP '2024-01-30 22:00:00') AS age FROM events GROUP BY 1)""")
def freshness_and_staleness(spark, sf):
    last = t(spark, sf, "events").groupBy(F.col("event_type").alias("source")).agg(F.date_trunc("minute", F.max("ts")).alias("last"))
    age = F.timestamp_diff("MINUTE", F.col("last").cast("timestamp"), F.lit("2024-01-30 22:00:00").cast("timestamp"))
    return last.select("source", age.alias("age"), health.freshness(age).alias("fresh"), health.staleness(F.lit("ok"), F.lit(True), age).alias("stale"))


@query("""SELECT p.source AS source, promised, coalesce(served, 0) AS served, CASE WHEN promised = coalesce(served, 0) THEN 'ok' ELSE 'fail' END AS finding
FROM (SELECT source, count(*) AS promised FROM documents GROUP BY 1) p LEFT JOIN (SELECT source, count(*) AS served FROM documents WHERE n_chars > 100 GROUP BY 1) USING (source)""")
def served_counts(spark, sf):
    d = t(spark, sf, "documents")
    promised = d.groupBy("source").agg(F.count("*").alias("promised")).withColumn("status", F.lit("ok"))
    return health.served(promised, d.filter("n_chars > 100")).select("source", "promised", "served", "finding")


@query("""SELECT n_nationkey AS id, n_name || ' (' || r_name || ')' AS sponsor FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")
def sponsors(spark, sf):
    # nations and regions are fixed lists of 25 and 5 rows
    n, r = t(spark, sf, "nation"), t(spark, sf, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left").select(F.col("n_nationkey").alias("id"), F.concat("n_name", F.lit(" ("), "r_name", F.lit(")")).alias("sponsor"))


@query("""SELECT doc_id, sha256(source || '|' || lang || '|' || n_chars) AS fingerprint FROM documents""")
def fingerprint(spark, sf):
    return t(spark, sf, "documents").select("doc_id", F.sha2(F.concat_ws("|", "source", "lang", "n_chars"), 256).alias("fingerprint"))


@query("""SELECT doc_id AS id, source, title, title AS back FROM (SELECT doc_id, source, split_part(text, chr(10), 1) AS title FROM documents)""")
def wire_roundtrip(spark, sf):
    from pyspark.sql import types as T

    from feedloom.sources import wire

    d = docs(spark, sf).select("id", "source", "title")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("title", T.StringType())])
    out = d.withColumn("w", wire.to_wire(["id", "source", "title"], ["title"]))
    return out.withColumn("b", wire.from_wire(F.col("w"), schema, ["title"])).select("id", "source", "title", F.col("b.title").alias("back"))


@query("""SELECT user_id, count(*) AS events, strftime(min(ts), '%Y%m%dT%H%M%SZ') AS first_start, count(DISTINCT event_type) AS kinds FROM events GROUP BY user_id""")
def ics_parse(spark, sf):
    """Calendar text written from events, one feed a user, and read back."""
    from feedloom.sources import ics

    e = t(spark, sf, "events")
    one = F.concat(F.lit("BEGIN:VEVENT\r\nUID:"), F.col("event_id").cast("string"), F.lit("\r\nDTSTART:"), F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"), F.lit("\r\nSUMMARY:a\\, "), "event_type", F.lit("\r\n  b\r\nCATEGORIES:"), "event_type", F.lit(",x\\,y\r\nEND:VEVENT\r\n"))
    feeds = e.groupBy("user_id").agg(F.concat(F.lit("BEGIN:VCALENDAR\r\nPRODID:-//x//y\r\n"), F.array_join(F.array_sort(F.collect_list(one)), ""), F.lit("END:VCALENDAR\r\n")).alias("text"))
    got = ics.records(feeds, "user_id").withColumn("kind", F.regexp_extract("summary", "^a, (.*) b$", 1))
    return got.groupBy(F.col("source").alias("user_id")).agg(F.count("*").alias("events"), F.min("dtstart").alias("first_start"), F.count_distinct(F.element_at("categories", 1)).alias("kinds"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity, grouping(l_returnflag) AS g FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def ext_rollup(spark, sf):
    """Not among the reference's operators: what the engine gives for free."""
    return t(spark, sf, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"), F.grouping("l_returnflag").cast("long").alias("g"))


@query("""SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events""")
def ext_windows(spark, sf):
    """Not among the reference's operators."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    return t(spark, sf, "events").select("user_id", "event_id", F.row_number().over(w).cast("long").alias("rn"), F.lag("event_type").over(w).alias("previous"))


_ESC = "replace(regexp_replace(regexp_replace({}, '([\\\\,;])', '\\\\\\1', 'g'), '\\r?\\n', '\\\\n', 'g'), chr(13), '')"


_FOLDS = "greatest(0, ceil((length({}) - 75) / 74.0))"


# 18 content lines: 5 that open the calendar and the event, 6 of the event, 4 of the alarm, 3 that close them
@query(f"""SELECT doc_id, title AS back, CAST(18 + {_FOLDS.format("title_line")} + {_FOLDS.format("text_line")} + {_FOLDS.format("alarm_line")} AS BIGINT) AS lines
FROM (SELECT doc_id, title, 'SUMMARY:' || {_ESC.format("title")} AS title_line, 'DESCRIPTION:' || {_ESC.format("coalesce(text, '')")} AS text_line, 'DESCRIPTION:' || {_ESC.format("title")} AS alarm_line
FROM (SELECT doc_id, text, split_part(coalesce(text, ''), chr(10), 1) AS title FROM documents))""")
def ics_write(spark, sf):
    """A calendar file for each document, its physical lines counted, and the summary that reading it gives."""
    from feedloom.sources import ics

    at = F.timestamp_seconds("doc_id")
    d = t(spark, sf, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    files = d.select(F.col("doc_id").alias("source"), ics.calendar(F.col("doc_id").cast("string"), at, at, line(), F.col("text"), F.lit("")).alias("text"))
    lines = files.select(F.col("source").alias("doc_id"), (F.size(F.split("text", "\r\n")) - 1).cast("long").alias("lines"))
    return lines.join(ics.records(files).select(F.col("source").alias("doc_id"), F.col("summary").alias("back")), "doc_id")


@query("""SELECT c_custkey, state FROM (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'active' ELSE 'disabled' END AS state FROM customer)
WHERE state <> 'active' AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def stopped_schedules(spark, sf):
    path = lambda folder, c: F.concat(F.lit(folder), F.col(c).cast("string"), F.lit(".yml"))
    states = t(spark, sf, "customer").select("c_custkey", path("a/b/", "c_custkey").alias("path"), F.when(F.col("c_mktsegment") == "BUILDING", F.lit("active")).otherwise(F.lit("disabled")).alias("state"))
    return health.stopped(states, t(spark, sf, "orders").filter("o_orderstatus = 'F'").select(path("c/", "o_custkey").alias("path"))).select("c_custkey", "state")


@query("""WITH spec AS (SELECT CASE WHEN p_brand = 'Brand#2' THEN 'required_status_checks' ELSE p_brand END AS type, p_name AS context, p_partkey, p_size FROM part),
live AS (SELECT * FROM spec WHERE p_size < 10 AND type <> 'Brand#1')
SELECT 'rule' AS kind, type AS name FROM (SELECT DISTINCT type FROM spec) WHERE type NOT IN (SELECT type FROM live)
UNION ALL SELECT 'check', context FROM (SELECT DISTINCT context FROM spec WHERE type = 'required_status_checks')
WHERE context NOT IN (SELECT context FROM live WHERE type = 'required_status_checks') AND EXISTS (SELECT 1 FROM live WHERE type = 'required_status_checks')""")
def protection_gaps(spark, sf):
    kind = F.when(F.col("p_brand") == "Brand#2", F.lit("required_status_checks")).otherwise(F.col("p_brand"))
    spec = t(spark, sf, "part").select(kind.alias("type"), F.col("p_name").alias("context"), "p_partkey", "p_size")
    return health.protection_gaps(spec, spec.filter("p_size < 10 and type <> 'Brand#1'"))
