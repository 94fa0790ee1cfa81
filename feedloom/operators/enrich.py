"""Enrichment by pages: a left join on the url, statuses, held values, rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import pages as trees
from feedloom.functions import text
from feedloom.operators.transform import Source, by_source


def select_first(html: Column, *classes: str) -> Column:
    """Text of the first class in the list that the page has as a div, else ''."""
    bare = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", " "), r"\s+", " "))
    return F.coalesce(*(F.nullif(bare(F.regexp_extract(html, rf'(?s)<div[^>]*class="(?:[^"]* )?{c}(?: [^"]*)?"[^>]*>(.*?)</div>', 1)), F.lit("")) for c in classes), F.lit(""))


def scraped(records: DataFrame, pages: DataFrame, url: str, value: Column, reject: str | None = None) -> DataFrame:
    """Records with `status` and `value`: no_url, http_error, network_error, selector_miss, rejected or filled. Pages
    are made distinct by url first, so each is read once; pages hold url, code (null: network error) and body."""
    # of several bodies of a url the one that was reached, then the least
    once = pages.groupBy("url").agg(F.min_by(F.struct("code", "body"), F.struct(F.coalesce(F.col("code") != 200, F.lit(True)), "code", "body")).alias("_p"))
    once = once.select("url", "_p.code", "_p.body").select(F.col("url").alias("_url"), "code", value.alias("_value"))
    out = records.join(once, records[url] == F.col("_url"), "left")
    status = F.when(F.coalesce(F.col(url), F.lit("")) == "", F.lit("no_url")).when(F.col("code").isNull(), F.lit("network_error")).when(F.col("code") != 200, F.lit("http_error")).when(F.coalesce("_value", F.lit("")) == "", F.lit("selector_miss"))
    if reject:
        status = status.when(F.col("_value").rlike(f"(?i){reject}"), F.lit("rejected"))
    out = out.withColumn("status", status.otherwise(F.lit("filled")))
    return out.withColumn("value", F.when(F.col("status") == "filled", F.col("_value")).otherwise(F.lit(""))).drop("_url", "_value", "code")


def fill(current: Column, value: Column, missing: Column | None = None) -> Column:
    """Never overwrites what is there."""
    empty = missing if missing is not None else F.coalesce(current, F.lit("")) == ""
    return F.when(empty & (value != ""), value).otherwise(current)


def select_all(html: Column, *classes: str) -> Column:
    """Texts of every div of the first class in the list that has any, distinct, in their order."""
    bare = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", " "), r"\s+", " "))
    of = lambda c: F.array_distinct(F.filter(F.transform(F.regexp_extract_all(html, F.lit(rf'(?s)<div[^>]*class="(?:[^"]* )?{c}(?: [^"]*)?"[^>]*>(.*?)</div>'), F.lit(1)), bare), lambda x: x != ""))
    found = [of(c) for c in classes]
    return F.coalesce(*(F.when(F.size(x) > 0, x) for x in found), F.array().cast("array<string>"))


def applied(field: str, value: Column, fill: bool | Column = True, split: bool = False) -> dict[str, Column]:
    """New columns of an event for a scraped value: an array of texts for speakers, else a text. With `fill` what the
    feed gave stays. A title that is missing changes nothing; one that is taken says that it was enriched."""
    if field == "speakers":
        people = F.transform(value, lambda v: text.split_speaker(v) if split else F.struct(v.alias("name"), F.lit("").alias("affiliation")))
        keep = (F.size("speakers") > 0) & F.lit(fill) | (F.size(value) == 0)
        return {"speakers": F.when(keep, F.col("speakers")).otherwise(people)}
    if field == "title":
        take = ~text.is_missing(value) & (text.is_missing(F.col("title")) | ~F.lit(fill))
        return {
            "title": F.when(take, value).otherwise(F.col("title")),
            "title_source": F.when(take, F.lit("enriched")).otherwise(F.col("title_source")),
            "title_is_placeholder": F.when(take, F.lit(False)).otherwise(F.col("title_is_placeholder")),
        }
    keep = (F.col(field) != "") & F.lit(fill) | (F.coalesce(value, F.lit("")) == "")
    return {field: F.when(keep, F.col(field)).otherwise(value)}


def carry(events: DataFrame, held: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Events with the scraped values of an earlier run (held: key and the fields, title_source among them if title is),
    provenance included, and `carried`. A title is carried only if it was enriched then. One left join."""
    names = [*fields, *(["title_source"] if "title" in fields else [])]
    old = held.select(key, *(F.col(n).alias(f"_{n}") for n in names), F.lit(True).alias("_held"))
    out = events.join(old, key, "left").withColumn("carried", F.coalesce("_held", F.lit(False)))
    new: dict[str, Column] = {}
    for f in fields:
        if f == "speakers":
            new[f] = F.when(F.coalesce(F.size("_speakers"), F.lit(0)) > 0, F.col("_speakers")).otherwise(F.col("speakers"))
        elif f == "title":
            take = F.coalesce(F.col("_title_source") == "enriched", F.lit(False))
            new |= {"title": F.when(take, F.col("_title")).otherwise(F.col("title")), "title_source": F.when(take, F.lit("enriched")).otherwise(F.col("title_source"))}
            new["title_is_placeholder"] = F.when(take, F.lit(False)).otherwise(F.col("title_is_placeholder"))
        else:
            new |= applied(f, F.col(f"_{f}"))
    return out.withColumns(new).drop("_held", *(f"_{n}" for n in names))


def carried(records: DataFrame, held: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Records whose key is held, and those still to be scraped: one join, whose flag both read."""
    marked = records.join(held.select(key).distinct().withColumn("_held", F.lit(True)), key, "left")
    return marked.filter("_held").drop("_held"), marked.filter("_held is null").drop("_held")


def stats(scraped_: DataFrame, source: str, floor: float = 0.0) -> DataFrame:
    """Counts by source and status, the share of requests that succeeded (1 if none was made), and breaches of a floor."""
    n = lambda s: F.count_if(F.col("status") == s)
    out = scraped_.groupBy(source).agg(F.count_if(~F.col("status").isin("no_url", "carried")).alias("attempted"), *(n(s).alias(s) for s in ("filled", "selector_miss", "rejected", "http_error", "network_error", "no_url", "carried")))
    rate = F.coalesce(F.try_divide(F.col("attempted") - F.col("http_error") - F.col("network_error"), F.col("attempted")), F.lit(1.0))
    return out.withColumn("success_rate", F.round(rate, 3)).withColumn("breach", (F.col("attempted") > 0) & (rate < floor))


#: Fields that only pages give; they are empty until then.
PAGE_FIELDS = ("raw_details", "abstract", "bio", "content", "banner_image")


def _declared(s: Source, name: str) -> dict | None:
    return next((t for t in s.enrich if t["field"] == name), None)


def enriched(events: DataFrame, sources: list[Source], pages: DataFrame, held: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Events with what their pages say, by the targets that their sources declare (enrich: field, selectors, and reject,
    split, mode `fill` or `replace`), and (source, field, status) of every event and target.

    An event whose guid `held` has (source, guid and fields of an earlier publication) gets its values from there and its
    page isn't wanted; so inside a source's window only what is new is scraped. Pages (url, code, body) are read once per
    url and parsed once, then joined to the events that want them; every target reads the same tree."""
    names = [t["field"] for s in sources for t in s.enrich]
    names = sorted(set(names), key=names.index)
    out = events
    for name in names:
        if name not in out.columns:
            out = out.withColumn(name, F.array().cast("array<struct<name:string,affiliation:string>>") if name == "speakers" else F.lit(""))
    if held is None:
        out = out.withColumn("carried", F.lit(False))
    else:
        known = held.withColumn("_key", F.concat_ws(":", "source", "guid"))
        known = known.select("_key", *(F.col(c) for c in [*names, *(["title_source"] if "title" in names else [])]))
        out = carry(out.withColumn("_key", F.concat_ws(":", "source", "guid")), known.dropDuplicates(["_key"]), "_key", names).drop("_key")
    wants = F.col("source").isin([s.slug for s in sources if s.enrich]) & ~F.col("carried") & (F.coalesce("url", F.lit("")) != "")
    once = pages.groupBy("url").agg(F.min_by(F.struct("code", "body"), F.struct(F.coalesce(F.col("code") != 200, F.lit(True)), "code", "body")).alias("p"))
    once = once.select(F.col("url").alias("_url"), F.col("p.code").alias("_code"), trees.tree(F.col("p.body")).alias("_nodes"))
    out = out.withColumn("_want", F.when(wants, F.col("url"))).join(once, F.col("_want") == F.col("_url"), "left")
    status = {}
    for name in names:
        some = [s for s in sources if _declared(s, name)]
        many = name == "speakers"
        pick = trees.select_all if many else trees.select_first
        found = by_source(some, lambda s, pick=pick, name=name: pick(F.col("_nodes"), *_declared(s, name)["selectors"]), "enrich")
        none = F.array().cast("array<string>") if many else F.lit("")
        found = F.coalesce(found, none)
        reject = by_source(some, lambda s, name=name: F.lit(_declared(s, name).get("reject") or "").cast("string"), "enrich")
        first = F.coalesce(F.get(found, 0), F.lit("")) if many else found
        bad = (reject != "") & F.regexp_like(first, F.concat(F.lit("(?i)"), reject))
        miss = F.size(found) == 0 if many else found == ""
        st = F.when(~F.col("source").isin([s.slug for s in some]), F.lit(None).cast("string")).when(F.col("carried"), "carried").when(F.col("_want").isNull(), "no_url")
        st = st.when(F.col("_code").isNull(), "network_error").when(F.col("_code") != 200, "http_error").when(miss, "selector_miss").when(bad, "rejected").otherwise("filled")
        out = out.withColumn(f"_st_{name}", st).withColumn(f"_v_{name}", F.when(F.col(f"_st_{name}") == "filled", found).otherwise(none))
        fills = by_source(some, lambda s, name=name: F.lit(_declared(s, name).get("mode", "fill") == "fill"), "enrich")
        splits = any(_declared(s, name).get("split") for s in some)
        new = applied(name, F.col(f"_v_{name}"), F.coalesce(fills, F.lit(True)), splits)
        out = out.withColumns(new)
        status[name] = f"_st_{name}"
    if "speakers" in names:
        out = out.withColumns({"speaker": text.speaker_display(F.col("speakers")), "affiliation": text.single_affiliation(F.col("speakers"))})
    rows = F.array(*(F.struct(F.lit(n).alias("field"), F.col(c).alias("status")) for n, c in status.items())) if status else F.array().cast("array<struct<field:string,status:string>>")
    seen = out.select("source", F.explode(rows).alias("t")).select("source", "t.field", "t.status").filter("status is not null")
    return out.drop("_want", "_url", "_code", "_nodes", "carried", *(c for c in out.columns if c.startswith(("_st_", "_v_")))), seen


def breaches(seen: DataFrame, sources: list[Source]) -> DataFrame:
    """(source, detail): the sources whose pages were reached less often than they expect, by field. What was not asked
    for counts neither way."""
    floor = by_source(sources, lambda s: F.lit(float(s.expectations.get("min_enrich_success_rate", 0.0))), "expectations")
    n = lambda *some: F.count_if(F.col("status").isin(*some))
    by = seen.groupBy("source", "field").agg(n("filled", "selector_miss", "rejected").alias("reached"), n("http_error").alias("refused"), n("network_error").alias("silent"))
    by = by.withColumn("attempted", F.col("reached") + F.col("refused") + F.col("silent")).withColumn("floor", floor)
    bad = by.filter((F.col("attempted") > 0) & (F.col("reached") / F.col("attempted") < F.col("floor")))
    said = F.format_string("%s: reached %d of %d pages (%.0f%%, floor %.0f%%)", "field", "reached", "attempted", 100 * F.col("reached") / F.col("attempted"), 100 * F.col("floor"))
    return bad.groupBy("source").agg(F.array_join(F.array_sort(F.collect_list(said)), "; ").alias("detail"))
