"""[4] Mixing of sources to target weights: budgets through a domain-language-source tree, token prefixes of seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import saved, table

LEVELS = ("domain", "lang", "source")
#: Weights by path from the root; children that are not named weigh 1. The rest of the parameters: the share of all tokens
#: that is the budget, how often a document may be taken, the seed of the epochs.
WEIGHTS: dict[tuple[str, ...], float] = {("web",): 2.0, ("web", "en"): 3.0, ("books", "en"): 2.0}
SHARE, EPOCHS, SEED = 0.6, 2, 11
#: The sources of each domain; others are of the domain OTHER.
DOMAINS = {"web": tuple(f"src{i}" for i in range(7)), "books": tuple(f"src{i}" for i in range(7, 13)), "forums": tuple(f"src{i}" for i in range(13, 20))}
OTHER = "other"
#: An epoch's order is by 60 bits of a hash. Token sums of cells of its highest 8 bits, then of the next ones in the cell
#: where the budget ends, find that place; what is left after the last level is sorted.
BITS, LEVEL_BITS = 60, (8, 16, 24)
_NONE = "(null)"


def domain(source: Column, domains: dict[str, tuple[str, ...]] = DOMAINS) -> Column:
    out = F.lit(OTHER)
    for name, sources in domains.items():
        out = F.when(F.coalesce(source.isin(list(sources)), F.lit(False)), F.lit(name)).otherwise(out)
    return out


def tokens(text: Column) -> Column:
    """Tokens of a text: runs without white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _weight(path: list[Column], weights: dict[tuple[str, ...], float]) -> Column:
    out = F.lit(1.0)
    for names, w in weights.items():
        if len(names) == len(path):
            test = F.lit(True)
            for c, name in zip(path, names, strict=True):
                test = test & (c == name)
            out = F.when(test, F.lit(float(w))).otherwise(out)
    return out


def budgets(leaves: DataFrame, total: Column, weights: dict[tuple[str, ...], float], epochs: int) -> DataFrame:
    """Budgets of leaves (domain, lang, source, supply) from the root's.

    A node's budget is divided among its children by weight; a child never gets more than its subtree holds in all
    epochs, and what it can't take goes to its siblings by weight, so a shortage leaves a node only when all children
    are full. In closed form: a child gets the least of its capacity and its weight times the level, and the level is
    the highest of what the budget leaves by weight after the children of least capacity by weight are filled. Sums over
    children by window, level by level; nothing on the driver.
    """
    rows = leaves.withColumn("capacity", F.col("supply").cast("double") * epochs)
    for depth in range(1, len(LEVELS) + 1):
        rows = rows.withColumn(f"c{depth}", F.sum("capacity").over(W.partitionBy(*LEVELS[:depth])))
        rows = rows.withColumn(f"w{depth}", _weight([F.col(c) for c in LEVELS[:depth]], weights))
    whole = rows.agg(F.sum("capacity").alias("all"))
    budget = rows.crossJoin(F.broadcast(whole)).withColumn("budget", F.least(total, F.col("all"))).drop("all")
    for depth in range(1, len(LEVELS) + 1):
        c, w = f"c{depth}", f"w{depth}"
        parent, own = list(LEVELS[: depth - 1]), LEVELS[depth - 1]
        children = budget.groupBy(*parent, own).agg(F.max("budget").alias("above"), F.max(c).alias("cap"), F.max(w).alias("weight"))
        siblings = W.partitionBy(*parent or [F.lit(0)])
        before = siblings.orderBy(F.col("cap") / F.col("weight"), own).rowsBetween(W.unboundedPreceding, -1)
        left = F.col("above") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
        share = left / (F.sum("weight").over(siblings) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        children = children.withColumn("share", share).withColumn("level", F.max("share").over(siblings))
        children = children.select(*parent, own, F.least("cap", F.col("level") * F.col("weight")).alias("got"))
        budget = budget.join(children, [*parent, own]).withColumn("budget", F.col("got")).drop("got")
    return budget.select(*LEVELS, "supply", F.floor(F.col("budget") + 1e-6).cast("long").alias("budget"))


def mixture(docs: DataFrame, weights: dict[tuple[str, ...], float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED, domains: dict[str, tuple[str, ...]] = DOMAINS, row: str | None = None) -> DataFrame:
    """One row per document that is taken: doc_id, domain, lang, source, n_tokens, taken (tokens over all epochs), and
    row (a number of the input row: the column of that name if `row` names one).

    The budget is `share` of all tokens. A leaf's budget is a prefix of its epochs, each a seeded permutation of its
    documents: whole epochs, then documents in order until the budget ends, the last one cut. The end is found from
    token sums of 256 cells of the permutation, then of 256 cells of the cell in which it lies, and again; only the
    16-millionth of a leaf that is left is sorted, so a leaf of any size is no hot key. Sums are partial before their
    shuffle, and a window has 256 rows.

    Null languages and sources are leaves of their own; null and empty texts have no tokens and are not taken. The
    permutation is by id and text; ties, which are equal rows, go by row number. Rows that repeat an id are documents
    each. Other columns than doc_id, text, lang, source and `row` are ignored. An empty table gives an empty result.
    """
    number = F.col(f"`{row}`") if row else F.monotonically_increasing_id()
    mark = F.substring(F.md5(F.coalesce("text", F.lit("")).cast("binary")), 1, 8)
    named = docs.select("doc_id", number.alias("row"), F.coalesce("lang", F.lit(_NONE)).alias("lang"), F.coalesce("source", F.lit(_NONE)).alias("source"), tokens(F.col("text")).alias("n_tokens"), domain(F.col("source"), domains).alias("domain"), mark.alias("mark"))
    named = saved(named.filter("n_tokens > 0"), "counted")
    leaves = named.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("supply"))
    total = named.agg(F.sum("n_tokens")).first()[0] or 0
    planned = saved(budgets(leaves, F.lit(float(int(share * total))), weights, epochs), "budgets")
    planned = planned.withColumn("whole", F.floor(F.col("budget") / F.col("supply"))).withColumn("rest", F.col("budget") - F.col("whole") * F.col("supply"))
    # the permutation of the epoch that the budget ends in
    text = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "mark", F.lit(seed).cast("string"), F.col("whole").cast("string"))
    order = F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")
    placed = named.join(planned.select(*LEVELS, "whole", "rest"), list(LEVELS)).withColumn("order", order).drop("mark")
    placed = saved(placed, "placed")
    edges, last = planned.select(*LEVELS, "rest", F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("before")), 0
    for bits in LEVEL_BITS:
        inside = placed.drop("rest").join(edges, list(LEVELS)).filter(F.shiftright("order", BITS - last) == F.col("cell"))
        cells = inside.groupBy(*LEVELS, F.shiftright("order", BITS - bits).alias("to")).agg(F.sum("n_tokens").alias("sum"), F.max("rest").alias("rest"), F.max("before").alias("before"))
        run = F.coalesce(F.sum("sum").over(W.partitionBy(*LEVELS).orderBy("to").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        cells = cells.withColumn("start", F.col("before") + run).filter((F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("sum")))
        edges, last = saved(cells.select(*LEVELS, "rest", F.col("to").alias("cell"), F.col("start").alias("before")), "edges"), bits
    at = placed.drop("rest").join(edges, list(LEVELS)).withColumn("side", F.signum(F.shiftright("order", BITS - last) - F.col("cell")))
    outside = at.filter("side <> 0").withColumn("part", F.when(F.col("side") < 0, F.col("n_tokens")).otherwise(F.lit(0)).cast("long"))
    run = F.coalesce(F.sum("n_tokens").over(W.partitionBy(*LEVELS).orderBy("order", "doc_id", "row").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    split = at.filter("side = 0").withColumn("part", F.greatest(F.lit(0).cast("long"), F.least(F.col("n_tokens"), F.col("rest") - F.col("before") - run)))
    taken = (F.col("whole") * F.col("n_tokens") + F.col("part")).cast("long")
    return outside.unionByName(split).withColumn("taken", taken).filter("taken > 0").select("doc_id", *LEVELS, "n_tokens", "taken", "row")


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """The documents of a mixture with their own columns: one that is taken k times whole comes k times, and one that is
    cut comes with the first words that are taken (n_chars, where there is such a column, follows the text)."""
    own = docs.columns
    row, n, taken = (next(x for x in (name + "_" * k for k in range(len(own) + 1)) if x not in own) for name in ("row", "n_tokens", "taken"))
    docs = saved(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    chosen = mixture(docs, **parameters, row=row).select(F.col("row").alias(row), F.col("n_tokens").alias(n), F.col("taken").alias(taken))
    out = docs.join(chosen, row)
    times = F.ceil(F.col(taken) / F.col(n)).cast("int")
    each = out.select("*", F.explode(F.sequence(F.lit(1), times)).alias(f"{row}_time"))
    left = F.col(taken) - (times - 1) * F.col(n)
    cut = (F.col(f"{row}_time") == times) & (left < F.col(n))
    prefix = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"(\s*\S+)"), F.lit(1)), F.lit(1), left.cast("int")), "")
    text = F.when(cut, prefix).otherwise(F.col("text"))
    new = {"text": text} | ({"n_chars": F.when(cut, F.length(text).cast("long")).otherwise(F.col("n_chars"))} if "n_chars" in own else {})
    return each.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in own))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document of the table that is taken: doc_id, domain, lang, source, n_tokens, taken."""
    return mixture(table(spark, sf_dir, "documents")).drop("row")


def _case(path: list[str]) -> str:
    tests = [(" AND ".join(f"{c} = '{v}'" for c, v in zip(path, names, strict=True)), w) for names, w in WEIGHTS.items() if len(names) == len(path)]
    return f"CASE {' '.join(f'WHEN {t} THEN {w}' for t, w in tests)} ELSE 1.0 END" if tests else "1.0"


def _level(depth: int) -> str:
    """Budgets of the nodes of a level (b1, b2, b3) from those of their parents."""
    path, parent = list(LEVELS[:depth]), list(LEVELS[: depth - 1])
    by, own = f"PARTITION BY {', '.join(parent)}" if parent else "", LEVELS[depth - 1]
    above = f"JOIN b{depth - 1} USING ({', '.join(parent)})" if parent else "CROSS JOIN b0"
    return f"""n{depth} AS (SELECT {", ".join(path)}, CAST(sum(supply) * {EPOCHS} AS DOUBLE) AS cap, CAST({_case(path)} AS DOUBLE) AS weight FROM leaves GROUP BY {", ".join(path)}),
s{depth} AS (SELECT {", ".join(path)}, cap, weight, (above - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER (WINDOW_ALL) - coalesce(sum(weight) OVER w, 0)) AS share
  FROM n{depth} {above} WINDOW w AS ({by} ORDER BY cap / weight, {own} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b{depth} AS (SELECT {", ".join(path)}, least(cap, weight * max(share) OVER ({by})) AS above FROM s{depth})""".replace("WINDOW_ALL", by)


_DOMAIN = "CASE " + " ".join(f"WHEN source IN ({', '.join(repr(x) for x in sources)}) THEN '{name}'" for name, sources in DOMAINS.items()) + f" ELSE '{OTHER}' END"
SQL = f"""
WITH d AS (SELECT doc_id, {_DOMAIN} AS domain, coalesce(lang, '{_NONE}') AS lang, coalesce(source, '{_NONE}') AS source, substr(md5(text), 1, 8) AS mark,
  CAST(len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')) AS BIGINT) AS n_tokens FROM documents WHERE text IS NOT NULL),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS supply FROM d WHERE n_tokens > 0 GROUP BY ALL),
b0 AS (SELECT least(floor({SHARE} * sum(supply)), CAST(sum(supply) * {EPOCHS} AS DOUBLE)) AS above FROM leaves),
{_level(1)}, {_level(2)}, {_level(3)},
plan AS (SELECT domain, lang, source, CAST(supply AS BIGINT) AS supply, CAST(floor(above + 1e-6) AS BIGINT) AS budget FROM leaves JOIN b3 USING (domain, lang, source)),
o AS (SELECT d.*, budget // supply AS whole, budget % supply AS rest,
  CAST('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), mark, '{SEED}', CAST(budget // supply AS VARCHAR))), 1, 15) AS BIGINT) AS o FROM d JOIN plan USING (domain, lang, source) WHERE n_tokens > 0),
r AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY o, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM o),
t AS (SELECT doc_id, domain, lang, source, n_tokens, CAST(whole * n_tokens + greatest(0, least(n_tokens, rest - run)) AS BIGINT) AS taken FROM r)
SELECT * FROM t WHERE taken > 0
"""
