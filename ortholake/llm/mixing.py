"""Operator 9: mixing sources to target weights by hierarchical budgeting.

The corpus is a tree: domain, language, source (any list of level columns works). A token
budget flows from the root: the children of a node share its budget by their weights, but
none gets more than the subtree can supply (tokens times ``max_epochs``). What a child cannot
take is shared out again among its siblings, by their weights; only what a whole subtree
cannot take reaches the siblings of its parent. Each leaf then selects its budget: whole
epochs (every document once each), and of one more epoch the prefix, in the seeded order of
that epoch (md5 of seed, epoch and id, ties by id), up to the document that reaches the rest.

The sharing is a running sum per parent over the tree's nodes, level by level. The prefix is
found without sorting a leaf: tokens are summed per leaf and hash range (``BINS``
ranges), the range where the budget ends is found from these sums, and only its rows are ranked;
documents themselves are compared with their leaf's last key and never shuffled for it.

Tokens of a document: its words (runs of other than ASCII white space). Defined results: null
levels form a child of their own (''); a null text has no tokens; documents without tokens
come with the whole epochs and with a prefix that reaches them; children without a given
weight weigh 1; a weight of 0 or less gets nothing; rows repeated under one id share one key
and are selected together. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ortholake.llm.common import fresh, materialise, table, text_or_empty

SEED = 17
MAX_EPOCHS = 4
BUDGET_SHARE = 0.8       # of the corpus' tokens
BIN_DIGITS = 3           # hex digits of the key that name its hash range
BINS = 16 ** BIN_DIGITS
LEVELS = ["domain", "language", "source"]

#: Target weights of the query: {level: {value: weight}}; a value not named weighs 1.
WEIGHTS = {"domain": {"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0}, "language": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 1.0}, "source": {}}


def n_tokens(text_col: str = "text") -> Column:
    spaces = " \t\n\x0b\x0c\r"
    flat = F.btrim(F.translate(text_or_empty(text_col), spaces, " " * len(spaces)))
    return F.when(flat == "", F.lit(0)).otherwise(F.size(F.split(flat, " +"))).cast("long")


def domain_of(source: str = "source") -> Column:
    """Domain of a source in the given tables: sources are numbered, every fourth one belongs
    to the same domain; a source without a number is in domain ''."""
    number = F.regexp_extract(F.coalesce(F.col(source).cast("string"), F.lit("")), "([0-9]+)$", 1)
    return F.when(number == "", F.lit("")).otherwise(F.concat(F.lit("d"), (number.cast("decimal(38,0)") % 4).cast("string")))


def _weight(level: str, weights: dict) -> Column:
    out = F.lit(1.0)
    for value, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(float(w))).otherwise(out)
    return out


def share_out(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """``nodes`` (capacity, weight, parent_budget) with ``budget``: each child of a parent gets
    min(capacity, weight * level), the level such that the parent's budget is used up (or all
    capacities are). Children sorted by capacity per weight fill up one after another; the
    first that does not fill at the level left for the rest fixes the level."""
    n = nodes.filter("weight > 0 and capacity > 0").withColumn("_fill", F.col("capacity") / F.col("weight"))
    order = Window.partitionBy(*parent).orderBy("_fill", *[c for c in _keys(nodes) if c not in parent])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    n = n.withColumn("_used", F.coalesce(F.sum("capacity").over(before), F.lit(0.0))).withColumn("_left", F.sum("weight").over(after))
    n = n.withColumn("_level", (F.col("parent_budget") - F.col("_used")) / F.col("_left"))
    everyone = Window.partitionBy(*parent)
    level = F.max(F.when(F.col("_fill") >= F.col("_level"), F.col("_level"))).over(everyone)   # it falls from there on
    n = n.withColumn("_level", level)
    budget = F.when(F.col("_level").isNull(), F.col("capacity")).otherwise(F.least("capacity", F.greatest(F.col("weight") * F.col("_level"), F.lit(0.0))))
    return n.withColumn("budget", budget).drop("_fill", "_used", "_left", "_level")


def _keys(nodes: DataFrame) -> list[str]:
    return [c for c in nodes.columns if c not in ("capacity", "weight", "parent_budget", "tokens", "budget")]


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict, budget_share: float = BUDGET_SHARE,
                 max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(levels, tokens, budget) per leaf from (levels, tokens) leaves. Budgets are whole tokens
    (rounded down)."""
    caps = leaves.withColumn("capacity", F.col("tokens").cast("double") * max_epochs)
    total = leaves.agg(F.floor(F.sum("tokens") * F.lit(budget_share)).cast("double").alias("parent_budget"))
    above: DataFrame | None = None
    for k in range(1, len(levels) + 1):
        nodes = caps.groupBy(*levels[:k]).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", _weight(levels[k - 1], weights))
        if above is None:
            nodes = nodes.join(F.broadcast(total))      # one row
            out = share_out(nodes.withColumn("_root", F.lit(0)), ["_root"]).drop("_root")
        else:
            out = share_out(nodes.join(above, levels[:k - 1]), levels[:k - 1])
        above = out.select(*levels[:k], F.col("budget").alias("parent_budget"))
    return leaves.join(above, levels).select(*levels, "tokens", F.floor(F.col("parent_budget") + 1e-6).cast("long").alias("budget"))


def epoch_key(epoch: Column, id_col: str, seed: int = SEED) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))


def leaf_plans(rows: DataFrame, levels: list[str], weights: dict, budget_share: float = BUDGET_SHARE,
               max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """(levels, whole, cut): whole epochs of a leaf, and the last key that the prefix of the
    next epoch takes ('' for none). ``rows``: (levels, id, n)."""
    leaves = materialise(rows.groupBy(*levels).agg(F.sum("n").alias("tokens")), "leaves")
    plan = leaf_budgets(leaves.filter("tokens > 0"), levels, weights, budget_share, max_epochs)
    plan = plan.withColumn("whole", F.floor(F.col("budget") / F.col("tokens")).cast("long"))
    plan = materialise(plan.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")), "plan")
    keyed = rows.join(plan.filter("rest > 0").select(*levels, "whole", "rest"), levels)
    keyed = keyed.withColumn("key", F.concat_ws(":", epoch_key(F.col("whole"), "id", seed), F.col("id").cast("string")))
    keyed = keyed.withColumn("bin", F.substring("key", 1, BIN_DIGITS))
    bins = materialise(keyed.groupBy(*levels, "bin").agg(F.sum("n").alias("bn"), F.first("rest").alias("rest")), "bins")
    run = Window.partitionBy(*levels).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    edge = bins.withColumn("start", F.coalesce(F.sum("bn").over(run), F.lit(0)))       # at most BINS rows a leaf
    edge = edge.filter((F.col("start") < F.col("rest")) & (F.col("start") + F.col("bn") >= F.col("rest")))
    edge = materialise(edge.select(*levels, "bin", "start"), "edge")
    last = keyed.join(edge, [*levels, "bin"]).groupBy(*levels, "bin", "key").agg(F.sum("n").alias("kn"), F.first("start").alias("start"), F.first("rest").alias("rest"))
    inside = Window.partitionBy(*levels, "bin").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("at", F.col("start") + F.coalesce(F.sum("kn").over(inside), F.lit(0))).filter(F.col("at") < F.col("rest"))
    cut = last.groupBy(*levels).agg(F.max("key").alias("cut"))
    return plan.join(cut, levels, "left").select(*levels, "whole", F.coalesce("cut", F.lit("")).alias("cut"))


def select_mixture(docs: DataFrame, levels: dict[str, Column], weights: dict = WEIGHTS, id_col: str = "doc_id", text_col: str = "text",
                   budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED, epoch_col: str = "epoch") -> DataFrame:
    """The selected rows of ``docs``, one for each epoch that takes them, with ``epoch_col``."""
    names = list(levels)
    own = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()]
    rows = materialise(docs.select(*own, F.col(id_col).alias("id"), n_tokens(text_col).alias("n")), "tokens")
    plans = materialise(leaf_plans(rows, names, weights, budget_share, max_epochs, seed), "plans")
    tag = {n: fresh(f"_{n}", docs.columns) for n in names}
    whole, cut = fresh("_whole", docs.columns), fresh("_cut", docs.columns)
    plans = plans.select(*[F.col(n).alias(tag[n]) for n in names], F.col("whole").alias(whole), F.col("cut").alias(cut))
    for n, c in levels.items():
        plans = plans.withColumnRenamed(tag[n], tag[n] + "p")
        docs = docs.withColumn(tag[n], F.coalesce(c.cast("string"), F.lit("")))
    j = docs.join(plans, [F.col(tag[n]) == F.col(tag[n] + "p") for n in names])
    key = F.concat_ws(":", epoch_key(F.col(whole), id_col, seed), F.col(id_col).cast("string"))
    copies = F.col(whole) + F.when(key <= F.col(cut), F.lit(1)).otherwise(F.lit(0))
    j = j.withColumn(epoch_col, F.explode(F.when(copies > 0, F.sequence(F.lit(0).cast("long"), copies - 1))))
    return j.drop(whole, cut, *tag.values(), *[t + "p" for t in tag.values()])


def tree() -> dict[str, Column]:
    return {"domain": domain_of(), "language": F.col("lang"), "source": F.col("source")}


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = select_mixture(docs, tree())
    return out.select("doc_id", domain_of().alias("domain"), "lang", "source", "epoch", n_tokens().alias("n_tokens"))


def _sql_shares(level: int, names: list[str], weights: dict) -> str:
    """CTEs of one level: nodes, then their shares of the parent's budget."""
    cols, parent = ", ".join(names[:level]), names[:level - 1]
    w = "".join(f"WHEN {names[level - 1]} = '{v}' THEN CAST({x} AS DOUBLE) " for v, x in weights.get(names[level - 1], {}).items())
    weight = f"CASE {w}ELSE CAST(1 AS DOUBLE) END" if w else "CAST(1 AS DOUBLE)"
    up = f"JOIN s{level - 1} USING ({', '.join(parent)})" if parent else "CROSS JOIN total"
    part = f"PARTITION BY {', '.join(parent)}" if parent else ""
    return f"""
n{level} AS (SELECT {cols}, capacity, weight, parent_budget, capacity / weight AS fill FROM
  (SELECT {cols}, sum(tokens * CAST({MAX_EPOCHS} AS DOUBLE)) AS capacity, {weight} AS weight FROM leaves GROUP BY ALL) x {up}),
r{level} AS (SELECT *, (parent_budget - coalesce(sum(capacity) OVER ({part} ORDER BY fill, {cols} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER ({part} ORDER BY fill, {cols} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM n{level}),
m{level} AS (SELECT *, max(CASE WHEN fill >= lv THEN lv END) OVER ({part}) AS fixed FROM r{level}),
s{level} AS (SELECT {cols}, CASE WHEN fixed IS NULL THEN capacity ELSE least(capacity, greatest(weight * fixed, 0)) END AS parent_budget FROM m{level})"""


_WORDS_SQL = r"(SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM documents)"
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, lang, source, n, CASE WHEN regexp_extract(source, '([0-9]+)$', 1) = '' THEN ''
    ELSE 'd' || CAST(CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4 AS VARCHAR) END AS domain, lang AS language FROM {_WORDS_SQL}),
leaves AS (SELECT domain, language, source, sum(n) AS tokens FROM d GROUP BY ALL HAVING sum(n) > 0),
total AS (SELECT floor(sum(tokens) * CAST({BUDGET_SHARE} AS DOUBLE)) AS parent_budget FROM leaves),
{",".join(_sql_shares(k, LEVELS, WEIGHTS) for k in (1, 2, 3))},
plan AS (SELECT l.*, CAST(floor(parent_budget + 1e-6) AS BIGINT) AS budget FROM leaves l JOIN s3 USING (domain, language, source)),
e AS (SELECT d.*, budget // tokens AS whole, budget - (budget // tokens) * tokens AS rest,
    md5('{SEED}:' || CAST(budget // tokens AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR) AS key
    FROM d JOIN plan USING (domain, language, source)),
c AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, language, source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM e),
k AS (SELECT *, whole + CASE WHEN start < rest THEN 1 ELSE 0 END AS copies FROM c)
SELECT doc_id, domain, lang, source, unnest(range(0, CAST(copies AS BIGINT))) AS epoch, CAST(n AS BIGINT) AS n_tokens FROM k"""
