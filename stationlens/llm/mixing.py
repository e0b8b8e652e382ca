"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, language, source). The token budget flows down the tree: at each node it is
divided by weight, and what a child cannot take (its tokens times the number of epochs) goes to
its siblings; only what a whole family cannot take is left to the family's own siblings, because
a node is offered no more than its subtree holds. Each leaf then takes the documents at the
front of seeded epochs: every epoch orders the leaf by a hash of seed, epoch and id, and
documents are taken while fewer tokens than the leaf's budget lie before them.

All amounts are whole numbers, rounded down at each node. Tokens are words (runs of characters
other than space and U+0009 to U+000D).

Defined cases: null domain, language or source is a group of its own, called ``(none)``; unknown
names have weight 1 and weight 0 takes nothing while siblings can; null and empty texts have no
tokens and are never taken; rows with one id have one place and are taken together; a null id
counts as the id ``(none)``.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NONE = "(none)"
WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ["_domain", "_lang", "_source"]


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_domain(source: Column) -> Column:
    """The domain of a source: web, books, code or talk by its number, ``other`` without one."""
    number = F.regexp_extract(source, r"([0-9]+)$", 1)
    return F.when(F.length(number) > 0, F.element_at(F.array(*[F.lit(d) for d in ("web", "books", "code", "talk")]), (F.pmod(number.cast("long"), F.lit(4)) + 1).cast("int"))).otherwise("other")


def weight_of(column: str, weights: dict) -> Column:
    """Whole-number weight of a name, 1 if not listed."""
    out = F.lit(1)
    for name, w in (weights or {}).items():
        out = F.when(F.col(column) == name, F.lit(int(w))).otherwise(out)
    return out.cast("long")


def divide(children: DataFrame, parent: list, child: str, weights: dict) -> DataFrame:
    """``budget`` per child from ``amount`` per parent: shares by weight, capped by ``supply``.

    The children of a node are put in the order in which they fill up. Those before the first
    child whose share fits keep their whole supply, the rest share what is left by weight.
    """
    by = Window.partitionBy(*parent)
    w, c = F.col("_w"), F.col("supply")
    ratio = F.when(w > 0, c / w).otherwise(F.lit(float("inf")))
    order = by.orderBy(ratio, child)
    rows = children.withColumn("_w", weight_of(child, weights))
    rows = rows.withColumn("_full", F.coalesce(F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("_rest", F.sum(w).over(order.rowsBetween(0, Window.unboundedFollowing)))
    left = F.greatest(F.col("amount") - F.col("_full"), F.lit(0))
    # A child fits if its supply covers its share of what the fuller ones leave.
    fits = F.when(F.col("_rest") > 0, left * w <= c * F.col("_rest")).otherwise(False)
    rows = rows.withColumn("_fits", fits).withColumn("_left", left).withColumn("_at", F.row_number().over(order))
    edge = F.min(F.when(F.col("_fits"), F.struct("_at", "_left", "_rest"))).over(by)
    rows = rows.withColumn("_edge", edge)
    share = F.expr("(_edge._left * _w) div _edge._rest")
    # Without a child that fits, all weighted children are full; children of weight 0 take the remainder in order.
    unweighted = F.least(c, left)
    budget = F.when((F.col("_edge").isNotNull()) & (F.col("_at") >= F.col("_edge._at")), share).when(w > 0, c).otherwise(F.when(F.col("_edge").isNotNull(), 0).otherwise(unweighted))
    return rows.withColumn("budget", budget.cast("long")).drop("_w", "_full", "_rest", "_fits", "_left", "_at", "_edge")


def leaf_budgets(leaves: DataFrame, budget: Column, weights: dict, epochs: int) -> DataFrame:
    """``leaves`` (names of the levels, ``tokens``) with ``supply`` and ``budget``; ``budget`` is a column over the total ``tokens``."""
    leaves = leaves.withColumn("supply", F.col("tokens") * epochs)
    total = leaves.agg(F.sum("tokens").alias("tokens"), F.sum("supply").alias("_most")).select(F.lit(0).alias("_root"), F.least(F.coalesce(budget.cast("long"), F.lit(0)), F.coalesce("_most", F.lit(0))).alias("amount"))
    above, keys = total, ["_root"]
    rooted = leaves.withColumn("_root", F.lit(0))
    for i, level in enumerate(LEVELS):
        nodes = rooted.groupBy("_root", *LEVELS[: i + 1]).agg(F.sum("supply").alias("supply"))
        nodes = nodes.join(above, keys)
        above = divide(nodes, keys, level, weights.get(level[1:]))
        keys = ["_root", *LEVELS[: i + 1]]
        above = above.select(*keys, F.col("budget").alias("amount"))
    return leaves.join(above.withColumnRenamed("amount", "budget").drop("_root"), LEVELS)


def _placed(rows: DataFrame, epochs: int, seed: int) -> DataFrame:
    """One row per epoch with its place ``_h`` (hexadecimal) in the leaf's order."""
    many = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    return many.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}|"), F.col("epoch").cast("string"), F.lit("|"), F.col("_id"))))


def mix(docs: DataFrame, weights: dict = None, share: float = 0.8, epochs: int = 2, seed: int = 17, domain: Column = None, name: str = "_mix") -> DataFrame:
    """Rows of ``docs`` once for each epoch that takes them, with a struct ``name``.

    ``weights`` is {"domain": {name: whole number}, "lang": ..., "source": ...}; the budget is
    ``share`` of all tokens. The struct holds domain, lang, source, epoch, n_tokens and take_tokens
    (fewer than n_tokens only for the last document of a leaf).
    """
    named = [domain if domain is not None else source_domain(F.col("source")), F.col("lang"), F.col("source")]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), token_count(F.col("text")).alias("_tokens"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit(NONE)).alias("_id"),
        *[F.coalesce(n.cast("string"), F.lit(NONE)).alias(level) for n, level in zip(named, LEVELS)],
    )
    slim = rows.select("_tokens", "_id", *LEVELS)
    leaves = slim.groupBy(*LEVELS).agg(F.sum("_tokens").alias("tokens"))
    # The bucket is the front of the place, so running totals over buckets come before those inside one.
    at = _placed(slim.filter("_tokens > 0"), epochs, seed).withColumn("_bucket", F.substring("_h", 1, 3))
    one = at.groupBy(*LEVELS, "epoch", "_bucket", "_h").agg(F.sum("_tokens").alias("_tokens"))
    order = ["epoch", "_bucket"]
    coarse = one.groupBy(*LEVELS, *order).agg(F.sum("_tokens").alias("_inside"))
    prior = Window.partitionBy(*LEVELS).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.withColumn("_before", F.coalesce(F.sum("_inside").over(prior), F.lit(0)))
    budgets = leaf_budgets(leaves, F.col("tokens") * F.lit(share), weights or {}, epochs).select(*LEVELS, "budget")
    # Only the bucket in which a leaf's budget ends is ordered.
    last = coarse.join(budgets, LEVELS).filter("_before < budget and _before + _inside >= budget")
    inside = Window.partitionBy(*LEVELS).orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    fine = one.join(last.select(*LEVELS, *order, "_before", "budget"), [*LEVELS, *order])
    fine = fine.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_tokens").over(inside), F.lit(0)))
    ends = fine.filter("_before < budget and _before + _tokens >= budget").select(*LEVELS, F.struct("epoch", "_h").alias("_end"), (F.col("budget") - F.col("_before")).alias("_part"))
    ends = budgets.filter("budget > 0").join(ends, LEVELS, "left").drop("budget")
    # A leaf without an end takes all its epochs.
    placed = _placed(rows.filter("_tokens > 0"), epochs, seed).join(ends, LEVELS)
    here = F.struct("epoch", "_h")
    taken = placed.filter(F.col("_end").isNull() | (here <= F.col("_end")))
    take = F.when(here == F.col("_end"), F.least("_tokens", "_part")).otherwise(F.col("_tokens"))
    return taken.select(
        "_row.*",
        F.struct(F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source"), "epoch", F.col("_tokens").alias("n_tokens"), take.alias("take_tokens")).alias(name),
    )


def mix_sql(weights: dict, share: float, epochs: int, seed: int, table: str = "documents") -> str:
    """The same in DuckDB's SQL, written as plain cumulative sums."""

    def weight(level):
        cases = " ".join(f"WHEN {level} = '{k}' THEN {int(v)}" for k, v in (weights.get(level[1:]) or {}).items())
        return f"CAST(CASE {cases} ELSE 1 END AS BIGINT)" if cases else "CAST(1 AS BIGINT)"

    keys = lambda i: ", ".join(["_root", *LEVELS[:i]])
    parts = [
        f"""r AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '{NONE}') AS _id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n, 0 AS _root,
  coalesce(CASE WHEN regexp_extract(source, '([0-9]+)$', 1) <> '' THEN ['web', 'books', 'code', 'talk'][CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4 + 1] ELSE 'other' END, 'other') AS _domain,
  coalesce(lang, '{NONE}') AS _lang, coalesce(source, '{NONE}') AS _source FROM {table})""",
        f"leaves AS (SELECT _root, _domain, _lang, _source, CAST(sum(n) AS BIGINT) AS tokens, CAST(sum(n) * {epochs} AS BIGINT) AS supply FROM r GROUP BY ALL)",
        f"a0 AS (SELECT _root, least(CAST(trunc(sum(tokens) * {share}::DOUBLE) AS BIGINT), CAST(sum(supply) AS BIGINT)) AS amount FROM leaves GROUP BY _root)",
    ]
    for i, level in enumerate(LEVELS):
        p, k = keys(i), keys(i + 1)
        parts.append(f"n{i} AS (SELECT {k}, CAST(sum(supply) AS BIGINT) AS c, {weight(level)} AS w FROM leaves GROUP BY {k})")
        parts.append(f"""f{i} AS (SELECT *, greatest(amount - fullc, 0) AS lft FROM (SELECT n{i}.*, amount,
  CAST(coalesce(sum(c) OVER (PARTITION BY {p} ORDER BY CASE WHEN w > 0 THEN c::DOUBLE / w ELSE 'inf'::DOUBLE END, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS fullc,
  CAST(sum(w) OVER (PARTITION BY {p} ORDER BY CASE WHEN w > 0 THEN c::DOUBLE / w ELSE 'inf'::DOUBLE END, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest,
  row_number() OVER (PARTITION BY {p} ORDER BY CASE WHEN w > 0 THEN c::DOUBLE / w ELSE 'inf'::DOUBLE END, {level}) AS pos FROM n{i} JOIN a{i} USING ({p})))""")
        parts.append(f"""a{i + 1} AS (SELECT {k}, CASE WHEN e.pos IS NOT NULL AND f.pos >= e.pos THEN (e.lft * f.w) // e.rest WHEN f.w > 0 THEN f.c WHEN e.pos IS NOT NULL THEN 0 ELSE least(f.c, f.lft) END AS amount
  FROM f{i} AS f LEFT JOIN (SELECT {p}, min(pos) AS pos, arg_min(lft, pos) AS lft, arg_min(rest, pos) AS rest FROM f{i} WHERE rest > 0 AND lft * w <= c * rest GROUP BY {p}) AS e USING ({p}))""")
    parts.append(f"placed AS (SELECT r.*, epoch, md5('{seed}|' || epoch || '|' || _id) AS h FROM r, (SELECT unnest(range({epochs})) AS epoch) WHERE n > 0)")
    parts.append("cum AS (SELECT placed.*, coalesce(sum(n) OVER (PARTITION BY _domain, _lang, _source ORDER BY epoch, h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) - sum(n) OVER (PARTITION BY _domain, _lang, _source, epoch, h) AS before FROM placed)")
    return "WITH " + ",\n".join(parts) + """
SELECT doc_id, _domain AS domain, _lang AS lang, _source AS source, CAST(epoch AS BIGINT) AS epoch, CAST(n AS BIGINT) AS n_tokens, CAST(least(n, amount - before) AS BIGINT) AS take_tokens
FROM cum JOIN a3 USING (_domain, _lang, _source) WHERE before < amount"""
