"""Exact quantiles for groups of any size.

``percentile`` keeps every distinct value of a group in one task. That is right for the many
small groups and wrong for a group that holds a third of the table, so groups are split by
size: small ones use ``percentile`` over (value, count) pairs, large ones are cut into value
ranges, and only the ranges that hold a wanted rank are ordered.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def grouped_quantiles(
    df: DataFrame, keys, value: str, probs: dict, weight: str = None,
    split: bool = True, max_distinct: int = 1_000_000, ranges: int = 256,
) -> DataFrame:
    """One row per group with linearly interpolated quantiles ``probs`` = {column: p} and ``n_values``.

    ``weight`` names a column with the number of copies of each row (all rows count once without
    it). ``split`` treats large groups apart; only a caller that knows all groups to be small sets it False.
    ``max_distinct`` is the number of distinct values above which a group counts as large.
    """
    keys = list(keys)
    gk = [f"_k{i}" for i in range(len(keys))] or ["_all"]
    base = df.filter(F.col(value).isNotNull()).select(
        *([F.col(k).alias(g) for k, g in zip(keys, gk)] or [F.lit(1).alias("_all")]),
        F.col(value).cast("double").alias("_v"),
        (F.col(weight) if weight else F.lit(1)).cast("long").alias("_w"),
    )
    names, ps = list(probs), [float(p) for p in probs.values()]
    if not split:
        out = _percentiles(base, gk, names, ps, "_w")
        return out.select(*[F.col(g).alias(k) for k, g in zip(keys, gk)], *names, "n_values")
    # Map-side combined: copies of a value collapse before the shuffle.
    counts = base.groupBy(*gk, "_v").agg(F.sum("_w").alias("_n"))
    large = (
        counts.groupBy(*gk)
        .agg(F.count(F.lit(1)).alias("_distinct"), F.sum("_n").alias("_total"))
        .filter(F.col("_distinct") > max_distinct)
    )
    flat = large.select(*[F.col(g).alias(f"_l{g}") for g in gk])
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_l{g}")) for g in gk])
    small = _percentiles(counts.join(flat, on, "left_anti"), gk, names, ps, "_n")
    out = small.unionByName(_large_quantiles(counts, large, gk, names, ps, ranges))
    return out.select(*[F.col(g).alias(k) for k, g in zip(keys, gk)], *names, "n_values")


def _percentiles(rows, gk, names, ps, weight):
    agg = rows.groupBy(*gk).agg(
        F.percentile("_v", F.array(*[F.lit(p) for p in ps]), F.col(weight)).alias("_q"), F.sum(weight).alias("n_values")
    )
    return agg.select(*gk, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)], "n_values")


def _large_quantiles(counts, large, gk, names, ps, ranges):
    """Quantiles of the groups in ``large`` by range cut and local ranking."""
    wanted = large.select(*[F.col(g).alias(f"_l{g}") for g in gk], "_total")
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_l{g}")) for g in gk])
    rows = counts.join(wanted, on).drop(*[f"_l{g}" for g in gk])
    # A mergeable sketch gives range borders; its error moves borders only, never the result.
    cuts = rows.groupBy(*gk).agg(
        F.percentile_approx(
            "_v", F.array(*[F.lit(i / ranges) for i in range(1, ranges)]), F.lit(20 * ranges)
        ).alias("_cuts")
    )
    named = cuts.select(*[F.col(g).alias(f"_l{g}") for g in gk], "_cuts")
    ranged = rows.join(named, on).drop(*[f"_l{g}" for g in gk])
    ranged = ranged.withColumn(
        "_range", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    ).drop("_cuts")
    totals = ranged.groupBy(*gk, "_range", "_total").agg(F.sum("_n").alias("_in_range"))
    order = Window.partitionBy(*gk).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_in_range").over(order), F.lit(0)))
    position = [(F.col("_total") - 1) * F.lit(p) for p in ps]
    ranks = F.array(*[f(x).cast("long") for x in position for f in (F.floor, F.ceil)])
    needed = totals.filter(
        F.exists(
            ranks,
            lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_in_range")),
        )
    ).select(*[F.col(g).alias(f"_l{g}") for g in gk], F.col("_range").alias("_lrange"), "_before")
    local = Window.partitionBy(*gk, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        ranged.join(needed, on & (F.col("_range") == F.col("_lrange")))
        .withColumn("_cum", F.sum("_n").over(local) + F.col("_before"))
    )
    aggs = []
    for i, x in enumerate(position):
        aggs.append(F.min(F.when(F.col("_cum") > F.floor(x), F.col("_v"))).alias(f"_lo{i}"))
        aggs.append(F.min(F.when(F.col("_cum") > F.ceil(x), F.col("_v"))).alias(f"_hi{i}"))
    picked = ranked.groupBy(*gk, "_total").agg(*aggs)
    return picked.select(
        *gk,
        *[
            (
                F.col(f"_lo{i}")
                + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (x - F.floor(x))
            ).alias(n)
            for i, (x, n) in enumerate(zip(position, names))
        ],
        F.col("_total").alias("n_values"),
    )


def join_on(left: DataFrame, right: DataFrame, keys, how="left") -> DataFrame:
    """Join on keys that may be null on both sides (null equals null); keeps the left key columns."""
    keys = list(keys)
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a table of exactly one row (a global aggregate) to every row."""
    left = df.withColumn("_one", F.lit(1))
    return left.join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one").drop("_one")


def summarize(df: DataFrame, keys, value: str, aggs, probs: dict, split: bool = True, **opts) -> DataFrame:
    """Aggregates ``aggs`` and quantiles ``probs`` of ``value`` per group.

    Without ``split`` one aggregation does all; otherwise the quantiles come from ``grouped_quantiles``.
    """
    keys = list(keys)
    if not split:
        q = F.percentile(F.col(value), F.array(*[F.lit(float(p)) for p in probs.values()]))
        out = df.groupBy(*keys).agg(*aggs, q.alias("_q"))
        return out.select("*", *[F.col("_q")[i].alias(n) for i, n in enumerate(probs)]).drop("_q")
    q = grouped_quantiles(df, keys, value, probs, split=split, **opts).drop("n_values")
    return join_on(df.groupBy(*keys).agg(*aggs), q, keys)
