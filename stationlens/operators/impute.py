"""Imputation of originally missing readings, and the comparison of the methods."""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlens import schema as S
from stationlens.functions.columns import upper_name
from stationlens.functions.quantiles import attach_scalar, grouped_quantiles, join_on
from stationlens.operators.carry import carry
from stationlens.session import checkpointed

SERIES = ["sensor_id", "magnitude_name"]
TICK = [*SERIES, "entry_date"]
NOTE = "deviation from the provided interpolation, not absolute accuracy"


def select_subset(df: DataFrame, variable_type: str = None, magnitudes=None) -> DataFrame:
    """Optional case-insensitive restriction; derives ``was_missing`` where it is absent."""
    if "was_missing" not in df.columns:
        df = df.withColumn("was_missing", F.col("is_interpolated").cast("boolean"))
    if variable_type is not None:
        df = df.filter(F.lower("variable_type") == variable_type.lower())
    if magnitudes is not None:
        df = df.filter(F.upper("magnitude_name").isin([m.upper() for m in magnitudes]))
    return df


def mask_original_missing(df: DataFrame) -> DataFrame:
    """Keep the provided value apart and blank it where the source had none."""
    blank = F.coalesce("was_missing", F.lit(False))
    return df.withColumns(
        {
            "provided_interpolation": F.col("value"),
            "value_original_missing": F.when(~blank, F.col("value")),
        }
    )


def _central_values(masked, medians, **opts):
    """Mean and (if asked) exact median per series, variable and overall, from one pass.

    Values are counted per series first and the three groupings are made from the counts. The
    result has one row per series, variable and one for all, so it is written to a checkpoint and
    joined three times instead of being computed three times.
    """
    v = "value_original_missing"
    counted = masked.filter(F.col(v).isNotNull()).groupBy(*SERIES, v).agg(F.count(F.lit(1)).alias("_w"))
    tall = counted.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in range(3)]))).select(
        "_level", v, "_w", F.when(F.col("_level") == 0, F.col("sensor_id")).alias("sensor_id"),
        F.when(F.col("_level") <= 1, F.col("magnitude_name")).alias("magnitude_name"),
    )
    keys = ["_level", *SERIES]
    stats = tall.groupBy(*keys).agg(F.try_divide(F.sum(F.col(v) * F.col("_w")), F.sum("_w")).alias("_mean"))
    if medians:
        q = grouped_quantiles(tall, keys, v, {"_median": 0.5}, weight="_w", **opts).drop("n_values")
        stats = join_on(stats, q, keys)
    stats = checkpointed(stats)
    named = lambda level, suffix, *by: stats.filter(F.col("_level") == level).select(
        *by, *[F.col(c).alias(f"{c}_{suffix}") for c in stats.columns if c in ("_mean", "_median")]
    )
    every = named(2, "all")
    overall = every.agg(*[F.first(c).alias(c) for c in every.columns])  # one row also without any value
    return named(0, "series", *SERIES), named(1, "variable", "magnitude_name"), overall


def _fills(masked, methods, chunk, **opts):
    """One row per (series, timestamp) that has a gap, with the fill value of each method.

    Only these rows meet the fact rows again, so observed rows are never shuffled for filling.
    """
    v = F.col("value_original_missing")
    ticks = masked.groupBy(*TICK).agg(
        F.max(v).alias("_latest"), F.min(v).alias("_earliest"), F.count_if(v.isNull()).alias("_gaps")
    )
    local = {"imputed_ffill", "imputed_bfill", "imputed_last_next"} & set(methods)
    if local:
        ticks = carry(ticks, SERIES, "entry_date", last={"_prev": "_latest"}, next={"_next": "_earliest"}, chunk=chunk)
    out = ticks.filter("_gaps > 0")
    a, b, c = _central_values(masked, bool(local) or "imputed_grouped_median" in methods, **opts)
    out = attach_scalar(join_on(join_on(out, a, SERIES), b, ["magnitude_name"]), c)
    both = (F.col("_prev") + F.col("_next")) / 2 if local else None
    chains = {
        "imputed_grouped_mean": ["_mean_series", "_mean_variable", "_mean_all"],
        "imputed_grouped_median": ["_median_series", "_median_variable", "_median_all"],
        "imputed_ffill": ["_prev", "_median_series", "_median_all"],
        "imputed_bfill": ["_next", "_median_series", "_median_all"],
        "imputed_last_next": [both, "_prev", "_next", "_median_series", "_median_variable", "_median_all"],
    }
    return out.select(*TICK, *[F.coalesce(*chains[m]).alias(m) for m in methods])


def impute(masked: DataFrame, methods=S.METHODS, chunk: str = "month", **opts) -> DataFrame:
    """Add one column per method. Every input row is kept and observed values are unchanged.

    Rows of one timestamp are ordered by observed value, then missing ones. ``chunk`` is the
    calendar unit a long series is cut into; ``opts`` go to ``grouped_quantiles``.
    """
    methods = list(methods)
    v = F.col("value_original_missing")
    observed = masked.filter(v.isNotNull()).select("*", *[v.alias(m) for m in methods])
    gaps = masked.filter(v.isNull())
    filled = join_on(gaps, _fills(masked, methods, chunk, **opts), TICK)
    return observed.unionByName(filled.select(observed.columns))


def impute_grouped_mean(masked, **kw):
    return impute(masked, ["imputed_grouped_mean"], **kw)


def impute_grouped_median(masked, **kw):
    return impute(masked, ["imputed_grouped_median"], **kw)


def impute_ffill(masked, **kw):
    return impute(masked, ["imputed_ffill"], **kw)


def impute_bfill(masked, **kw):
    return impute(masked, ["imputed_bfill"], **kw)


def impute_last_next(masked, **kw):
    return impute(masked, ["imputed_last_next"], **kw)


def impute_all(df: DataFrame, **kw) -> DataFrame:
    return impute(mask_original_missing(df), S.METHODS, **kw)


def compare_imputations(imputed: DataFrame) -> DataFrame:
    """Originally missing rows with signed, absolute and squared error of each method."""
    ids = ["sensor_id", "sensor_name", "magnitude_name", "variable_type", "entry_date", "provided_interpolation", "was_missing", "is_interpolated"]
    present = [m for m in S.METHODS if m in imputed.columns]
    rows = imputed.filter(F.coalesce("was_missing", F.lit(False)))
    errors = []
    for m in present:
        e = F.col(m) - F.col("provided_interpolation")
        errors += [e.alias(f"error_{m}"), F.abs(e).alias(f"abs_error_{m}"), (e * e).alias(f"squared_error_{m}")]
    return rows.select(*[c for c in ids if c in imputed.columns], *present, *errors)


def method_errors(comparison: DataFrame, keys=()) -> DataFrame:
    """Long form: one row per comparison row and method, with its signed error."""
    cells = F.array(*[F.struct(F.lit(m).alias("method"), F.col(f"error_{m}").alias("error")) for m in S.METHODS])
    return (
        comparison.select(*keys, F.explode(cells).alias("r"))
        .select(*keys, "r.method", "r.error")
        .filter(F.col("error").isNotNull())
        .withColumn("abs_error", F.abs("error"))
    )


def _labels():
    return F.create_map(*[F.lit(x) for kv in S.METHOD_LABELS.items() for x in kv])


def _error_table(comparison, keys, full, **opts):
    by = [*keys, "method"]
    # Equal errors collapse to one counted row before any ordering.
    counted = method_errors(comparison, keys).groupBy(*by, "error", "abs_error").agg(F.count(F.lit(1)).alias("_w"))
    n = F.sum("_w")
    weighted = lambda c: F.try_divide(F.sum(c * F.col("_w")), n)
    base = counted.groupBy(*by).agg(
        n.alias("n_compared_rows"),
        weighted(F.col("error")).alias("mean_error"),
        weighted(F.col("abs_error")).alias("mae"),
        F.sqrt(weighted(F.col("error") * F.col("error"))).alias("rmse"),
        F.max("abs_error").alias("max_absolute_error"),
    )
    # Both medians come from one quantile computation: the measure is part of the group key.
    wanted = ["abs_error", "error"] if full else ["abs_error"]
    tall = counted.select(
        *by, "_w", F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("v")) for c in wanted])).alias("r")
    ).select(*by, "_w", "r.*")
    q = grouped_quantiles(tall, [*by, "measure"], "v", {"m": 0.5}, weight="_w", **opts).groupBy(*by).agg(
        F.max(F.when(F.col("measure") == "abs_error", F.col("m"))).alias("median_absolute_error"),
        F.max(F.when(F.col("measure") == "error", F.col("m"))).alias("median_error"),
    )
    out = join_on(base, q, by)
    head = [*keys, "method", F.try_element_at(_labels(), F.col("method")).alias("method_label"), "n_compared_rows", "mean_error"]
    if not full:
        return out.select(*head, "mae", "median_absolute_error", "rmse").orderBy(*keys, "mae", "method")
    return out.select(
        *head, "median_error", "mae", "median_absolute_error", "rmse", "max_absolute_error", F.lit(NOTE).alias("note")
    ).orderBy("mae", "method")


def imputation_error_summary(comparison, **opts):
    return _error_table(comparison, [], True, **opts)


def imputation_errors_by_type(comparison, **opts):
    return _error_table(comparison, ["variable_type"], False, **opts)


def imputation_errors_by_magnitude(comparison, **opts):
    return _error_table(comparison, ["variable_type", "magnitude_name"], False, **opts)


def value_series(imputed: DataFrame, keys=()) -> DataFrame:
    """(keys, series, v): observed values, the provided interpolation and the five methods."""
    missing = F.coalesce("was_missing", F.lit(False))
    pair = lambda name, c: F.struct(F.lit(name).alias("series"), F.col(c).alias("v"))
    of_gap = F.array(pair("provided_interpolation", "provided_interpolation"), *[pair(S.METHOD_LABELS[m], m) for m in S.METHODS])
    of_observed = F.array(pair("real_observed_values", "value_original_missing"))
    return (
        imputed.select(*keys, F.explode(F.when(missing, of_gap).otherwise(of_observed)).alias("r"))
        .select(*keys, "r.series", "r.v")
        .filter(F.col("v").isNotNull())
    )


def distribution_summary(imputed: DataFrame, **opts) -> DataFrame:
    """n, mean, std, min, max and seven exact quantiles of the seven series."""
    probs = {"q01": 0.01, "q05": 0.05, "q25": 0.25, "median": 0.5, "q75": 0.75, "q95": 0.95, "q99": 0.99}
    tall = value_series(imputed)
    base = tall.groupBy("series").agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max")
    )
    q = grouped_quantiles(tall, ["series"], "v", probs, **opts).drop("n_values")
    return join_on(base, q, ["series"]).select("series", "n", "mean", "std", "min", *probs, "max")


def sample_key(seed: int, *columns):
    """Text whose md5 decides the order of a reproducible sample."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *columns))


def _row_key(seed):
    return sample_key(seed, "sensor_id", "magnitude_name", F.date_format("entry_date", "yyyy-MM-dd HH:mm:ss"))


def reproducible_sample(df: DataFrame, n: int, seed: int = 42, by: str = None) -> DataFrame:
    """At most n rows (per ``by``, if given), the same ones whatever the partitioning."""
    order = [F.col("_key"), "sensor_id", "magnitude_name", "entry_date", "provided_interpolation"]
    keyed = df.withColumn("_key", _row_key(seed))
    if by is None:
        return keyed.orderBy(*order).limit(n).drop("_key")
    # Row numbers at most n are cut on the map side too, so a hot group is not gathered whole.
    w = Window.partitionBy(by).orderBy(*order)
    return keyed.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_key", "_rank")


_TERMS = 13  # moments of a bin
_REACH = 9.0  # bandwidths; beyond it a kernel is below 3e-18 of its peak


def density_curves(imputed: DataFrame, points: int = 1000) -> DataFrame:
    """Gaussian density per (variable, series) of the focus pollutants on an even grid.

    All gaps and observed values are used. Variables with fewer than 50
    gaps and series with fewer than 10 values or a single value are left out. The grid reaches
    half the value range beyond both ends; the bandwidth is std * n^(-1/5).

    Values fall into bins half a bandwidth wide, of which only the first ``_TERMS`` moments are
    kept, so the work grows with bins x grid points and not with distinct values. A kernel's sum
    over a bin is its Taylor series in those moments: with offsets of at most a quarter of a
    bandwidth the error of each value's kernel is below 1e-12 of its peak.
    """
    keys = ["magnitude_name", "series"]
    focus = imputed.filter(upper_name().isin(S.DENSITY_FOCUS))
    missing = F.coalesce("was_missing", F.lit(False))
    enough = (
        focus.groupBy("magnitude_name").agg(F.count_if(missing).alias("_gaps")).filter("_gaps >= 50").select("magnitude_name")
    )
    values = value_series(focus.join(enough, "magnitude_name", "left_semi"), ["magnitude_name"])
    first = values.groupBy(*keys).agg(
        F.count("v").alias("_n"), F.min("v").alias("_lo"), F.max("v").alias("_hi"), F.stddev_samp("v").alias("_std")
    ).filter("_n >= 10 AND _lo < _hi")
    stats = F.broadcast(first.select(  # a row per focus pollutant and series
        *keys, "_n", "_lo", (F.col("_std") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))).alias("_h"),
        (F.col("_lo") - (F.col("_hi") - F.col("_lo")) / 2).alias("_g0"),
        ((F.col("_hi") - F.col("_lo")) * 2 / (points - 1)).alias("_step"),
    ))
    binned = values.join(stats, keys).withColumn("_bin", F.round((F.col("v") - F.col("_lo")) / (F.col("_h") / 2)).cast("long"))
    offset = binned.withColumn("_u", (F.col("v") - F.col("_lo")) / F.col("_h") - F.col("_bin") / 2)
    damped = F.exp(-F.col("_u") * F.col("_u") / 2)
    moments = offset.groupBy(*keys, "_bin").agg(*[F.sum(damped * F.pow("_u", F.lit(k)) / math.factorial(k)).alias(f"_m{k}") for k in range(_TERMS)])
    # A bin reaches the grid points within _REACH bandwidths; every point has a row of its own too.
    middle = F.col("_lo") + F.col("_bin") * F.col("_h") / 2 - F.col("_g0")
    low = F.greatest(F.ceil((middle - _REACH * F.col("_h")) / F.col("_step")), F.lit(0)).cast("int")
    high = F.least(F.floor((middle + _REACH * F.col("_h")) / F.col("_step")), F.lit(points - 1)).cast("int")
    near = (
        moments.join(stats, keys).withColumns({"_from": low, "_to": high}).filter("_from <= _to")
        .withColumn("point", F.explode(F.sequence("_from", "_to")))
        .withColumn("_z", (F.col("_g0") + F.col("point") * F.col("_step") - F.col("_lo")) / F.col("_h") - F.col("_bin") / 2)
    )
    series = F.lit(0.0)
    for k in reversed(range(_TERMS)):
        series = series * F.col("_z") + F.col(f"_m{k}")
    part = near.select(*keys, "point", (series * F.exp(-F.col("_z") * F.col("_z") / 2)).alias("_k"))
    grid = first.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"), F.lit(0.0).alias("_k"))
    sums = part.unionByName(grid).groupBy(*keys, "point").agg(F.sum("_k").alias("_k"))
    return sums.join(stats, keys).select(
        *keys, "point", (F.col("_g0") + F.col("point") * F.col("_step")).alias("x"),
        (F.col("_k") / (F.col("_n") * F.col("_h") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"),
    )


def central_range(imputed: DataFrame, **opts) -> DataFrame:
    """The central 98 % of the observed values per variable, widened by a tenth of each bound."""
    seen = imputed.filter(~F.coalesce("was_missing", F.lit(False)))
    q = grouped_quantiles(seen, ["magnitude_name"], "value_original_missing", {"q01": 0.01, "q99": 0.99}, **opts)
    return q.filter("n_values > 10").select(
        "magnitude_name", "q01", "q99",
        (F.col("q01") - F.abs("q01") * 0.1).alias("range_low"),
        (F.col("q99") + F.abs("q99") * 0.1).alias("range_high"),
    )


def box_stats(comparison: DataFrame, **opts) -> DataFrame:
    """Quartiles of the absolute error per method over all rows and the whiskers within 1.5 IQR."""
    counted = (
        method_errors(comparison)
        .groupBy("method", "abs_error").agg(F.count(F.lit(1)).alias("_w"))
    )
    q = grouped_quantiles(counted, ["method"], "abs_error", {"q1": 0.25, "median": 0.5, "q3": 0.75}, weight="_w", **opts)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    x = F.col("abs_error")
    ends = counted.join(q, "method").groupBy("method").agg(
        F.min(F.when(x >= F.col("q1") - reach, x)).alias("whisker_low"),
        F.max(F.when(x <= F.col("q3") + reach, x)).alias("whisker_high"),
    )
    return q.join(ends, "method").select("method", "q1", "median", "q3", "whisker_low", "whisker_high")


def method_mae_bias(summary: DataFrame) -> DataFrame:
    """MAE and bias per method; the smallest MAE is flagged."""
    w = Window.orderBy("mae", "method")  # one row per method
    return summary.select(
        "method", "method_label", "mae", F.col("mean_error").alias("bias"), (F.row_number().over(w) == 1).alias("is_best")
    )


def method_mae_by_type(by_type: DataFrame) -> DataFrame:
    """MAE and bias per variable type and method; the smallest MAE of each type is flagged."""
    w = Window.partitionBy("variable_type").orderBy("mae", "method")  # one row per method
    return by_type.select(
        "variable_type", "method", "method_label", "mae", F.col("mean_error").alias("bias"), (F.row_number().over(w) == 1).alias("is_best")
    )
