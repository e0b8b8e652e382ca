"""Cycles, trends and seasonality of pollutants."""

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlens.functions.columns import normal_cdf, pearson, ratio
from stationlens.functions.quantiles import attach_scalar, summarize
from stationlens.functions.ranks import median_slope, sign_sum

SENSOR = ["magnitude_name", "sensor_id", "sensor_name"]


def _candidates(df, include_interpolated):
    out = df.filter(F.lower("variable_type") == "pollutant")
    return out if include_interpolated else out.filter(~F.coalesce("is_interpolated", F.lit(False)))


def selected_pollutants(df: DataFrame, magnitudes=None, top_n: int = 3, include_interpolated: bool = True) -> DataFrame:
    """The pollutants to analyse and why: named by the user, or the most frequent ones."""
    counts = _candidates(df, include_interpolated).groupBy(F.col("magnitude_name").alias("selected_magnitude")).agg(F.count(F.lit(1)).alias("n"))
    if magnitudes is not None:
        chosen, reason = counts.filter(F.upper("selected_magnitude").isin([m.upper() for m in magnitudes])), "user_selected"
    else:
        chosen, reason = counts.orderBy(F.desc("n"), "selected_magnitude").limit(top_n), "top_pollutant_by_row_count"
    return chosen.select("selected_magnitude", F.lit(reason).alias("selection_reason"))


def select_temporal_subset(df: DataFrame, magnitudes=None, top_n: int = 3, include_interpolated: bool = True) -> DataFrame:
    rows = _candidates(df, include_interpolated)
    if magnitudes is not None:
        return rows.filter(F.upper("magnitude_name").isin([m.upper() for m in magnitudes]))
    names = selected_pollutants(df, None, top_n, include_interpolated)
    # At most top_n names.
    return rows.join(F.broadcast(names.select(F.col("selected_magnitude").alias("magnitude_name"))), "magnitude_name", "left_semi")


def monthly_by_sensor(df: DataFrame, **opts) -> DataFrame:
    """Statistics per sensor and month, labelled by month end."""
    data = df.withColumn("_month", F.last_day("entry_date"))
    aggs = [F.avg("value").alias("mean_value"), F.stddev_samp("value").alias("std_value"), F.count("value").alias("n_observations")]
    out = summarize(data, [*SENSOR, "_month"], "value", aggs, {"median_value": 0.5}, **opts)
    return out.select(*SENSOR, F.col("_month").alias("month"), "mean_value", "median_value", "std_value", "n_observations")


def monthly_overall(monthly: DataFrame, **opts) -> DataFrame:
    """Across sensors: statistics of the sensors' monthly means."""
    aggs = [
        F.avg("mean_value").alias("mean_across_sensors"), F.stddev_samp("mean_value").alias("std_across_sensors"),
        F.countDistinct("sensor_id").alias("n_sensors"),
    ]
    out = summarize(monthly, ["magnitude_name", "month"], "mean_value", aggs, {"median_across_sensors": 0.5}, **opts)
    return out.select("magnitude_name", "month", "mean_across_sensors", "median_across_sensors", "std_across_sensors", "n_sensors")


def _cycle(df, name, part, **opts):
    data = df.withColumn("_part", part)
    aggs = [F.avg("value").alias("mean_value"), F.count("value").alias("n_observations")]
    out = summarize(data, [*SENSOR, "_part"], "value", aggs, {"median_value": 0.5}, **opts)
    return out.select(*SENSOR, F.col("_part").alias(name), "mean_value", "median_value", "n_observations")


def hourly_cycle(df, **opts):
    return _cycle(df, "hour", F.hour("entry_date"), **opts)


def weekday_cycle(df, **opts):
    return _cycle(df, "weekday", F.weekday("entry_date"), **opts)


def seasonal_cycle(df, **opts):
    return _cycle(df, "month", F.month("entry_date"), **opts)


def yearly_trends(df, **opts):
    return _cycle(df, "year", F.year("entry_date"), **opts)


def station_trend_slopes(monthly: DataFrame) -> DataFrame:
    """Least-squares slope of monthly means on their position; null for fewer than two months."""
    # One row per month in each window: a series of a century has 1200.
    w = Window.partitionBy(*SENSOR).orderBy("month")
    placed = monthly.filter(F.col("mean_value").isNotNull()).withColumn("_x", (F.row_number().over(w) - 1).cast("double"))
    return placed.groupBy(*SENSOR).agg(F.regr_slope("mean_value", "_x").alias("monthly_trend_slope"))


def trend_stability(slopes: DataFrame, **opts) -> DataFrame:
    s = "monthly_trend_slope"
    aggs = [
        F.avg(s).alias("mean_station_slope"), F.stddev_samp(s).alias("std_station_slope"),
        F.min(s).alias("min_station_slope"), F.max(s).alias("max_station_slope"), F.count(s).alias("n_sensors"),
    ]
    out = summarize(slopes, ["magnitude_name"], s, aggs, {"median_station_slope": 0.5}, **opts)
    return out.select("magnitude_name", "mean_station_slope", "median_station_slope", "std_station_slope", "min_station_slope", "max_station_slope", "n_sensors")


_TREND_SCHEMA = "magnitude_name string, n int, s bigint, slope double"


def _rank_trend(pdf: pd.DataFrame) -> pd.DataFrame:
    """Mann-Kendall S and Theil-Sen slope of one series of calendar months."""
    x = pdf.sort_values(["month", "mean_across_sensors"])["mean_across_sensors"].to_numpy(float)
    return pd.DataFrame({"magnitude_name": [pdf["magnitude_name"].iloc[0]], "n": [len(x)], "s": [sign_sum(x, 1e-9)], "slope": [median_slope(x)]})


def _trends(overall, min_months):
    """(magnitude_name, n, s, slope) of the series with enough months: n log n work, no table of month pairs."""
    known = overall.filter(F.col("mean_across_sensors").isNotNull()).select("magnitude_name", "month", "mean_across_sensors")
    return known.groupBy("magnitude_name").applyInPandas(_rank_trend, _TREND_SCHEMA).filter(F.col("n") >= min_months)


def theil_sen(overall: DataFrame, min_months: int = 8) -> DataFrame:
    """Median slope per month over all pairs of months."""
    return _trends(overall, min_months).select("magnitude_name", F.bround("slope", 6).alias("theil_sen_slope_per_month"), F.col("n").alias("n_months"))


def mann_kendall(overall: DataFrame, min_months: int = 8) -> DataFrame:
    """Mann-Kendall trend test (no tie correction) and Theil-Sen slope of the city-wide series.

    Means are sums of floating-point numbers in no fixed order, so months that differ by less
    than 1e-9 (after rounding to it) count as equal; otherwise the statistic would change from
    run to run.
    """
    n = F.col("n").cast("double")
    spread = F.sqrt(n * (n - 1) * (2 * n + 5) / 18)
    tested = _trends(overall, min_months).withColumns(
        {"z": (F.col("s") - F.signum(F.col("s").cast("double"))) / spread, "tau": F.col("s") / (0.5 * n * (n - 1))}
    ).withColumn("p", 2 * (1 - normal_cdf(F.abs("z"))))
    return tested.select(
        "magnitude_name", F.col("s").alias("mk_s"),
        F.bround("tau", 4).alias("mk_tau"), F.bround("z", 4).alias("mk_z"), F.bround("p", 4).alias("mk_p_value"),
        (F.col("p") < 0.05).alias("mk_significant"),
        F.when(F.col("tau") < 0, "decreasing").when(F.col("tau") > 0, "increasing").otherwise("no trend").alias("trend_direction"),
        F.bround("slope", 6).alias("theil_sen_slope_per_month"),
        F.col("n").alias("n_months"),
    ).orderBy("mk_tau", "magnitude_name")


def cycle_overall(cycle: DataFrame, key: str) -> DataFrame:
    """Mean over sensors of a sensor cycle."""
    return cycle.groupBy("magnitude_name", key).agg(F.avg("mean_value").alias("mean_value"))


def cycle_strength(hourly: DataFrame, seasonal: DataFrame) -> DataFrame:
    """Range of the city-wide daily and seasonal cycles."""
    def reach(cycle, key, name):
        return cycle_overall(cycle, key).groupBy("magnitude_name").agg(
            F.min("mean_value").alias(f"{name}_min"), F.max("mean_value").alias(f"{name}_max")
        ).withColumn(f"{name}_amplitude", F.col(f"{name}_max") - F.col(f"{name}_min"))

    return reach(hourly, "hour", "hourly").join(reach(seasonal, "month", "seasonal"), "magnitude_name", "full")


def autocorrelation(overall: DataFrame, lags=(12, 6, 1), min_months: int = 13) -> DataFrame:
    """Correlation of each monthly series with itself shifted by each lag."""
    w = Window.partitionBy("magnitude_name").orderBy("month")  # one row per month
    v = "mean_across_sensors"
    shifted = overall.filter(F.col(v).isNotNull()).select("magnitude_name", v, *[F.lag(v, k).over(w).alias(f"_l{k}") for k in lags])
    return (
        shifted.groupBy("magnitude_name")
        .agg(*[pearson(v, f"_l{k}").alias(f"acf_lag{k}") for k in lags], F.count(F.lit(1)).alias("n_months"))
        .filter(F.col("n_months") >= min_months)
        .orderBy(F.desc(f"acf_lag{lags[0]}"), "magnitude_name")
    )


def station_year_matrix(monthly: DataFrame, magnitude: str, top: int = 10) -> DataFrame:
    """Yearly means of the stations with the highest mean level; ``rank`` orders the stations."""
    one = monthly.filter(F.col("magnitude_name") == magnitude)
    names = one.groupBy("sensor_name").agg(F.avg("mean_value").alias("_m")).orderBy(F.desc("_m"), "sensor_name").limit(top)
    cells = (
        one.join(F.broadcast(names.select("sensor_name")), "sensor_name", "left_semi")
        .groupBy("sensor_name", F.year("month").alias("year")).agg(F.avg("mean_value").alias("mean_value"))
    )
    means = cells.groupBy("sensor_name").agg(F.avg("mean_value").alias("station_mean"))
    ranked = means.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("station_mean"), "sensor_name")))  # at most ``top`` rows
    return cells.join(ranked, "sensor_name").select("sensor_name", "year", "mean_value", "station_mean", "rank")


def seasonal_anticorrelation(overall: DataFrame, a: str = "NO2", b: str = "O3", min_months: int = 3) -> DataFrame:
    """Correlation of two pollutants' mean calendar-month profiles."""
    def profile(name, out):
        return overall.filter(F.upper("magnitude_name") == name.upper()).groupBy(F.month("month").alias("cal_month")).agg(
            F.avg("mean_across_sensors").alias(out)
        )

    return (
        profile(a, "_a").join(profile(b, "_b"), "cal_month")
        .agg(pearson("_a", "_b").alias("pearson_r"), F.count(F.lit(1)).alias("n_common_months"))
        .filter(F.col("n_common_months") >= min_months)
        .select(F.lit(a).alias("magnitude_a"), F.lit(b).alias("magnitude_b"), "pearson_r", "n_common_months")
    )


def yearly_overall(overall: DataFrame) -> DataFrame:
    return overall.groupBy("magnitude_name", F.year("month").alias("year")).agg(F.avg("mean_across_sensors").alias("mean_across_sensors"))


def period_change(yearly: DataFrame, before=(2017, 2019), after=(2020, 2021)) -> DataFrame:
    """Change in percent of the mean of yearly means between two spans of years, bounds included."""
    mean = lambda span: F.avg(F.when(F.col("year").between(*span), F.col("mean_across_sensors")))
    out = yearly.groupBy("magnitude_name").agg(mean(before).alias("mean_before"), mean(after).alias("mean_after"))
    return out.withColumn("pct_change", ratio(F.col("mean_after") - F.col("mean_before"), "mean_before") * 100)


def temporal_interpretation(acf: DataFrame, cycles: DataFrame, trends: DataFrame) -> DataFrame:
    """Seasonality label, amplitudes and trend per pollutant, rounded for reading."""
    r = F.col("acf_lag12")
    label = F.when(r >= 0.7, "very strong").when(r >= 0.5, "strong").when(r >= 0.3, "moderate").otherwise("weak")
    return (
        acf.join(cycles, "magnitude_name", "left").join(trends, "magnitude_name", "left")
        .select(
            "magnitude_name", F.bround(r, 3).alias("acf_lag12"), label.alias("seasonality_strength"),
            F.bround("hourly_amplitude", 2).alias("hourly_amplitude"), F.bround("seasonal_amplitude", 2).alias("seasonal_amplitude"),
            F.bround("mk_tau", 3).alias("mk_tau"), "mk_p_value", "trend_direction",
            F.bround("theil_sen_slope_per_month", 4).alias("theil_sen_slope_per_month"),
        )
    )


def trend_groups(trends: DataFrame, acf: DataFrame, strong: float = 0.5) -> DataFrame:
    """Names and numbers of pollutants by trend direction, significance and strong seasonality."""
    def names(cond, c="magnitude_name"):
        return F.array_join(F.array_sort(F.collect_list(F.when(cond, F.col(c)))), ", ")

    d = F.col("trend_direction")
    left = trends.agg(
        F.count_if(d == "decreasing").alias("n_improving"), names(d == "decreasing").alias("improving"),
        F.count_if(d == "increasing").alias("n_worsening"), names(d == "increasing").alias("worsening"),
        F.count_if("mk_significant").alias("n_significant"),
    )
    right = acf.agg(names(F.col("acf_lag12") >= strong).alias("strong_seasonality"))
    return attach_scalar(left, right)
