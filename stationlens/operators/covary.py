"""Correlations between variables inside (year, sensor) cells, and what they have in common."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlens.functions.columns import is_pollutant, pearson, ratio, variable_type
from stationlens.functions.quantiles import summarize

CELL = ["year", "sensor_id"]


def cell_grid(df: DataFrame, max_years: int = None) -> DataFrame:
    """Every year with every sensor (both lists are short), for cells without a result."""
    years = df.select("year").distinct()
    if max_years is not None:
        years = years.orderBy("year").limit(max_years)
    # The catalogue of years is one array of at most a few hundred entries.
    catalogue = years.agg(F.array_sort(F.collect_list("year")).alias("_years")).withColumn("_one", F.lit(1))
    sensors = df.select("sensor_id").distinct().withColumn("_one", F.lit(1))
    return sensors.join(F.broadcast(catalogue), "_one").select(F.explode("_years").alias("year"), "sensor_id")


def hourly_wide(df: DataFrame) -> DataFrame:
    """Mean per (year, sensor, timestamp, variable), kept long."""
    return df.groupBy(*CELL, "entry_date", "magnitude_name").agg(F.avg("value").alias("value"))


def cell_eligibility(hourly: DataFrame, min_hours: int = 24) -> DataFrame:
    """Hours and variables per cell; eligible with two variables and enough distinct hours."""
    out = hourly.groupBy(*CELL).agg(
        F.countDistinct("entry_date").alias("n_hours"), F.array_sort(F.collect_set("magnitude_name")).alias("variables")
    )
    return out.withColumn("eligible", (F.size("variables") >= 2) & (F.col("n_hours") >= min_hours))


def cell_correlations(df: DataFrame, min_hours: int = 24) -> DataFrame:
    """Correlation of each pair of variables in each eligible cell, over their common hours.

    Readings of one hour meet as one short row (at most one value per variable of the
    catalogue). Pairs are made inside that row and aggregated before they are shuffled.
    """
    hour = hourly_wide(df).groupBy(*CELL, "entry_date").agg(
        F.array_sort(F.collect_list(F.struct("magnitude_name", "value"))).alias("m")
    )
    # Eligibility from the same short rows: a cell's distinct hours and variables.
    enough = hour.groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("_hours"),
        F.min(F.get("m", F.lit(0))["magnitude_name"]).alias("_first"), F.max(F.element_at("m", -1)["magnitude_name"]).alias("_last"),
    ).filter((F.col("_hours") >= min_hours) & (F.col("_first") < F.col("_last"))).select(*CELL)
    n = F.size("m")
    pairs = F.flatten(
        F.transform(
            F.sequence(F.lit(0), n - 2),
            lambda i: F.transform(
                F.slice("m", i + 2, n - i - 1),
                lambda b: F.struct(
                    F.get("m", i)["magnitude_name"].alias("var_a"), b["magnitude_name"].alias("var_b"),
                    F.get("m", i)["value"].alias("a"), b["value"].alias("b"),
                ),
            ),
        )
    )
    met = hour.filter(n >= 2).select(*CELL, F.explode(pairs).alias("p")).select(*CELL, "p.*")
    out = met.groupBy(*CELL, "var_a", "var_b").agg(pearson("a", "b").alias("correlation"), F.count(F.lit(1)).alias("n_common_hours"))
    return out.join(enough, CELL, "left_semi").filter(F.col("correlation").isNotNull())


def flatten_pairs(cells: DataFrame) -> DataFrame:
    label = F.concat_ws(" ↔ ", F.least("var_a", "var_b"), F.greatest("var_a", "var_b"))
    return cells.select(*CELL, "var_a", "var_b", label.alias("pair"), "correlation", F.abs("correlation").alias("abs_correlation"))


def stable_strong(pairs: DataFrame, threshold: float = 0.6, **opts) -> DataFrame:
    """Pairs whose median absolute correlation over all cells reaches the threshold."""
    c = "abs_correlation"
    aggs = [F.avg(c).alias("mean_abs_corr"), F.stddev_samp(c).alias("std_abs_corr"), F.count(c).alias("n_observations"), F.countDistinct("year").alias("n_years")]
    out = summarize(pairs, ["pair"], c, aggs, {"median_abs_corr": 0.5}, **opts)
    return out.filter(F.col("median_abs_corr") >= threshold).select(
        F.col("pair").alias("pair_str"), "median_abs_corr", "mean_abs_corr", "std_abs_corr", "n_observations", "n_years"
    ).orderBy(F.desc("median_abs_corr"), "pair_str")


def stable_pairs(pairs: DataFrame, threshold: float = 0.6, stability: float = 0.8, **opts) -> DataFrame:
    """Pairs above the threshold in at least a share ``stability`` of their cells."""
    c = "abs_correlation"
    aggs = [
        F.count(c).alias("n_cells"), F.count_if(F.col(c) >= threshold).alias("n_above"), F.avg(c).alias("mean_abs_corr"), F.stddev_samp(c).alias("std_abs_corr"),
        F.countDistinct("year").alias("n_years"), F.countDistinct("sensor_id").alias("n_sensors"), F.avg("correlation").alias("mean_signed_corr"),
    ]
    out = summarize(pairs, ["pair"], c, aggs, {"median_abs_corr": 0.5}, **opts).withColumn("stability_frac", ratio("n_above", "n_cells"))
    return out.filter(F.col("stability_frac") >= stability).select(
        F.col("pair").alias("pair_str"), "n_cells", "n_above", "median_abs_corr", "mean_abs_corr", "std_abs_corr", "n_years", "n_sensors", "mean_signed_corr", "stability_frac"
    ).orderBy(F.desc("stability_frac"), F.desc("median_abs_corr"), "pair_str")


def yearly_pct_above(pairs: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Share of pairs above the threshold per year, in percent."""
    return pairs.groupBy("year").agg((F.avg(F.when(F.col("abs_correlation") >= threshold, 1.0).otherwise(0.0)) * 100).alias("pct_above_threshold")).orderBy("year")


def _sides(pairs):
    """Each pair seen from both ends: (side, variable, other, correlation)."""
    ends = F.array(
        F.struct(F.lit("a").alias("side"), F.col("var_a").alias("variable"), F.col("var_b").alias("other")),
        F.struct(F.lit("b").alias("side"), F.col("var_b").alias("variable"), F.col("var_a").alias("other")),
    )
    return pairs.select("correlation", F.explode(ends).alias("e")).select("e.*", "correlation")


def pollution_association(pairs: DataFrame) -> DataFrame:
    """Mean correlation of weather and traffic variables with pollutants.

    The means as first and as second variable of a pair are averaged without weights.
    """
    side_means = _sides(pairs).filter(is_pollutant("other")).groupBy("variable", "side").agg(F.avg("correlation").alias("_m"))
    out = side_means.groupBy("variable").agg(F.avg("_m").alias("mean_signed_corr_with_pollutants"))
    return (
        out.filter(~is_pollutant("variable")).withColumn("mean_abs_corr_with_pollutants", F.abs("mean_signed_corr_with_pollutants"))
        .orderBy(F.desc("mean_abs_corr_with_pollutants"), "variable")
    )


def pollutant_drivers(pairs: DataFrame, target: str = "NO2") -> DataFrame:
    """Mean and spread over cells of each variable's correlation with ``target``."""
    name = target.strip().upper()
    category = F.initcap(variable_type("variable"))
    return (
        _sides(pairs).filter((F.upper("other") == name) & (F.upper("variable") != name))
        .groupBy("variable").agg(F.avg("correlation").alias("mean_r"), F.stddev_samp("correlation").alias("std_r"), F.count("correlation").alias("n_cells"))
        .withColumn("category", F.when(category == "Unknown", "Other").otherwise(category)).orderBy("mean_r", "variable")
    )


def driver_top_k(drivers: DataFrame, k: int = 3) -> DataFrame:
    """The k strongest variables per category and sign."""
    signed = drivers.withColumn("sign", F.signum("mean_r").cast("int")).filter("sign <> 0")
    w = Window.partitionBy("category", "sign").orderBy(F.desc(F.abs("mean_r")), "variable")
    return signed.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("category", "sign", "rank", "variable", "mean_r")
