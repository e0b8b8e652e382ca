"""Missingness and data quality of cleaned readings."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlens import schema as S
from stationlens.functions.columns import (
    count_true, is_pollutant, is_traffic, mean_flag, ratio, upper_name,
)
from stationlens.functions.quantiles import attach_scalar, grouped_quantiles, join_on
from stationlens.operators.carry import carry
from stationlens.operators.profile import schema_profile, value_histogram


def reconstruct_missingness(df: DataFrame) -> DataFrame:
    """An interpolated row was missing at the source; an unknown flag stays unknown."""
    return df.withColumns(
        {
            "was_missing": F.col("is_interpolated").cast("boolean"),
            "missing_flag_unknown": F.col("is_interpolated").isNull(),
        }
    )


def missingness_by_column(df: DataFrame) -> DataFrame:
    return schema_profile(df).orderBy(F.desc("missing_rate"), "column")


def missingness_by(df: DataFrame, *keys) -> DataFrame:
    """Rate over known flags, missing rows, known rows and all rows per key."""
    return df.groupBy(*keys).agg(
        mean_flag("was_missing").alias("original_missing_rate"),
        count_true("was_missing").alias("originally_missing_rows"),
        F.count("was_missing").alias("known_flag_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def _worst_first(df, *keys):
    return df.orderBy(F.desc_nulls_last("original_missing_rate"), *keys)


def missingness_by_type(df):
    return _worst_first(missingness_by(df, "variable_type"), "variable_type")


def missingness_by_pollutant(df):
    only = df.filter(F.col("variable_type") == "pollutant")
    return _worst_first(missingness_by(only, "magnitude_name"), "magnitude_name")


def missingness_by_magnitude(df):
    keys = ("variable_type", "magnitude_name")
    return _worst_first(missingness_by(df, *keys), *keys)


def missingness_by_sensor(df):
    keys = ("sensor_id", "sensor_name")
    return _worst_first(missingness_by(df, *keys), *keys)


def missingness_by_sensor_variable(df):
    keys = ("sensor_id", "sensor_name", "magnitude_name")
    return _worst_first(missingness_by(df, *keys), *keys)


def missingness_daily(df):
    return missingness_by(df, F.to_date("entry_date").alias("date")).orderBy("date")


def missingness_monthly(df):
    return missingness_by(df, F.date_format("entry_date", "yyyy-MM").alias("year_month")).orderBy("year_month")


def missingness_by_hour(df):
    return missingness_by(df, F.hour("entry_date").alias("hour")).orderBy("hour")


def missingness_by_year_type(df):
    return missingness_by(df, F.year("entry_date").alias("year"), "variable_type").orderBy("year", "variable_type")


def missing_gaps(df: DataFrame, drop_unanchored: bool = False, chunk: str = "month") -> DataFrame:
    """Runs of originally missing rows per (sensor, variable), longest first.

    Rows of one timestamp count as known-observed, unknown, missing, in that order. So every
    timestamp with a row that is not missing ends the run before it, and a run is the set of
    missing rows after the same such timestamp. ``drop_unanchored`` leaves out the first
    missing row of a series and the one right after an unknown flag, because there a
    null-propagating comparison cannot tell that a run begins.
    """
    series = ["sensor_id", "sensor_name", "magnitude_name"]
    missing = F.coalesce("was_missing", F.lit(False))
    ticks = df.groupBy(*series, "entry_date").agg(
        F.count_if(missing).alias("_m"),
        F.count_if(~missing).alias("_kept"),
        F.count_if(F.col("was_missing").isNull()).alias("_u"),
    )
    ticks = ticks.withColumns(
        {
            "_break": F.when(F.col("_kept") > 0, F.col("entry_date")),
            # What the last row of the timestamp is: M missing, U unknown, K known and observed.
            "_ending": F.when(F.col("_m") > 0, "M").when(F.col("_u") > 0, "U").otherwise("K"),
        }
    )
    runs = carry(ticks, series, "entry_date", last={"_run": "_break"}, chunk=chunk)
    if drop_unanchored:
        # The row before the first missing row of a run is the last row of the breaking timestamp.
        unknown_break = F.when((F.col("_kept") > 0) & (F.col("_u") > 0), F.col("entry_date"))
        ticks2 = ticks.withColumn("_ubreak", unknown_break)
        runs = carry(ticks2, series, "entry_date", last={"_run": "_break", "_urun": "_ubreak"}, chunk=chunk)
        unanchored = F.col("_run").isNull() | (F.col("_run") == F.col("_urun"))
        first = runs.filter("_m > 0").groupBy(*series, "_run").agg(F.min("entry_date").alias("_first"))
        runs = join_on(runs.filter("_m > 0"), first, [*series, "_run"]).withColumn(
            "_m", F.col("_m") - F.when(unanchored & (F.col("entry_date") == F.col("_first")), 1).otherwise(0)
        )
    return (
        runs.filter("_m > 0")
        .groupBy(*series, "_run")
        .agg(
            F.min("entry_date").alias("gap_start"),
            F.max("entry_date").alias("gap_end"),
            F.sum("_m").alias("n_consecutive_missing_rows"),
        )
        .drop("_run")
        .orderBy(F.desc("n_consecutive_missing_rows"), "sensor_id", "magnitude_name", "gap_start")
    )


def invalid_values(df: DataFrame) -> DataFrame:
    """Six plausibility checks as (issue, n_rows, rate), from one pass plus one key count."""
    name, v = upper_name(), F.col("value")
    non_negative = is_pollutant() | name.isin(S.NON_NEGATIVE_WEATHER) | is_traffic()
    checks = {
        "negative_values_for_non_negative_variables": non_negative & (v < 0),
        "relative_humidity_outside_0_100": (name == "HR") & ((v < 0) | (v > 100)),
        "wind_direction_outside_0_360": (name == "DV") & ((v < 0) | (v > 360)),
        "missing_coordinates": F.col("utm_x").isNull() | F.col("utm_y").isNull(),
        "unknown_interpolation_flags": F.col("missing_flag_unknown"),
    }
    # Checks are counted inside the key count, so the table is shuffled once, pre-aggregated.
    per_key = df.groupBy("sensor_id", "magnitude_name", "entry_date").agg(
        F.count(F.lit(1)).alias("_n"), *[count_true(c).alias(i) for i, c in checks.items()]
    )
    totals = per_key.agg(
        F.sum("_n").alias("_all"),
        F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("duplicate_sensor_variable_timestamp_rows"),
        *[F.sum(i).alias(i) for i in checks],
    )
    rows = F.array(*[F.struct(F.lit(i).alias("issue"), F.coalesce(i, F.lit(0)).alias("n_rows")) for i in S.ISSUE_LABELS])
    return totals.select("_all", F.explode(rows).alias("r")).select(
        "r.issue", "r.n_rows", ratio("r.n_rows", "_all").alias("rate")
    )


def missingness_matrix(by_sensor_variable: DataFrame, pollutants_only: bool = False, wide_names=None) -> DataFrame:
    """Sensor x variable rates with 0 for absent cells; ``rank`` orders sensors by row mean.

    Long form (sensor_name, magnitude_name, rate, row_mean, rank); ``wide_names`` pivots it.
    """
    src = by_sensor_variable.filter(is_pollutant()) if pollutants_only else by_sensor_variable
    cells = src.groupBy("sensor_name", "magnitude_name").agg(F.avg("original_missing_rate").alias("rate"))
    names = cells.select("magnitude_name").distinct()
    sensors = cells.groupBy("sensor_name").agg(F.sum("rate").alias("_sum"))
    width = names.agg(F.count(F.lit(1)).alias("_width"))
    order = Window.orderBy(F.desc("row_mean"), "sensor_name")  # one row per sensor
    ranked = (
        attach_scalar(sensors, width)
        .select("sensor_name", (F.coalesce("_sum", F.lit(0.0)) / F.col("_width")).alias("row_mean"))
        .withColumn("rank", F.row_number().over(order))
    )
    # The catalogue of variable names is one array; every sensor row carries it once.
    catalogue = names.agg(F.array_sort(F.collect_set("magnitude_name")).alias("_names"))
    grid = attach_scalar(ranked, catalogue).withColumn("magnitude_name", F.explode("_names")).drop("_names")
    long = grid.join(cells, ["sensor_name", "magnitude_name"], "left").withColumn(
        "rate", F.coalesce("rate", F.lit(0.0))
    )
    if wide_names is None:
        return long.select("sensor_name", "magnitude_name", "rate", "row_mean", "rank")
    return long.groupBy("sensor_name", "rank").pivot("magnitude_name", list(wide_names)).agg(F.first("rate"))


def _year_type_matrix(by_year_type, absent, expr):
    wide = by_year_type.groupBy("year").pivot("variable_type", S.VARIABLE_TYPES).agg(F.avg("original_missing_rate"))
    return wide.select("year", *[expr(F.coalesce(t, F.lit(absent))).alias(t) for t in S.VARIABLE_TYPES]).orderBy("year")


def missingness_year_type_matrix(by_year_type: DataFrame) -> DataFrame:
    """year x variable type rates; absent cells are 0."""
    return _year_type_matrix(by_year_type, 0.0, lambda c: c)


def availability_matrix(by_year_type: DataFrame) -> DataFrame:
    """1 - rate; absent cells have availability 0."""
    return _year_type_matrix(by_year_type, 1.0, lambda c: 1 - c)


def _gaps_with_type(gaps, df):
    types = df.select("magnitude_name", "variable_type").distinct()
    return gaps.join(types, "magnitude_name", "left").withColumn(
        "gap_rows", F.col("n_consecutive_missing_rows").cast("double")
    )


def gap_length_profile(gaps: DataFrame, df: DataFrame) -> DataFrame:
    """Number, median and longest gap per variable type."""
    typed = _gaps_with_type(gaps, df)
    medians = grouped_quantiles(typed, ["variable_type"], "gap_rows", {"median_gap": 0.5}).drop("n_values")
    sizes = typed.groupBy("variable_type").agg(
        F.count(F.lit(1)).alias("n_gaps"), F.max("gap_rows").alias("max_gap")
    )
    return join_on(sizes, medians, ["variable_type"])


def gap_length_histogram(gaps: DataFrame, df: DataFrame, bins: int = 50) -> DataFrame:
    return value_histogram(_gaps_with_type(gaps, df), "gap_rows", ["variable_type"], bins)


def monthly_missing_trend(by_month: DataFrame) -> DataFrame:
    """Monthly rate and its centred mean over 6 months (3 before to 2 after), null at the ends."""
    w = Window.orderBy("year_month").rowsBetween(-3, 2)  # one row per calendar month
    rate = F.col("original_missing_rate")
    return by_month.select(
        "year_month", "original_missing_rate",
        F.when(F.count(rate).over(w) == 6, F.avg(rate).over(w)).alias("rolling_mean_6m"),
    ).orderBy("year_month")


def peak_missing_hour(by_hour: DataFrame) -> DataFrame:
    return by_hour.orderBy(F.desc_nulls_last("original_missing_rate"), "hour").limit(1)


def invalid_nonzero_labelled(summary: DataFrame) -> DataFrame:
    labels = F.create_map(*[F.lit(x) for kv in S.ISSUE_LABELS.items() for x in kv])
    return summary.filter("n_rows > 0").withColumn(
        "label", F.coalesce(F.try_element_at(labels, F.col("issue")), F.col("issue"))
    )
