"""Profiles of a table of readings."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlens.functions.columns import count_true, is_pollutant, mean_flag, ratio
from stationlens.functions.quantiles import attach_scalar, grouped_quantiles


def schema_profile(df: DataFrame) -> DataFrame:
    """column, dtype, missing_values, missing_rate: one pass, then one row per column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(df.columns)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.lit(dtype).alias("dtype"),
                F.col(f"_m{i}").alias("missing_values"),
            )
            for i, (name, dtype) in enumerate(df.dtypes)
        ]
    )
    return counts.select("_all", F.explode(rows).alias("r")).select(
        "r.column", "r.dtype", "r.missing_values",
        ratio("r.missing_values", "_all").alias("missing_rate"),
    )


def _long(one_row, kind, stats):
    """Unpivot a one-row aggregate named ``<column>::<statistic>`` to (column, statistic, value)."""
    items = [
        F.struct(
            F.lit(c).alias("column"), F.lit(s).alias("statistic"),
            F.col(f"`{c}::{s}`").cast("string").alias("text"),
            (F.col(f"`{c}::{s}`").cast("double") if kind == "number" else F.lit(None).cast("double")).alias("value"),
        )
        for c, s in stats
    ]
    return one_row.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def describe_all(df: DataFrame) -> DataFrame:
    """(column, statistic, value, text) for numeric, text/flag and date columns.

    Numeric: count, mean, std, min, 25%, 50%, 75%, max. Text and flags: count, unique, top,
    freq. Dates: count, mean, min, 25%, 50%, 75%, max, as seconds and as text.
    """
    quart = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    measures = numeric + dates
    num = df.select(
        *[F.col(c).cast("double").alias(c) for c in numeric],
        *[F.col(c).cast("timestamp").cast("double").alias(c) for c in dates],
    )
    basic = [("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)]
    cells = [(c, s) for c in measures for s, _ in basic if not (s == "std" and c in dates)]
    fn = dict(basic)
    one = num.agg(*[fn[s](c).cast("double").alias(f"{c}::{s}") for c, s in cells])
    parts = [_long(one, "number", cells)]

    # One quantile computation for all numeric columns: the column name is the group key.
    tall = num.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in measures])).alias("r")
    ).select("r.*")
    q = grouped_quantiles(tall, ["column"], "v", quart)
    parts.append(
        q.select(
            "column",
            F.explode(F.array(*[F.struct(F.lit(s).alias("statistic"), F.col(s).alias("value")) for s in quart])).alias("r"),
        ).select("column", "r.statistic", F.col("r.value").cast("string").alias("text"), "r.value")
    )
    parts.append(_describe_texts(df, texts))
    out = reduce(DataFrame.unionByName, parts)
    is_date = F.col("column").isin(dates) & (F.col("statistic") != "count")
    stamp = F.date_format(F.col("value").cast("long").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    numeric_text = F.when(is_date, stamp).when(F.col("value").isNull(), F.col("text"))
    return out.select("column", "statistic", "value", numeric_text.alias("text"))


def _describe_texts(df, texts):
    """count, unique, top and freq from value counts of all text columns in one aggregate."""
    if not texts:
        return df.sparkSession.createDataFrame([], "column string, statistic string, text string, value double")
    tall = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in texts])).alias("r")
    ).select("r.*").filter(F.col("v").isNotNull())
    counts = tall.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(
        F.sum("n").cast("double").alias("count"),
        F.count(F.lit(1)).cast("double").alias("unique"),
        F.max("n").cast("double").alias("freq"),
        # Highest count; the alphabetically first name on ties.
        F.min(F.struct(-F.col("n"), F.col("v"))).getField("v").alias("top"),
    )
    cells = F.array(
        *[
            F.struct(F.lit(s).alias("statistic"), F.lit(None).cast("string").alias("text"), F.col(s).alias("value"))
            for s in ("count", "unique", "freq")
        ],
        F.struct(F.lit("top").alias("statistic"), F.col("top").alias("text"), F.lit(None).cast("double").alias("value")),
    )
    return best.select("column", F.explode(cells).alias("r")).select("column", "r.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, nulls included, most frequent first."""
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("n_rows"), F.asc_nulls_last(column))
    )


def coverage_summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(
        F.min("entry_date").alias("min_date"),
        F.max("entry_date").alias("max_date"),
        F.count(F.lit(1)).alias("n_rows"),
        distinct("sensor_id").alias("n_sensors"),
        distinct("sensor_name").alias("n_sensor_names"),
        distinct("magnitude_name").alias("n_magnitudes"),
    )


def interpolation_by(df: DataFrame, *keys: str) -> DataFrame:
    """Share of interpolated rows over known flags, with counts, per key."""
    return (
        df.groupBy(*keys)
        .agg(
            mean_flag("is_interpolated").alias("interpolation_rate"),
            count_true("is_interpolated").alias("interpolated_rows"),
            F.count("is_interpolated").alias("known_flag_rows"),
            F.count(F.lit(1)).alias("total_rows"),
        )
        .orderBy(F.desc_nulls_last("interpolation_rate"), *keys)
    )


def dominant_pollutant(df: DataFrame) -> DataFrame:
    """The pollutant with most rows: rows, date range and mean value."""
    return (
        df.filter(is_pollutant())
        .groupBy(F.col("magnitude_name").alias("selected_pollutant_for_initial_plots"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("entry_date").alias("min_date"),
            F.max("entry_date").alias("max_date"),
            F.avg("value").alias("mean_value"),
        )
        .orderBy(F.desc("n_rows"), "selected_pollutant_for_initial_plots")
        .limit(1)
    )


def restrict_to_dominant(df: DataFrame) -> DataFrame:
    """Rows of the dominant pollutant only."""
    name = dominant_pollutant(df).select(
        F.col("selected_pollutant_for_initial_plots").alias("magnitude_name")
    )
    return df.join(F.broadcast(name), "magnitude_name", "left_semi")


def value_histogram(df: DataFrame, value="value", keys=(), bins: int = 50) -> DataFrame:
    """Equal-width bins over min..max of each group, empty bins included, last bin closed.

    A constant group is spread over min - 0.5 .. max + 0.5, as NumPy does.
    """
    keys = list(keys)
    data = df.filter(F.col(value).isNotNull()).withColumn("_v", F.col(value).cast("double"))
    lo, hi = F.min("_v"), F.max("_v")
    span = data.groupBy(*keys).agg(lo.alias("_a"), hi.alias("_b")) if keys else data.agg(lo.alias("_a"), hi.alias("_b"))
    flat = F.col("_a") == F.col("_b")
    span = span.filter(F.col("_a").isNotNull()).select(
        *keys,
        F.when(flat, F.col("_a") - 0.5).otherwise(F.col("_a")).alias("_lo"),
        F.when(flat, F.col("_b") + 0.5).otherwise(F.col("_b")).alias("_hi"),
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    joined = data.join(span, keys) if keys else attach_scalar(data, span)
    bin_no = F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    counts = joined.groupBy(*keys, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n_rows"),
    )


def monthly_resample(df: DataFrame, value="value") -> DataFrame:
    """Mean per calendar month, labelled by month end; months without rows are kept as null."""
    monthly = df.groupBy(F.trunc("entry_date", "month").alias("_m")).agg(F.avg(value).alias("mean_value"))
    span = monthly.agg(F.min("_m").alias("a"), F.max("_m").alias("b")).filter(F.col("a").isNotNull())
    months = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("_m"))
    return months.join(monthly, "_m", "left").select(F.last_day("_m").alias("month"), "mean_value").orderBy("month")
