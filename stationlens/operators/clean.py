"""Type coercion, cleaning and classification of raw readings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlens import schema as S
from stationlens.functions.columns import null_if_nan, ratio, variable_type
from stationlens.functions.quantiles import attach_scalar

REQUIRED = ["entry_date", "sensor_id", "magnitude_name", "value"]
LOW_FLAG_RATE = 0.001


def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names without surrounding spaces, in lower case."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def coerce_types(df: DataFrame) -> DataFrame:
    """Schema types for the known columns; text that does not parse becomes null.

    Numbers go through double first, so "7.0" is a valid id.
    """
    exprs = []
    wanted = {f.name: f.dataType for f in S.READINGS.fields}
    for c in df.columns:
        kind = wanted.get(c)
        if c == "entry_date":
            e = F.expr(f"try_cast(`{c}` as timestamp)")
        elif kind is not None and kind.typeName() == "double":
            e = null_if_nan(F.expr(f"try_cast(`{c}` as double)"))
        elif kind is not None and kind.typeName() == "integer":
            e = F.expr(f"try_cast(try_cast(`{c}` as double) as int)")
        elif kind is not None and kind.typeName() == "boolean":
            e = F.expr(f"try_cast(`{c}` as boolean)")
        else:
            e = F.col(f"`{c}`")
        exprs.append(e.alias(c))
    return df.select(*exprs)


def _flag_stats(df):
    unknown = F.count_if(F.col("is_interpolated").isNull())
    return df.agg(unknown.alias("n_unknown"), F.count(F.lit(1)).alias("n_all"))


def flag_quality(before: DataFrame, after: DataFrame) -> DataFrame:
    """Unknown interpolation flags before cleaning, and row counts before and after."""
    left = _flag_stats(before).select(
        F.col("n_unknown").alias("missing_is_interpolated_before_cleaning"),
        ratio("n_unknown", "n_all").alias("missing_rate_before_cleaning"),
        F.col("n_all").alias("total_rows_before_cleaning"),
    )
    right = after.agg(F.count(F.lit(1)).alias("total_rows_after_cleaning"))
    return attach_scalar(left, right)


def resolve_flags(df: DataFrame) -> DataFrame:
    """A tiny share of unknown flags (under 0.1 %) is taken as False; a larger one stays unknown."""
    rate = _flag_stats(df).select(ratio("n_unknown", "n_all").alias("_rate"))
    flag = F.when(
        F.col("_rate") < LOW_FLAG_RATE, F.coalesce("is_interpolated", F.lit(False))
    ).otherwise(F.col("is_interpolated"))
    return attach_scalar(df, rate).withColumn("is_interpolated", flag).select(*df.columns)


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna(subset=REQUIRED)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One copy of each fully identical row. Copies collapse on the map side before the shuffle."""
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and the number of surplus copies."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicate_rows"),
    )


def add_time_features(df: DataFrame) -> DataFrame:
    """year, month, hour and weekday (Monday = 0)."""
    return df.withColumns(
        {
            "year": F.year("entry_date"),
            "month": F.month("entry_date"),
            "hour": F.hour("entry_date"),
            "weekday": F.weekday("entry_date"),
        }
    )


def classify_variable(df: DataFrame) -> DataFrame:
    return df.withColumn("variable_type", variable_type("magnitude_name"))


def clean_readings(raw: DataFrame) -> DataFrame:
    """Raw readings to cleaned readings: the full first stage."""
    return (
        raw.transform(normalize_columns)
        .transform(coerce_types)
        .transform(resolve_flags)
        .transform(drop_incomplete)
        .transform(drop_exact_duplicates)
        .transform(add_time_features)
        .transform(classify_variable)
    )
