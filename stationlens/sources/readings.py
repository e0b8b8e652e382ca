"""Reading and writing readings and result tables."""

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from stationlens import schema as S
from stationlens.operators.clean import coerce_types, normalize_columns


def _known_types(df):
    """Schema types for the known columns; other columns are left as they are."""
    return coerce_types(normalize_columns(df))


def read_readings_parquet(spark: SparkSession, path: str) -> DataFrame:
    """All parquet files below ``path``. A missing or empty folder is an error."""
    return _known_types(spark.read.parquet(path))


def read_readings_csv(spark: SparkSession, path: str, nrows: int = None) -> DataFrame:
    """CSV with a header. Cells are read as text and coerced, so that a bad cell is null."""
    header = spark.read.option("header", True).csv(path)
    text = T.StructType([T.StructField(c, T.StringType()) for c in header.columns])
    df = _known_types(spark.read.option("header", True).schema(text).csv(path))
    return df if nrows is None else limit_rows(df, nrows)


def limit_rows(df: DataFrame, n: int) -> DataFrame:
    """The first n rows in time, sensor, variable and value order (for quick trials)."""
    order = [c for c in ("entry_date", "sensor_id", "magnitude_name", "value") if c in df.columns]
    return df.orderBy(*order, *[c for c in df.columns if c not in order]).limit(n)


def write_cleaned(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def balanced(df: DataFrame, by, rows_per_task: int, max_broadcast: int = 200_000) -> DataFrame:
    """``df`` dealt to tasks of about ``rows_per_task`` rows each, ordered by folder.

    Rows per folder are counted first. Folders lie one behind the other on a line of row
    positions, a row takes a position inside its folder by its hash, and a stretch of
    ``rows_per_task`` positions is a task: a large folder is cut into several, small ones share
    one. Rows equal in all columns have one position. The count table has a row per folder; it
    is broadcast up to ``max_broadcast`` of them and joined by shuffle beyond.
    """
    keys, names = list(by), [f"_by{i}" for i in range(len(by))]
    counts = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.count(F.lit(1)).alias("folders"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows")).first()
    before = F.coalesce(F.sum("_rows").over(Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    line = counts.withColumn("_before", before)  # a row per folder
    if total.folders <= max_broadcast:
        line = F.broadcast(line)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    place = F.col("_before") + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col("_rows"))
    dealt = df.join(line, on).withColumn("_task", F.floor(place / rows_per_task).cast("int"))
    return dealt.repartitionById(max(1, -(-total.rows // rows_per_task)), F.col("_task")).select(*[F.col(f"`{c}`") for c in df.columns])


def write_partitioned(df: DataFrame, path: str, by=("year", "sensor_id"), only_if_absent: bool = False, rows_per_task: int = 5_000_000) -> None:
    """A dataset partitioned by year and sensor, written by tasks of about ``rows_per_task`` rows (see ``balanced``)."""
    balanced(df, by, rows_per_task).write.partitionBy(*by).mode("ignore" if only_if_absent else "overwrite").parquet(path)


def scan_pruned(spark: SparkSession, path: str, year: int, sensor_id: int) -> DataFrame:
    """One (year, sensor) with three columns: partitions and columns are pruned at the scan."""
    return (
        spark.read.parquet(path)
        .filter((F.col("year") == year) & (F.col("sensor_id") == sensor_id))
        .select("entry_date", "magnitude_name", "value")
    )


def read_result_or_empty(spark: SparkSession, root: str, stage: str, name: str, schema) -> DataFrame:
    """A table of an earlier stage, or an empty one with ``schema`` where it was not written."""
    try:
        return spark.read.parquet(os.path.join(root, stage, name))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def write_result(df: DataFrame, root: str, stage: str, name: str, fmt: str = "parquet") -> str:
    """A named result table below ``root/stage/name``, as parquet or CSV with a header."""
    path = os.path.join(root, stage, name)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return path


def write_cell_matrices(pairs: DataFrame, path: str, rows_per_task: int = 5_000_000) -> None:
    """Correlations of each (year, sensor) cell as a long pair table in one folder per cell."""
    write_partitioned(pairs, path, ("year", "sensor_id"), rows_per_task=rows_per_task)
