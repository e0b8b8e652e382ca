"""Readings and station tables derived from the given tables by plain projections."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings_daily(spark, sf_dir, sensors: int = 24) -> DataFrame:
    """Long history (83 months) from ``lineitem``; ``sensors=0`` keeps every supplier as a sensor."""
    li = table(spark, sf_dir, "lineitem")
    sid = F.col("l_suppkey") % sensors if sensors else F.col("l_suppkey")
    kind = F.concat("l_returnflag", "l_linestatus")
    magnitude = (
        F.when(kind == "AF", "NO2").when(kind == "AO", "NO").when(kind == "NF", "NOX")
        .when(kind == "NO", "O3").when(kind == "RF", "VV").otherwise("TI_MAIN")
    )
    return li.select(
        (F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))).alias("entry_date"),
        sid.cast("int").alias("sensor_id"),
        F.concat(F.lit("station_"), sid.cast("string")).alias("sensor_name"),
        F.when(F.col("l_partkey") % 1000 != 1, 430000.0 + 350.0 * ((sid * 7) % 24)).alias("utm_x"),
        (4470000.0 + 275.0 * ((sid * 5) % 24)).alias("utm_y"),
        F.ascii("l_returnflag").alias("magnitude_id"),
        magnitude.alias("magnitude_name"),
        F.col("l_quantity").alias("value"),
        F.when(F.col("l_partkey") % 500 != 0, F.col("l_linenumber") == 7).alias("is_interpolated"),
    )


def readings_hourly(spark, sf_dir) -> DataFrame:
    """Dense hours of one month from ``events``."""
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    sid = F.col("user_id") % 6
    names = {"view": "NO2", "click": "NOX", "error": "O3", "purchase": "VV"}
    magnitude = F.lit("TI_MAIN")
    for kind, name in names.items():
        magnitude = F.when(F.col("event_type") == kind, name).otherwise(magnitude)
    return ev.select(
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("entry_date"),
        sid.cast("int").alias("sensor_id"),
        F.concat(F.lit("station_"), sid.cast("string")).alias("sensor_name"),
        (430000.0 + 350.0 * sid).alias("utm_x"),
        (4470000.0 + 275.0 * sid).alias("utm_y"),
        F.length("event_type").alias("magnitude_id"),
        magnitude.alias("magnitude_name"),
        F.col("value"),
        F.when(k % 50 != 7, k % 10 == 0).alias("is_interpolated"),
    )


def readings_dirty(spark, sf_dir) -> DataFrame:
    """Hourly readings as badly named text columns with unparsable cells and exact copies."""
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    sid = F.col("user_id") % 6
    base = ev.select(
        F.when(F.col("event_id") % 89 == 0, "bad")
        .otherwise(F.date_format(F.date_trunc("hour", F.col("ts").cast("timestamp")), "yyyy-MM-dd HH:mm:ss")).alias(" ENTRY_DATE "),
        sid.cast("string").alias("SENSOR_ID"),
        F.concat(F.lit("station_"), sid.cast("string")).alias("SENSOR_NAME"),
        F.when(F.col("event_id") % 83 != 0, (430000 + 350 * sid).cast("string")).otherwise("?").alias("UTM_X"),
        (4470000 + 275 * sid).cast("string").alias("UTM_Y"),
        F.length("event_type").cast("string").alias("MAGNITUDE_ID"),
        F.when(F.col("event_type") == "view", "NO2").when(F.col("event_type") == "click", "nox ")
        .when(F.col("event_type") == "error", "O3").when(F.col("event_type") == "purchase", "VV").otherwise("TI_MAIN").alias("MAGNITUDE_NAME"),
        F.when(F.col("event_id") % 97 == 0, "n/a").otherwise(F.col("value").cast("string")).alias(" VALUE"),
        F.when(k % 50 != 7, F.when(k % 10 == 0, "true").otherwise("false")).alias("IS_INTERPOLATED"),
        F.col("event_id").alias("_id"),
    )
    copies = base.filter(F.col("_id") % 50 == 0)
    return base.unionAll(copies).drop("_id")


def stations(spark, sf_dir) -> DataFrame:
    """One station per supplier: sensor_id, sensor_name, utm_x, utm_y."""
    su = table(spark, sf_dir, "supplier")
    return su.select(
        F.col("s_suppkey").cast("int").alias("sensor_id"),
        F.concat(F.lit("station_"), F.col("s_suppkey").cast("string")).alias("sensor_name"),
        (430000 + 2 * F.col("s_acctbal")).alias("utm_x"),
        (4470000 + 700.0 * F.col("s_nationkey") + (37 * F.col("s_suppkey")) % 701).alias("utm_y"),
    )


# The same projections in the SQL of the check database.
_DAILY = """
SELECT l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS entry_date,
  CAST(l_suppkey % 24 AS INTEGER) AS sensor_id,
  'station_' || CAST(l_suppkey % 24 AS VARCHAR) AS sensor_name,
  CASE WHEN l_partkey % 1000 <> 1 THEN 430000.0::DOUBLE + 350.0 * (((l_suppkey % 24) * 7) % 24) END AS utm_x,
  4470000.0::DOUBLE + 275.0 * (((l_suppkey % 24) * 5) % 24) AS utm_y,
  ascii(l_returnflag) AS magnitude_id,
  CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'NO2' WHEN 'AO' THEN 'NO' WHEN 'NF' THEN 'NOX'
    WHEN 'NO' THEN 'O3' WHEN 'RF' THEN 'VV' ELSE 'TI_MAIN' END AS magnitude_name,
  l_quantity AS value,
  CASE WHEN l_partkey % 500 <> 0 THEN l_linenumber = 7 END AS is_interpolated
FROM lineitem"""
_HOURLY = """
SELECT date_trunc('hour', ts) AS entry_date, CAST(user_id % 6 AS INTEGER) AS sensor_id,
  'station_' || CAST(user_id % 6 AS VARCHAR) AS sensor_name,
  430000.0::DOUBLE + 350.0 * (user_id % 6) AS utm_x, 4470000.0::DOUBLE + 275.0 * (user_id % 6) AS utm_y,
  length(event_type) AS magnitude_id,
  CASE event_type WHEN 'view' THEN 'NO2' WHEN 'click' THEN 'NOX' WHEN 'error' THEN 'O3'
    WHEN 'purchase' THEN 'VV' ELSE 'TI_MAIN' END AS magnitude_name,
  value,
  CASE WHEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 50 <> 7
    THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 10 = 0 END AS is_interpolated
FROM events"""
_DIRTY = """
SELECT * EXCLUDE (e, cp) FROM (
SELECT CASE WHEN event_id % 89 = 0 THEN 'bad' ELSE strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') END AS entry_date,
  CAST(user_id % 6 AS VARCHAR) AS sensor_id, 'station_' || CAST(user_id % 6 AS VARCHAR) AS sensor_name,
  CASE WHEN event_id % 83 <> 0 THEN CAST(430000 + 350 * (user_id % 6) AS VARCHAR) ELSE '?' END AS utm_x,
  CAST(4470000 + 275 * (user_id % 6) AS VARCHAR) AS utm_y,
  CAST(length(event_type) AS VARCHAR) AS magnitude_id,
  CASE event_type WHEN 'view' THEN 'NO2' WHEN 'click' THEN 'nox ' WHEN 'error' THEN 'O3'
    WHEN 'purchase' THEN 'VV' ELSE 'TI_MAIN' END AS magnitude_name,
  CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value,
  CASE WHEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 50 <> 7
    THEN CASE WHEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 10 = 0 THEN 'true' ELSE 'false' END END AS is_interpolated,
  event_id AS e, cp
FROM events CROSS JOIN (SELECT unnest([1, 2]) AS cp)) WHERE cp = 1 OR e % 50 = 0"""
_STATIONS = """
SELECT CAST(s_suppkey AS INTEGER) AS sensor_id, 'station_' || CAST(s_suppkey AS VARCHAR) AS sensor_name,
  430000 + 2 * s_acctbal AS utm_x, 4470000 + 700.0::DOUBLE * s_nationkey + (37 * s_suppkey) % 701 AS utm_y
FROM supplier"""
_VTYPE = """CASE WHEN upper(trim(magnitude_name)) IN ('SO2','CO','NO','NO2','PM2.5','PM10','<PM2.5','<PM10','NOX','O3','TOLUENO','BENCENO','ETILBENCENO','HIDROCARBS_TOTALES','METANO','HIDROCARBS_NO_METANICOS') THEN 'pollutant'
  WHEN upper(trim(magnitude_name)) IN ('TEMP','HR','PRE','RS','VV','DV','PRECIPITACION') THEN 'weather'
  WHEN regexp_matches(upper(trim(magnitude_name)), '^(TI_|SP_|OC_)') THEN 'traffic' ELSE 'unknown' END"""


def _cleaned(raw):
    """Cleaned readings for input that is already typed."""
    return f"""
SELECT *, year(entry_date) AS year, month(entry_date) AS month, hour(entry_date) AS hour,
  (dayofweek(entry_date) + 6) % 7 AS weekday, {_VTYPE} AS variable_type,
  is_interpolated AS was_missing, is_interpolated IS NULL AS missing_flag_unknown
FROM (SELECT DISTINCT * FROM {raw} WHERE entry_date IS NOT NULL AND sensor_id IS NOT NULL AND magnitude_name IS NOT NULL AND value IS NOT NULL)"""


# Common table expressions by name, in dependency order.
CTES = {
    "daily_raw": _DAILY,
    "hourly_raw": _HOURLY,
    "dirty": _DIRTY,
    "stations": _STATIONS,
    "daily": _cleaned("daily_raw"),
    "hourly": _cleaned("hourly_raw"),
}
