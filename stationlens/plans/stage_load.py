"""Registered queries: sources, cleaning and profiling."""

from stationlens.operators import clean as C
from stationlens.operators import profile as P
from stationlens.plans import adapters as A
from stationlens.plans.base import check_sql, present
from stationlens.plans.store import stored
from stationlens.session import scratch_path
from stationlens.sources import readings as R


def daily(spark, sf):
    """Cleaned long-history readings, written once as every later stage reads them."""
    return stored(spark, sf, "cleaned_daily", lambda s, d: C.clean_readings(A.readings_daily(s, d)))


def hourly(spark, sf):
    """Cleaned dense hourly readings."""
    return stored(spark, sf, "cleaned_hourly", lambda s, d: C.clean_readings(A.readings_hourly(s, d)))


def coerced(spark, sf):
    return C.coerce_types(C.normalize_columns(A.readings_dirty(spark, sf)))


def _parquet(spark, sf):
    path = scratch_path(spark, "readings")
    A.readings_daily(spark, sf).write.parquet(path)
    return R.read_readings_parquet(spark, path)


def _csv(spark, sf):
    path = scratch_path(spark, "readings_csv")
    A.readings_daily(spark, sf).write.option("header", True).csv(path)
    return R.read_readings_csv(spark, path)


def _written(spark, sf):
    path = scratch_path(spark, "cleaned")
    R.write_cleaned(C.clean_readings(A.readings_daily(spark, sf)), path)
    return spark.read.parquet(path)


def _partitioned(spark, sf):
    path = scratch_path(spark, "partitioned")
    R.write_partitioned(daily(spark, sf), path)
    return spark.read.parquet(path)


def _pruned(spark, sf):
    path = scratch_path(spark, "partitioned")
    R.write_partitioned(daily(spark, sf), path)
    return R.scan_pruned(spark, path, 1998, 5)


def _result(spark, sf):
    root = scratch_path(spark, "results")
    R.write_result(P.value_counts(daily(spark, sf), "magnitude_name"), root, "load", "magnitude_counts")
    found = R.read_result_or_empty(spark, root, "load", "magnitude_counts", "magnitude_name string, n_rows bigint")
    absent = R.read_result_or_empty(spark, root, "load", "no_such_table", "magnitude_name string, n_rows bigint")
    return found.unionByName(absent)


def _write_result(spark, sf):
    root = scratch_path(spark, "results")
    path = R.write_result(P.value_counts(daily(spark, sf), "variable_type"), root, "load", "variable_type_counts")
    return spark.read.parquet(path)


def _counts(spark, sf):
    df = daily(spark, sf)
    parts = [P.value_counts(df, c).selectExpr(f"'{c}' AS column", f"`{c}` AS item", "n_rows") for c in ("variable_type", "magnitude_name", "sensor_name")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def _flag_quality(spark, sf):
    raw = coerced(spark, sf)
    return C.flag_quality(raw, C.clean_readings(A.readings_dirty(spark, sf)))


QUERIES = {
    "read_readings_parquet": _parquet,
    "read_readings_csv": _csv,
    "limit_rows": lambda s, d: R.limit_rows(A.readings_daily(s, d), 500),
    "normalize_columns": lambda s, d: C.normalize_columns(A.readings_dirty(s, d)),
    "write_cleaned": _written,
    "write_partitioned": _partitioned,
    "scan_pruned": _pruned,
    "read_result_or_empty": _result,
    "write_result": _write_result,
    "coerce_types": coerced,
    "flag_quality": _flag_quality,
    "resolve_flags": lambda s, d: C.resolve_flags(coerced(s, d)),
    "drop_incomplete": lambda s, d: C.drop_incomplete(coerced(s, d)),
    "drop_exact_duplicates": lambda s, d: C.drop_exact_duplicates(coerced(s, d)),
    "duplicate_count": lambda s, d: C.duplicate_count(C.drop_incomplete(coerced(s, d))),
    "add_time_features": lambda s, d: C.add_time_features(A.readings_daily(s, d)),
    "classify_variable": lambda s, d: C.classify_variable(coerced(s, d)),
    "clean_readings": lambda s, d: C.clean_readings(A.readings_dirty(s, d)),
    "schema_profile": lambda s, d: P.schema_profile(daily(s, d)),
    "describe_all": lambda s, d: P.describe_all(daily(s, d)),
    "value_counts": _counts,
    "coverage_summary": lambda s, d: P.coverage_summary(daily(s, d)),
    "interpolation_by_variable_type": lambda s, d: P.interpolation_by(daily(s, d), "variable_type"),
    "interpolation_by_magnitude": lambda s, d: P.interpolation_by(daily(s, d), "magnitude_name"),
    "dominant_pollutant": lambda s, d: P.dominant_pollutant(daily(s, d)),
    "value_histogram": lambda s, d: P.value_histogram(P.restrict_to_dominant(daily(s, d))),
    "monthly_resample": lambda s, d: P.monthly_resample(P.restrict_to_dominant(daily(s, d))),
}
QUERIES = {k: (lambda s, d, f=f: present(f(s, d))) for k, f in QUERIES.items()}

_RAW = dict(d="utm_x utm_y value", i="sensor_id magnitude_id", t="entry_date")
_CLEAN = dict(d=_RAW["d"], i=_RAW["i"] + " year month hour weekday", t="entry_date")
_COLS = "entry_date, sensor_id, sensor_name, utm_x, utm_y, magnitude_id, magnitude_name, value, is_interpolated, year, month, hour, weekday, variable_type"
_CTES = {
    "coerced": """SELECT TRY_CAST(entry_date AS TIMESTAMP) AS entry_date, TRY_CAST(sensor_id AS INTEGER) AS sensor_id, sensor_name,
      TRY_CAST(utm_x AS DOUBLE) AS utm_x, TRY_CAST(utm_y AS DOUBLE) AS utm_y, TRY_CAST(magnitude_id AS INTEGER) AS magnitude_id,
      magnitude_name, TRY_CAST(value AS DOUBLE) AS value, TRY_CAST(is_interpolated AS BOOLEAN) AS is_interpolated FROM dirty""",
    "resolved": """SELECT * REPLACE (CASE WHEN (SELECT avg(CASE WHEN is_interpolated IS NULL THEN 1.0 ELSE 0 END) FROM coerced) < 0.001
      THEN coalesce(is_interpolated, false) ELSE is_interpolated END AS is_interpolated) FROM coerced""",
    "cleaned_dirty": A._cleaned("resolved"),
}


def _c(body, **kw):
    return check_sql(body, ctes=_CTES, **kw)


def _interp(key):
    return _c(f"""SELECT {key}, avg(CAST(is_interpolated AS INTEGER)) AS interpolation_rate,
      count(*) FILTER (WHERE is_interpolated) AS interpolated_rows, count(is_interpolated) AS known_flag_rows, count(*) AS total_rows
      FROM daily GROUP BY {key}""", d="interpolation_rate")


_PROFILE_COLS = [("entry_date", "timestamp"), ("sensor_id", "int"), ("sensor_name", "string"), ("utm_x", "double"), ("utm_y", "double"),
                 ("magnitude_id", "int"), ("magnitude_name", "string"), ("value", "double"), ("is_interpolated", "boolean"), ("year", "int"),
                 ("month", "int"), ("hour", "int"), ("weekday", "int"), ("variable_type", "string")]


def profile_sql(cols, src):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) FILTER (WHERE {c} IS NULL) AS missing_values,
        count(*) FILTER (WHERE {c} IS NULL) / count(*)::DOUBLE AS missing_rate FROM {src}""" for c, t in cols)


def _describe_sql():
    parts = []
    stats = {"count": "count(x)", "mean": "avg(x)", "std": "stddev_samp(x)", "min": "min(x)", "25%": "quantile_cont(x, 0.25)",
             "50%": "quantile_cont(x, 0.5)", "75%": "quantile_cont(x, 0.75)", "max": "max(x)"}
    for c in ("sensor_id", "utm_x", "utm_y", "magnitude_id", "value", "year", "month", "hour", "weekday"):
        for s, e in stats.items():
            parts.append(f"""SELECT '{c}' AS "column", '{s}' AS statistic, (SELECT CAST({e} AS DOUBLE) FROM (SELECT CAST({c} AS DOUBLE) AS x FROM daily)) AS value, NULL::VARCHAR AS text""")
    for s, e in stats.items():
        if s == "std":
            continue
        v = f"(SELECT CAST({e} AS DOUBLE) FROM (SELECT epoch(entry_date) AS x FROM daily))"
        text = "NULL::VARCHAR" if s == "count" else f"strftime(make_timestamp(CAST(floor({v}) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')"
        parts.append(f"""SELECT 'entry_date' AS "column", '{s}' AS statistic, {v} AS value, {text} AS text""")
    for c in ("sensor_name", "magnitude_name", "is_interpolated", "variable_type"):
        x = f"(SELECT CAST({c} AS VARCHAR) AS x, count(*) AS n FROM daily WHERE {c} IS NOT NULL GROUP BY 1)"
        for s, e in {"count": "sum(n)", "unique": "count(*)", "freq": "max(n)"}.items():
            parts.append(f"""SELECT '{c}' AS "column", '{s}' AS statistic, (SELECT CAST({e} AS DOUBLE) FROM {x}) AS value, NULL::VARCHAR AS text""")
        parts.append(f"""SELECT '{c}' AS "column", 'top' AS statistic, NULL::DOUBLE AS value, (SELECT x FROM {x} ORDER BY n DESC, x LIMIT 1) AS text""")
    return " UNION ALL ".join(parts)


_DOMINANT = """(SELECT magnitude_name FROM daily WHERE variable_type = 'pollutant' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""

CHECKS = {
    "read_readings_parquet": _c("SELECT * FROM daily_raw", **_RAW),
    "read_readings_csv": _c("SELECT * FROM daily_raw", **_RAW),
    "limit_rows": _c("""SELECT * FROM daily_raw ORDER BY entry_date NULLS FIRST, sensor_id, magnitude_name, value, sensor_name, utm_x NULLS FIRST,
      utm_y, magnitude_id, is_interpolated NULLS FIRST LIMIT 500""", **_RAW),
    "normalize_columns": _c("SELECT * FROM dirty"),
    "write_cleaned": _c(f"SELECT {_COLS} FROM daily", **_CLEAN),
    "write_partitioned": _c(f"SELECT {_COLS} FROM daily", **_CLEAN),
    "scan_pruned": _c("SELECT entry_date, magnitude_name, value FROM daily WHERE year = 1998 AND sensor_id = 5", d="value", t="entry_date"),
    "read_result_or_empty": _c("SELECT magnitude_name, count(*) AS n_rows FROM daily GROUP BY 1"),
    "write_result": _c("SELECT variable_type, count(*) AS n_rows FROM daily GROUP BY 1"),
    "coerce_types": _c("SELECT * FROM coerced", **_RAW),
    "flag_quality": _c("""SELECT count(*) FILTER (WHERE is_interpolated IS NULL) AS missing_is_interpolated_before_cleaning,
      count(*) FILTER (WHERE is_interpolated IS NULL) / count(*)::DOUBLE AS missing_rate_before_cleaning, count(*) AS total_rows_before_cleaning,
      (SELECT count(*) FROM cleaned_dirty) AS total_rows_after_cleaning FROM coerced""", d="missing_rate_before_cleaning"),
    "resolve_flags": _c("SELECT * FROM resolved", **_RAW),
    "drop_incomplete": _c("""SELECT * FROM coerced WHERE entry_date IS NOT NULL AND sensor_id IS NOT NULL AND magnitude_name IS NOT NULL
      AND value IS NOT NULL""", **_RAW),
    "drop_exact_duplicates": _c("SELECT DISTINCT * FROM coerced", **_RAW),
    "duplicate_count": _c("""SELECT (SELECT count(*) FROM coerced WHERE entry_date IS NOT NULL AND value IS NOT NULL) AS n_rows, count(*) AS n_distinct_rows,
      (SELECT count(*) FROM coerced WHERE entry_date IS NOT NULL AND value IS NOT NULL) - count(*) AS n_duplicate_rows
      FROM (SELECT DISTINCT * FROM coerced WHERE entry_date IS NOT NULL AND value IS NOT NULL)"""),
    "add_time_features": _c("""SELECT *, year(entry_date) AS year, month(entry_date) AS month, hour(entry_date) AS hour,
      isodow(entry_date) - 1 AS weekday FROM daily_raw""", **_CLEAN),
    "classify_variable": _c(f"SELECT *, {A._VTYPE} AS variable_type FROM coerced", **_RAW),
    "clean_readings": _c(f"SELECT {_COLS} FROM cleaned_dirty", **_CLEAN),
    "schema_profile": _c(profile_sql(_PROFILE_COLS, "daily"), d="missing_rate"),
    "describe_all": _c(_describe_sql(), d="value"),
    "value_counts": _c("""SELECT 'variable_type' AS "column", variable_type AS item, count(*) AS n_rows FROM daily GROUP BY 2
      UNION ALL SELECT 'magnitude_name', magnitude_name, count(*) FROM daily GROUP BY 2 UNION ALL SELECT 'sensor_name', sensor_name, count(*) FROM daily GROUP BY 2"""),
    "coverage_summary": _c("""SELECT min(entry_date) AS min_date, max(entry_date) AS max_date, count(*) AS n_rows, count(DISTINCT sensor_id) AS n_sensors,
      count(DISTINCT sensor_name) AS n_sensor_names, count(DISTINCT magnitude_name) AS n_magnitudes FROM daily""", t="min_date max_date"),
    "interpolation_by_variable_type": _interp("variable_type"),
    "interpolation_by_magnitude": _interp("magnitude_name"),
    "dominant_pollutant": _c(f"""SELECT magnitude_name AS selected_pollutant_for_initial_plots, count(*) AS n_rows, min(entry_date) AS min_date,
      max(entry_date) AS max_date, avg(value) AS mean_value FROM daily WHERE magnitude_name = {_DOMINANT} GROUP BY 1""", d="mean_value", t="min_date max_date"),
    "value_histogram": _c(f"""SELECT b.bin, lo + b.bin * (hi - lo) / 50 AS bin_start, lo + (b.bin + 1) * (hi - lo) / 50 AS bin_end, coalesce(n, 0) AS n_rows
      FROM (SELECT unnest(range(50)) AS bin) b CROSS JOIN (SELECT min(value) AS lo, max(value) AS hi FROM daily WHERE magnitude_name = {_DOMINANT})
      LEFT JOIN (SELECT least(floor((value - lo) / ((hi - lo) / 50)), 49)::BIGINT AS bin, count(*) AS n FROM daily,
        (SELECT min(value) AS lo, max(value) AS hi FROM daily WHERE magnitude_name = {_DOMINANT}) WHERE magnitude_name = {_DOMINANT} GROUP BY 1) c ON b.bin = c.bin""",
      d="bin_start bin_end", i="bin n_rows"),
    "monthly_resample": _c(f"""SELECT last_day(m) AS month, mean_value FROM (SELECT unnest(generate_series(min(date_trunc('month', entry_date)), max(date_trunc('month', entry_date)), INTERVAL 1 MONTH)) AS m FROM daily WHERE magnitude_name = {_DOMINANT})
      LEFT JOIN (SELECT date_trunc('month', entry_date) AS mm, avg(value) AS mean_value FROM daily WHERE magnitude_name = {_DOMINANT} GROUP BY 1) ON m = mm""", d="mean_value", dates="month"),
}
