"""Registered queries: missingness and data quality."""

from stationlens.operators import quality as Q
from stationlens.plans.base import check_sql as _c
from stationlens.plans.base import present
from stationlens.plans.stage_load import _PROFILE_COLS, daily, profile_sql


def flagged(spark, sf):
    return Q.reconstruct_missingness(daily(spark, sf))


def _gaps(spark, sf):
    return Q.missing_gaps(flagged(spark, sf))


QUERIES = {
    "reconstruct_missingness": flagged,
    "missingness_by_column": lambda s, d: Q.missingness_by_column(flagged(s, d)),
    "missingness_by_type": lambda s, d: Q.missingness_by_type(flagged(s, d)),
    "missingness_by_pollutant": lambda s, d: Q.missingness_by_pollutant(flagged(s, d)),
    "missingness_by_magnitude": lambda s, d: Q.missingness_by_magnitude(flagged(s, d)),
    "missingness_by_sensor": lambda s, d: Q.missingness_by_sensor(flagged(s, d)),
    "missingness_by_sensor_variable": lambda s, d: Q.missingness_by_sensor_variable(flagged(s, d)),
    "missingness_daily": lambda s, d: Q.missingness_daily(flagged(s, d)),
    "missingness_monthly": lambda s, d: Q.missingness_monthly(flagged(s, d)),
    "missingness_by_hour": lambda s, d: Q.missingness_by_hour(flagged(s, d)),
    "missingness_by_year_type": lambda s, d: Q.missingness_by_year_type(flagged(s, d)),
    "missing_gaps": _gaps,
    "missing_gaps_anchored": lambda s, d: Q.missing_gaps(flagged(s, d), drop_unanchored=True),
    "invalid_values": lambda s, d: Q.invalid_values(flagged(s, d)),
    "missingness_matrix": lambda s, d: Q.missingness_matrix(Q.missingness_by_sensor_variable(flagged(s, d))),
    "missingness_year_type_matrix": lambda s, d: Q.missingness_year_type_matrix(Q.missingness_by_year_type(flagged(s, d))),
    "availability_matrix": lambda s, d: Q.availability_matrix(Q.missingness_by_year_type(flagged(s, d))),
    "gap_length_profile": lambda s, d: Q.gap_length_profile(_gaps(s, d), daily(s, d)),
    "gap_length_histogram": lambda s, d: Q.gap_length_histogram(_gaps(s, d), daily(s, d)),
    "monthly_missing_trend": lambda s, d: Q.monthly_missing_trend(Q.missingness_monthly(flagged(s, d))),
    "peak_missing_hour": lambda s, d: Q.peak_missing_hour(Q.missingness_by_hour(flagged(s, d))),
    "invalid_nonzero_labelled": lambda s, d: Q.invalid_nonzero_labelled(Q.invalid_values(flagged(s, d))),
}
QUERIES = {k: (lambda s, d, f=f: present(f(s, d))) for k, f in QUERIES.items()}

_M = """avg(CAST(was_missing AS INTEGER)) AS original_missing_rate, count(*) FILTER (WHERE was_missing) AS originally_missing_rows,
  count(was_missing) AS known_flag_rows, count(*) AS total_rows"""
_RATE = "original_missing_rate"


def by_sql(keys, where="true"):
    return f"SELECT {keys}, {_M} FROM daily WHERE {where} GROUP BY ALL"


_SV = by_sql("sensor_id, sensor_name, magnitude_name")
_MONTH = by_sql("strftime(entry_date, '%Y-%m') AS year_month")
# Row by row: a run number that grows whenever a row differs from the row before it.
GAPS = """SELECT sensor_id, sensor_name, magnitude_name, min(entry_date) AS gap_start, max(entry_date) AS gap_end, count(*) AS n_consecutive_missing_rows
  FROM (SELECT *, sum(edge) OVER (PARTITION BY sensor_id, magnitude_name ORDER BY entry_date, k, value ROWS UNBOUNDED PRECEDING) AS run
    FROM (SELECT *, CASE WHEN m IS DISTINCT FROM lag(m) OVER (PARTITION BY sensor_id, magnitude_name ORDER BY entry_date, k, value) THEN 1 ELSE 0 END AS edge
      FROM (SELECT *, coalesce(was_missing, false) AS m, CASE WHEN was_missing THEN 2 WHEN was_missing IS NULL THEN 1 ELSE 0 END AS k FROM daily)))
  WHERE m GROUP BY sensor_id, sensor_name, magnitude_name, run"""
# The same with comparisons that are null next to a null, so such rows have no run number.
_ANCHORED = """SELECT sensor_id, sensor_name, magnitude_name, min(entry_date) AS gap_start, max(entry_date) AS gap_end, count(*) AS n_consecutive_missing_rows
  FROM (SELECT *, CASE WHEN edge IS NOT NULL THEN sum(edge) OVER (PARTITION BY sensor_id, magnitude_name ORDER BY entry_date, k, value ROWS UNBOUNDED PRECEDING) END AS run
    FROM (SELECT *, CAST(was_missing <> lag(was_missing) OVER (PARTITION BY sensor_id, magnitude_name ORDER BY entry_date, k, value) AS INTEGER) AS edge
      FROM (SELECT *, CASE WHEN was_missing THEN 2 WHEN was_missing IS NULL THEN 1 ELSE 0 END AS k FROM daily)))
  WHERE was_missing AND run IS NOT NULL GROUP BY sensor_id, sensor_name, magnitude_name, run"""
_INVALID = """SELECT issue, n_rows, n_rows / (SELECT count(*) FROM daily)::DOUBLE AS rate FROM (
  SELECT 'negative_values_for_non_negative_variables' AS issue, count(*) FILTER (WHERE value < 0 AND (variable_type IN ('pollutant', 'traffic') OR upper(trim(magnitude_name)) IN ('VV', 'HR', 'PRE', 'RS', 'PRECIPITACION'))) AS n_rows FROM daily
  UNION ALL SELECT 'relative_humidity_outside_0_100', count(*) FILTER (WHERE upper(trim(magnitude_name)) = 'HR' AND (value < 0 OR value > 100)) FROM daily
  UNION ALL SELECT 'wind_direction_outside_0_360', count(*) FILTER (WHERE upper(trim(magnitude_name)) = 'DV' AND (value < 0 OR value > 360)) FROM daily
  UNION ALL SELECT 'missing_coordinates', count(*) FILTER (WHERE utm_x IS NULL OR utm_y IS NULL) FROM daily
  UNION ALL SELECT 'duplicate_sensor_variable_timestamp_rows', count(*) FROM (SELECT count(*) OVER (PARTITION BY sensor_id, magnitude_name, entry_date) AS n FROM daily) WHERE n > 1
  UNION ALL SELECT 'unknown_interpolation_flags', count(*) FILTER (WHERE is_interpolated IS NULL) FROM daily)"""
_TYPED_GAPS = f"(SELECT g.*, t.variable_type FROM ({GAPS}) g LEFT JOIN (SELECT DISTINCT magnitude_name, variable_type FROM daily) t ON g.magnitude_name = t.magnitude_name)"
_YT = by_sql("year, variable_type")


def _matrix(absent, wrap):
    cells = ", ".join(wrap.format(f"coalesce(max(original_missing_rate) FILTER (WHERE variable_type = '{t}'), {absent})") + f" AS {t}" for t in ("pollutant", "traffic", "unknown", "weather"))
    return _c(f"SELECT year, {cells} FROM ({_YT}) GROUP BY year", d="pollutant traffic unknown weather", i="year")


CHECKS = {
    "reconstruct_missingness": _c("SELECT * FROM daily", d="utm_x utm_y value", i="sensor_id magnitude_id year month hour weekday", t="entry_date"),
    "missingness_by_column": _c(profile_sql(_PROFILE_COLS + [("was_missing", "boolean"), ("missing_flag_unknown", "boolean")], "daily"), d="missing_rate"),
    "missingness_by_type": _c(by_sql("variable_type"), d=_RATE),
    "missingness_by_pollutant": _c(by_sql("magnitude_name", "variable_type = 'pollutant'"), d=_RATE),
    "missingness_by_magnitude": _c(by_sql("variable_type, magnitude_name"), d=_RATE),
    "missingness_by_sensor": _c(by_sql("sensor_id, sensor_name"), d=_RATE, i="sensor_id"),
    "missingness_by_sensor_variable": _c(_SV, d=_RATE, i="sensor_id"),
    "missingness_daily": _c(by_sql("CAST(entry_date AS DATE) AS date"), d=_RATE, dates="date"),
    "missingness_monthly": _c(_MONTH, d=_RATE),
    "missingness_by_hour": _c(by_sql("hour(entry_date) AS hour"), d=_RATE, i="hour"),
    "missingness_by_year_type": _c(_YT, d=_RATE, i="year"),
    "missing_gaps": _c(GAPS, i="sensor_id", t="gap_start gap_end"),
    "missing_gaps_anchored": _c(_ANCHORED, i="sensor_id", t="gap_start gap_end"),
    "invalid_values": _c(_INVALID, d="rate"),
    "missingness_matrix": _c(f"""SELECT *, dense_rank() OVER (ORDER BY row_mean DESC, sensor_name) AS rank FROM (
      SELECT *, avg(rate) OVER (PARTITION BY sensor_name) AS row_mean FROM (
        SELECT s.sensor_name, m.magnitude_name, coalesce(avg(r.original_missing_rate), 0) AS rate FROM (SELECT DISTINCT sensor_name FROM daily) s
        CROSS JOIN (SELECT DISTINCT magnitude_name FROM daily) m LEFT JOIN ({_SV}) r ON r.sensor_name = s.sensor_name AND r.magnitude_name = m.magnitude_name GROUP BY 1, 2))""", d="rate row_mean"),
    "missingness_year_type_matrix": _matrix(0, "{}"),
    "availability_matrix": _matrix(1, "1 - {}"),
    "gap_length_profile": _c(f"""SELECT variable_type, count(*) AS n_gaps, max(n_consecutive_missing_rows) AS max_gap, quantile_cont(n_consecutive_missing_rows, 0.5) AS median_gap
      FROM {_TYPED_GAPS} GROUP BY 1""", d="max_gap median_gap"),
    "gap_length_histogram": _c(f"""SELECT variable_type, bin, lo + bin * (hi - lo) / 50 AS bin_start, lo + (bin + 1) * (hi - lo) / 50 AS bin_end, count(n) AS n_rows
      FROM (SELECT variable_type, CASE WHEN a = b THEN a - 0.5::DOUBLE ELSE a END AS lo, CASE WHEN a = b THEN b + 0.5::DOUBLE ELSE b END AS hi, unnest(range(50)) AS bin
        FROM (SELECT variable_type, min(n_consecutive_missing_rows)::DOUBLE AS a, max(n_consecutive_missing_rows)::DOUBLE AS b FROM {_TYPED_GAPS} GROUP BY 1)) g
      LEFT JOIN (SELECT variable_type AS vt, n_consecutive_missing_rows::DOUBLE AS n FROM {_TYPED_GAPS}) v
        ON vt = variable_type AND least(floor((n - lo) / ((hi - lo) / 50)), 49)::BIGINT = bin GROUP BY 1, 2, 3, 4""", d="bin_start bin_end", i="bin"),
    "monthly_missing_trend": _c(f"""SELECT year_month, original_missing_rate, CASE WHEN count(*) OVER w = 6 THEN avg(original_missing_rate) OVER w END AS rolling_mean_6m
      FROM ({_MONTH}) WINDOW w AS (ORDER BY year_month ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING)""", d="original_missing_rate rolling_mean_6m"),
    "peak_missing_hour": _c(f"SELECT * FROM ({by_sql('hour(entry_date) AS hour')}) ORDER BY original_missing_rate DESC, hour LIMIT 1", d=_RATE, i="hour"),
    "invalid_nonzero_labelled": _c(f"""SELECT *, CASE issue WHEN 'negative_values_for_non_negative_variables' THEN 'Negative values' WHEN 'relative_humidity_outside_0_100' THEN 'Humidity out of range'
      WHEN 'wind_direction_outside_0_360' THEN 'Wind dir out of range' WHEN 'missing_coordinates' THEN 'Missing coordinates'
      WHEN 'duplicate_sensor_variable_timestamp_rows' THEN 'Duplicate rows' WHEN 'unknown_interpolation_flags' THEN 'Unknown interp. flags' ELSE issue END AS label
      FROM ({_INVALID}) WHERE n_rows > 0""", d="rate"),
}
