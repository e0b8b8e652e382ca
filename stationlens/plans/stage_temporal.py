"""Registered queries: temporal analysis."""

from pyspark.sql import functions as F

from stationlens.functions import columns as K
from stationlens.operators import temporal as T
from stationlens.plans.base import check_sql, present
from stationlens.plans.stage_load import daily


def subset(s, d):
    return T.select_temporal_subset(daily(s, d))


def monthly(s, d):
    return T.monthly_by_sensor(subset(s, d))


def overall(s, d):
    return T.monthly_overall(monthly(s, d))


def trends(s, d):
    return T.mann_kendall(overall(s, d))


def acf(s, d):
    return T.autocorrelation(overall(s, d))


def cycles(s, d):
    return T.cycle_strength(T.hourly_cycle(subset(s, d)), T.seasonal_cycle(subset(s, d)))


QUERIES = {
    "select_temporal_subset": subset,
    "selected_pollutants": lambda s, d: T.selected_pollutants(daily(s, d)),
    "selected_pollutants_by_user": lambda s, d: T.selected_pollutants(daily(s, d), ["no2", "o3", "VV"], include_interpolated=False),
    "monthly_by_sensor": monthly,
    "monthly_overall": overall,
    "hourly_cycle": lambda s, d: T.hourly_cycle(subset(s, d)),
    "weekday_cycle": lambda s, d: T.weekday_cycle(subset(s, d)),
    "seasonal_cycle": lambda s, d: T.seasonal_cycle(subset(s, d)),
    "yearly_trends": lambda s, d: T.yearly_trends(subset(s, d)),
    "station_trend_slopes": lambda s, d: T.station_trend_slopes(monthly(s, d)),
    "trend_stability": lambda s, d: T.trend_stability(T.station_trend_slopes(monthly(s, d))),
    "mann_kendall": trends,
    "theil_sen": lambda s, d: T.theil_sen(overall(s, d)),
    "cycle_strength": cycles,
    "autocorrelation": acf,
    "station_year_matrix": lambda s, d: T.station_year_matrix(monthly(s, d), "NO2"),
    "seasonal_anticorrelation": lambda s, d: T.seasonal_anticorrelation(T.monthly_overall(T.monthly_by_sensor(daily(s, d)))),
    "yearly_overall": lambda s, d: T.yearly_overall(overall(s, d)),
    "period_change": lambda s, d: T.period_change(T.yearly_overall(overall(s, d)), (1995, 1997), (1998, 1999)),
    "cycle_overall": lambda s, d: T.cycle_overall(T.hourly_cycle(subset(s, d)), "hour").select("magnitude_name", F.lit("hour").alias("cycle"), F.col("hour").alias("position"), "mean_value")
    .unionAll(T.cycle_overall(T.weekday_cycle(subset(s, d)), "weekday").select("magnitude_name", F.lit("weekday"), "weekday", "mean_value"))
    .unionAll(T.cycle_overall(T.seasonal_cycle(subset(s, d)), "month").select("magnitude_name", F.lit("month"), "month", "mean_value")),
    "temporal_interpretation": lambda s, d: T.temporal_interpretation(acf(s, d), cycles(s, d), trends(s, d)),
    "normal_cdf": lambda s, d: monthly(s, d).select("magnitude_name", "sensor_id", "month", K.normal_cdf((F.col("mean_value") - 25.5) / 2.0).alias("phi")),
    "trend_groups": lambda s, d: T.trend_groups(trends(s, d), acf(s, d), 0.0),
}
QUERIES = {k: (lambda s, d, f=f: present(f(s, d))) for k, f in QUERIES.items()}


def _hart(a):
    """The distribution function at -|a| as SQL, a >= 0."""
    def horner(cs):
        out = f"{cs[0]!r}::DOUBLE"
        for c in cs[1:]:
            out = f"({out} * {a} + {c!r}::DOUBLE)"
        return out
    tail = f"({a} + 0.65::DOUBLE)"
    for k in (4, 3, 2, 1):
        tail = f"({a} + {k} / {tail})"
    e = f"exp(-({a} * {a}) / 2)"
    return f"CASE WHEN {a} > 37 THEN 0 WHEN {a} < {K._HART_SWITCH!r}::DOUBLE THEN {e} * {horner(K._HART_P)} / {horner(K._HART_Q)} ELSE {e} / {tail} / {K._HART_ROOT_2PI!r}::DOUBLE END"


def _corr(a, b):
    return f"CASE WHEN min({a}) FILTER (WHERE {b} IS NOT NULL) < max({a}) FILTER (WHERE {b} IS NOT NULL) AND min({b}) FILTER (WHERE {a} IS NOT NULL) < max({b}) FILTER (WHERE {a} IS NOT NULL) THEN corr({a}, {b}) END"


CTES = {
    "top3": "SELECT magnitude_name FROM daily WHERE variable_type = 'pollutant' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3",
    "sub": "SELECT * FROM daily WHERE magnitude_name IN (SELECT magnitude_name FROM top3)",
    "mon": """SELECT magnitude_name, sensor_id, sensor_name, last_day(entry_date) AS month, avg(value) AS mean_value, quantile_cont(value, 0.5) AS median_value,
      stddev_samp(value) AS std_value, count(value) AS n_observations FROM sub GROUP BY ALL""",
    "ove": """SELECT magnitude_name, month, avg(mean_value) AS mean_across_sensors, quantile_cont(mean_value, 0.5) AS median_across_sensors,
      stddev_samp(mean_value) AS std_across_sensors, count(DISTINCT sensor_id) AS n_sensors FROM mon GROUP BY ALL""",
    "slopes": """SELECT magnitude_name, sensor_id, sensor_name, regr_slope(mean_value, x) AS monthly_trend_slope FROM (
      SELECT *, row_number() OVER (PARTITION BY magnitude_name, sensor_id, sensor_name ORDER BY month) - 1 AS x FROM mon) GROUP BY ALL""",
    "posn": "SELECT magnitude_name, mean_across_sensors AS x, row_number() OVER (PARTITION BY magnitude_name ORDER BY month) - 1 AS i, count(*) OVER (PARTITION BY magnitude_name) AS n FROM ove",
    "mk0": """SELECT a.magnitude_name, a.n, sum(CAST(sign(round(b.x - a.x, 9)) AS BIGINT))::BIGINT AS s, quantile_cont((b.x - a.x) / (b.i - a.i), 0.5) AS ts
      FROM posn a JOIN posn b ON a.magnitude_name = b.magnitude_name AND a.i < b.i WHERE a.n >= 8 GROUP BY 1, 2""",
    "mk1": "SELECT *, abs((s - sign(s)) / sqrt(n * (n - 1) * (2 * n + 5) / 18.0::DOUBLE)) AS az, (s - sign(s)) / sqrt(n * (n - 1) * (2 * n + 5) / 18.0::DOUBLE) AS z, s / (0.5::DOUBLE * n * (n - 1)) AS tau FROM mk0",
    "mk": f"""SELECT magnitude_name, s AS mk_s, round_even(tau, 4) AS mk_tau, round_even(z, 4) AS mk_z, round_even(p, 4) AS mk_p_value, p < 0.05 AS mk_significant,
      CASE WHEN tau < 0 THEN 'decreasing' WHEN tau > 0 THEN 'increasing' ELSE 'no trend' END AS trend_direction, round_even(ts, 6) AS theil_sen_slope_per_month, n AS n_months
      FROM (SELECT *, 2 * (1 - (1 - ({_hart('az')}))) AS p FROM mk1)""",
    "acf": f"""SELECT magnitude_name, {_corr('x', 'l12')} AS acf_lag12, {_corr('x', 'l6')} AS acf_lag6, {_corr('x', 'l1')} AS acf_lag1, count(*) AS n_months FROM (
      SELECT *, lag(x, 12) OVER w AS l12, lag(x, 6) OVER w AS l6, lag(x, 1) OVER w AS l1 FROM posn WINDOW w AS (PARTITION BY magnitude_name ORDER BY i)) GROUP BY 1 HAVING count(*) >= 13""",
    "cyc_h": "SELECT magnitude_name, sensor_id, sensor_name, hour(entry_date) AS hour, avg(value) AS mean_value, quantile_cont(value, 0.5) AS median_value, count(value) AS n_observations FROM sub GROUP BY ALL",
    "cyc_w": "SELECT magnitude_name, sensor_id, sensor_name, isodow(entry_date) - 1 AS weekday, avg(value) AS mean_value, quantile_cont(value, 0.5) AS median_value, count(value) AS n_observations FROM sub GROUP BY ALL",
    "cyc_m": "SELECT magnitude_name, sensor_id, sensor_name, month(entry_date) AS month, avg(value) AS mean_value, quantile_cont(value, 0.5) AS median_value, count(value) AS n_observations FROM sub GROUP BY ALL",
    "cyc_y": "SELECT magnitude_name, sensor_id, sensor_name, year(entry_date) AS year, avg(value) AS mean_value, quantile_cont(value, 0.5) AS median_value, count(value) AS n_observations FROM sub GROUP BY ALL",
    "amp": """SELECT coalesce(h.magnitude_name, m.magnitude_name) AS magnitude_name, hourly_min, hourly_max, hourly_max - hourly_min AS hourly_amplitude, seasonal_min, seasonal_max, seasonal_max - seasonal_min AS seasonal_amplitude FROM
      (SELECT magnitude_name, min(v) AS hourly_min, max(v) AS hourly_max FROM (SELECT magnitude_name, hour, avg(mean_value) AS v FROM cyc_h GROUP BY 1, 2) GROUP BY 1) h FULL JOIN
      (SELECT magnitude_name, min(v) AS seasonal_min, max(v) AS seasonal_max FROM (SELECT magnitude_name, month, avg(mean_value) AS v FROM cyc_m GROUP BY 1, 2) GROUP BY 1) m ON h.magnitude_name = m.magnitude_name""",
    "ove_all": """SELECT magnitude_name, month, avg(mean_value) AS mean_across_sensors FROM (SELECT magnitude_name, sensor_id, last_day(entry_date) AS month, avg(value) AS mean_value FROM daily GROUP BY ALL) GROUP BY ALL""",
}


def _c(body, **kw):
    return check_sql(body, ctes=CTES, **kw)


_CYC = dict(d="mean_value median_value")
CHECKS = {
    "select_temporal_subset": _c("SELECT * EXCLUDE (was_missing, missing_flag_unknown) FROM sub", d="utm_x utm_y value", i="sensor_id magnitude_id year month hour weekday", t="entry_date"),
    "selected_pollutants": _c("SELECT magnitude_name AS selected_magnitude, 'top_pollutant_by_row_count' AS selection_reason FROM top3"),
    "selected_pollutants_by_user": _c("SELECT DISTINCT magnitude_name AS selected_magnitude, 'user_selected' AS selection_reason FROM daily WHERE magnitude_name IN ('NO2', 'O3') AND NOT coalesce(is_interpolated, false)"),
    "monthly_by_sensor": _c("SELECT * FROM mon", d="mean_value median_value std_value", i="sensor_id", dates="month"),
    "monthly_overall": _c("SELECT * FROM ove", d="mean_across_sensors median_across_sensors std_across_sensors", dates="month"),
    "hourly_cycle": _c("SELECT * FROM cyc_h", i="sensor_id hour", **_CYC),
    "weekday_cycle": _c("SELECT * FROM cyc_w", i="sensor_id weekday", **_CYC),
    "seasonal_cycle": _c("SELECT * FROM cyc_m", i="sensor_id month", **_CYC),
    "yearly_trends": _c("SELECT * FROM cyc_y", i="sensor_id year", **_CYC),
    "station_trend_slopes": _c("SELECT * FROM slopes", d="monthly_trend_slope", i="sensor_id"),
    "trend_stability": _c("""SELECT magnitude_name, avg(monthly_trend_slope) AS mean_station_slope, quantile_cont(monthly_trend_slope, 0.5) AS median_station_slope, stddev_samp(monthly_trend_slope) AS std_station_slope,
      min(monthly_trend_slope) AS min_station_slope, max(monthly_trend_slope) AS max_station_slope, count(monthly_trend_slope) AS n_sensors FROM slopes GROUP BY 1""",
      d="mean_station_slope median_station_slope std_station_slope min_station_slope max_station_slope"),
    "mann_kendall": _c("SELECT * FROM mk", d="mk_tau mk_z mk_p_value theil_sen_slope_per_month", i="mk_s n_months"),
    "theil_sen": _c("SELECT magnitude_name, round_even(ts, 6) AS theil_sen_slope_per_month, n AS n_months FROM mk0", d="theil_sen_slope_per_month"),
    "cycle_strength": _c("SELECT * FROM amp", d="hourly_min hourly_max hourly_amplitude seasonal_min seasonal_max seasonal_amplitude"),
    "autocorrelation": _c("SELECT * FROM acf", d="acf_lag12 acf_lag6 acf_lag1"),
    "station_year_matrix": _c("""SELECT *, dense_rank() OVER (ORDER BY station_mean DESC, sensor_name) AS rank FROM (SELECT *, avg(mean_value) OVER (PARTITION BY sensor_name) AS station_mean FROM (
      SELECT sensor_name, year(month) AS year, avg(mean_value) AS mean_value FROM mon WHERE magnitude_name = 'NO2' AND sensor_name IN (
        SELECT sensor_name FROM mon WHERE magnitude_name = 'NO2' GROUP BY 1 ORDER BY avg(mean_value) DESC, 1 LIMIT 10) GROUP BY ALL))""", d="mean_value station_mean", i="year"),
    "seasonal_anticorrelation": _c("""SELECT 'NO2' AS magnitude_a, 'O3' AS magnitude_b, corr(a, b) AS pearson_r, count(*) AS n_common_months FROM
      (SELECT month(month) AS m, avg(mean_across_sensors) AS a FROM ove_all WHERE magnitude_name = 'NO2' GROUP BY 1) JOIN
      (SELECT month(month) AS m, avg(mean_across_sensors) AS b FROM ove_all WHERE magnitude_name = 'O3' GROUP BY 1) USING (m)""", d="pearson_r"),
    "yearly_overall": _c("SELECT magnitude_name, year(month) AS year, avg(mean_across_sensors) AS mean_across_sensors FROM ove GROUP BY ALL", d="mean_across_sensors", i="year"),
    "period_change": _c("""SELECT *, 100 * (mean_after - mean_before) / mean_before AS pct_change FROM (SELECT magnitude_name, avg(y) FILTER (WHERE year BETWEEN 1995 AND 1997) AS mean_before, avg(y) FILTER (WHERE year BETWEEN 1998 AND 1999) AS mean_after
      FROM (SELECT magnitude_name, year(month) AS year, avg(mean_across_sensors) AS y FROM ove GROUP BY ALL) GROUP BY 1)""", d="mean_before mean_after pct_change"),
    "cycle_overall": _c("""SELECT magnitude_name, 'hour' AS cycle, hour AS position, avg(mean_value) AS mean_value FROM cyc_h GROUP BY ALL UNION ALL
      SELECT magnitude_name, 'weekday', weekday, avg(mean_value) FROM cyc_w GROUP BY ALL UNION ALL SELECT magnitude_name, 'month', month, avg(mean_value) FROM cyc_m GROUP BY ALL""", d="mean_value", i="position"),
    "temporal_interpretation": _c("""SELECT acf.magnitude_name, round_even(acf_lag12, 3) AS acf_lag12, CASE WHEN acf_lag12 >= 0.7 THEN 'very strong' WHEN acf_lag12 >= 0.5 THEN 'strong' WHEN acf_lag12 >= 0.3 THEN 'moderate' ELSE 'weak' END AS seasonality_strength,
      round_even(hourly_amplitude, 2) AS hourly_amplitude, round_even(seasonal_amplitude, 2) AS seasonal_amplitude, round_even(mk_tau, 3) AS mk_tau, mk_p_value, trend_direction,
      round_even(theil_sen_slope_per_month, 4) AS theil_sen_slope_per_month FROM acf LEFT JOIN amp ON acf.magnitude_name = amp.magnitude_name LEFT JOIN mk ON acf.magnitude_name = mk.magnitude_name""",
      d="acf_lag12 hourly_amplitude seasonal_amplitude mk_tau mk_p_value theil_sen_slope_per_month"),
    "normal_cdf": _c(f"SELECT magnitude_name, sensor_id, month, CASE WHEN u > 0 THEN 1 - ({_hart('abs(u)')}) ELSE {_hart('abs(u)')} END AS phi FROM (SELECT *, (mean_value - 25.5) / 2.0 AS u FROM mon)", d="phi", i="sensor_id", dates="month"),
    "trend_groups": _c("""SELECT count(*) FILTER (WHERE trend_direction = 'decreasing') AS n_improving, coalesce(string_agg(magnitude_name, ', ' ORDER BY magnitude_name) FILTER (WHERE trend_direction = 'decreasing'), '') AS improving,
      count(*) FILTER (WHERE trend_direction = 'increasing') AS n_worsening, coalesce(string_agg(magnitude_name, ', ' ORDER BY magnitude_name) FILTER (WHERE trend_direction = 'increasing'), '') AS worsening,
      count(*) FILTER (WHERE mk_significant) AS n_significant, (SELECT coalesce(string_agg(magnitude_name, ', ' ORDER BY magnitude_name), '') FROM acf WHERE acf_lag12 >= 0) AS strong_seasonality FROM mk"""),
}
