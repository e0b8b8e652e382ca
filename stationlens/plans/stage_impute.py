"""Registered queries: imputation and its comparison."""

from stationlens import schema as S
from stationlens.operators import impute as I
from stationlens.plans.base import check_sql, present
from stationlens.plans.store import stored
from stationlens.plans.stage_load import daily
from stationlens.plans.stage_quality import flagged


def masked(spark, sf):
    return I.mask_original_missing(flagged(spark, sf))


def _one(fn, col):
    return lambda s, d: fn(masked(s, d)).select("sensor_id", "magnitude_name", "entry_date", "value", "was_missing", col)


def imputed(spark, sf):
    """Readings with all five imputed columns, written once for the comparisons."""
    return stored(spark, sf, "imputed", lambda s, d: I.impute_all(flagged(s, d)))


def comparison(spark, sf):
    return I.compare_imputations(imputed(spark, sf))


_ALL = ["sensor_id", "magnitude_name", "entry_date", "value", "was_missing", *S.METHODS]
QUERIES = {
    "select_subset": lambda s, d: I.select_subset(daily(s, d), "Pollutant", ["no2", "O3"]),
    "mask_original_missing": masked,
    "impute_grouped_mean": _one(I.impute_grouped_mean, "imputed_grouped_mean"),
    "impute_grouped_median": _one(I.impute_grouped_median, "imputed_grouped_median"),
    "impute_ffill": _one(I.impute_ffill, "imputed_ffill"),
    "impute_bfill": _one(I.impute_bfill, "imputed_bfill"),
    "impute_last_next": _one(I.impute_last_next, "imputed_last_next"),
    "impute_all": lambda s, d: I.impute_all(flagged(s, d)).select(*_ALL),
    "compare_imputations": comparison,
    "imputation_error_summary": lambda s, d: I.imputation_error_summary(comparison(s, d)),
    "imputation_errors_by_type": lambda s, d: I.imputation_errors_by_type(comparison(s, d)),
    "imputation_errors_by_magnitude": lambda s, d: I.imputation_errors_by_magnitude(comparison(s, d)),
    "distribution_summary": lambda s, d: I.distribution_summary(imputed(s, d)),
    "reproducible_sample": lambda s, d: I.reproducible_sample(I.compare_imputations(masked(s, d)).select("sensor_id", "magnitude_name", "entry_date", "provided_interpolation"), 5000),
    "density_curves": lambda s, d: I.density_curves(imputed(s, d)),
    "central_range": lambda s, d: I.central_range(imputed(s, d)),
    "box_stats": lambda s, d: I.box_stats(comparison(s, d)),
    "method_mae_bias": lambda s, d: I.method_mae_bias(I.imputation_error_summary(comparison(s, d))),
    "method_mae_by_type": lambda s, d: I.method_mae_by_type(I.imputation_errors_by_type(comparison(s, d))),
}
QUERIES = {k: (lambda s, d, f=f: present(f(s, d))) for k, f in QUERIES.items()}

_W = "PARTITION BY sensor_id, magnitude_name ORDER BY entry_date, v IS NULL, v"
_CTES = {
    "masked": "SELECT *, value AS provided_interpolation, CASE WHEN NOT coalesce(was_missing, false) THEN value END AS v FROM daily",
    "series_stats": "SELECT sensor_id, magnitude_name, avg(v) AS mean_s, quantile_cont(v, 0.5) AS med_s FROM masked GROUP BY 1, 2",
    "variable_stats": "SELECT magnitude_name, avg(v) AS mean_v, quantile_cont(v, 0.5) AS med_v FROM masked GROUP BY 1",
    "imputed": f"""SELECT m.*, coalesce(v, mean_s, mean_v, mean_a) AS imputed_grouped_mean, coalesce(v, med_s, med_v, med_a) AS imputed_grouped_median,
      coalesce(p, med_s, med_a) AS imputed_ffill, coalesce(n, med_s, med_a) AS imputed_bfill, coalesce((p + n) / 2, p, n, med_s, med_v, med_a) AS imputed_last_next
      FROM (SELECT *, last_value(v IGNORE NULLS) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS p,
        first_value(v IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM masked) m
      JOIN series_stats USING (sensor_id, magnitude_name) JOIN variable_stats USING (magnitude_name)
      CROSS JOIN (SELECT avg(v) AS mean_a, quantile_cont(v, 0.5) AS med_a FROM masked)""",
    "compared": "SELECT * FROM imputed WHERE was_missing",
    "errors": " UNION ALL ".join(f"SELECT magnitude_name, variable_type, '{m}' AS method, '{l}' AS method_label, {m} - provided_interpolation AS e FROM compared" for m, l in S.METHOD_LABELS.items()),
    "tall": "SELECT magnitude_name, 'real_observed_values' AS series, v AS x FROM imputed WHERE NOT coalesce(was_missing, false) UNION ALL SELECT magnitude_name, 'provided_interpolation', provided_interpolation FROM compared"
    + "".join(f" UNION ALL SELECT magnitude_name, '{l}', {m} FROM compared" for m, l in S.METHOD_LABELS.items()),
}


def _c(body, **kw):
    return check_sql(body, ctes=_CTES, **kw)


_ID = dict(i="sensor_id", t="entry_date")
_FULL_COLS = "entry_date, sensor_id, sensor_name, utm_x, utm_y, magnitude_id, magnitude_name, value, is_interpolated, year, month, hour, weekday, variable_type, was_missing, missing_flag_unknown, provided_interpolation, v AS value_original_missing"
_INTS = "sensor_id magnitude_id year month hour weekday"


def _impute_check(*cols):
    return _c(f"SELECT sensor_id, magnitude_name, entry_date, value, was_missing, {', '.join(cols)} FROM imputed", d="value " + " ".join(cols), **_ID)


def _errors(keys):
    k = "".join(x + ", " for x in keys)
    return f"""SELECT {k}method, method_label, count(*) AS n_compared_rows, avg(e) AS mean_error, avg(abs(e)) AS mae,
      quantile_cont(abs(e), 0.5) AS median_absolute_error, sqrt(avg(e * e)) AS rmse FROM errors GROUP BY ALL"""


_E = "mean_error mae median_absolute_error rmse"
_EC = ", ".join(f"{m} - provided_interpolation AS error_{m}, abs({m} - provided_interpolation) AS abs_error_{m}, ({m} - provided_interpolation) ** 2 AS squared_error_{m}" for m in S.METHODS)
_SAMPLE = "md5('42|' || sensor_id || '|' || magnitude_name || '|' || strftime(entry_date, '%Y-%m-%d %H:%M:%S')), sensor_id, magnitude_name, entry_date, provided_interpolation"
_BOX = "SELECT method, abs(e) AS a FROM errors"
CHECKS = {
    "select_subset": _c("SELECT * EXCLUDE (missing_flag_unknown) FROM daily WHERE magnitude_name IN ('NO2', 'O3')", d="utm_x utm_y value", i=_INTS, t="entry_date"),
    "mask_original_missing": _c(f"SELECT {_FULL_COLS} FROM masked", d="utm_x utm_y value provided_interpolation value_original_missing", i=_INTS, t="entry_date"),
    **{f"impute_{m[8:]}": _impute_check(m) for m in S.METHODS},
    "impute_all": _impute_check(*S.METHODS),
    "compare_imputations": _c(f"""SELECT sensor_id, sensor_name, magnitude_name, variable_type, entry_date, provided_interpolation, was_missing, is_interpolated,
      {', '.join(S.METHODS)}, {_EC} FROM compared""", d="provided_interpolation " + " ".join(S.METHODS) + " " + " ".join(f"{p}_{m}" for m in S.METHODS for p in ("error", "abs_error", "squared_error")), **_ID),
    "imputation_error_summary": _c(f"""SELECT method, method_label, count(*) AS n_compared_rows, avg(e) AS mean_error, quantile_cont(e, 0.5) AS median_error, avg(abs(e)) AS mae,
      quantile_cont(abs(e), 0.5) AS median_absolute_error, sqrt(avg(e * e)) AS rmse, max(abs(e)) AS max_absolute_error, '{I.NOTE}' AS note FROM errors GROUP BY 1, 2""", d=_E + " median_error max_absolute_error"),
    "imputation_errors_by_type": _c(_errors(["variable_type"]), d=_E),
    "imputation_errors_by_magnitude": _c(_errors(["variable_type", "magnitude_name"]), d=_E),
    "distribution_summary": _c("""SELECT series, count(*) AS n, avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min, quantile_cont(x, 0.01) AS q01, quantile_cont(x, 0.05) AS q05,
      quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q75, quantile_cont(x, 0.95) AS q95, quantile_cont(x, 0.99) AS q99, max(x) AS max
      FROM tall GROUP BY 1""", d="mean std min q01 q05 q25 median q75 q95 q99 max"),
    "reproducible_sample": _c(f"SELECT sensor_id, magnitude_name, entry_date, provided_interpolation FROM masked WHERE was_missing ORDER BY {_SAMPLE} LIMIT 5000", d="provided_interpolation", **_ID),
    "density_curves": _c("""WITH s AS (SELECT magnitude_name, series, count(*) AS n, stddev_samp(x) * count(*) ** -0.2::DOUBLE AS h, min(x) AS lo, max(x) AS hi FROM tall
        WHERE magnitude_name IN (SELECT magnitude_name FROM compared WHERE variable_type = 'pollutant' GROUP BY 1 HAVING count(*) >= 50) GROUP BY 1, 2 HAVING count(*) >= 10 AND count(DISTINCT x) >= 2),
      g AS (SELECT *, lo - (hi - lo) / 2 + point * ((hi - lo) * 2 / 999) AS gx FROM (SELECT *, unnest(range(1000)) AS point FROM s)),
      c AS (SELECT magnitude_name, series, x, count(*) AS w FROM tall GROUP BY 1, 2, 3)
      SELECT g.magnitude_name, g.series, g.point, g.gx AS x, sum(w * exp(-(((gx - c.x) / h) * ((gx - c.x) / h)) / 2)) / any_value(n * h * sqrt(2 * pi())) AS density
      FROM g JOIN c ON g.magnitude_name = c.magnitude_name AND g.series = c.series GROUP BY 1, 2, 3, 4""", d="x density", i="point"),
    "central_range": _c("""SELECT magnitude_name, q01, q99, q01 - abs(q01) * 0.1 AS range_low, q99 + abs(q99) * 0.1 AS range_high FROM (
      SELECT magnitude_name, quantile_cont(v, 0.01) AS q01, quantile_cont(v, 0.99) AS q99 FROM imputed WHERE NOT coalesce(was_missing, false) GROUP BY 1 HAVING count(v) > 10)""", d="q01 q99 range_low range_high"),
    "box_stats": _c(f"""WITH b AS ({" UNION ALL ".join(f"SELECT '{m}' AS method, abs({m} - provided_interpolation) AS a FROM compared" for m in S.METHODS)}),
      q AS (SELECT method, quantile_cont(a, 0.25) AS q1, quantile_cont(a, 0.5) AS median, quantile_cont(a, 0.75) AS q3 FROM b GROUP BY 1)
      SELECT q.method, q1, median, q3, min(a) FILTER (WHERE a >= q1 - 1.5 * (q3 - q1)) AS whisker_low, max(a) FILTER (WHERE a <= q3 + 1.5 * (q3 - q1)) AS whisker_high
      FROM q JOIN b ON q.method = b.method GROUP BY ALL""", d="q1 median q3 whisker_low whisker_high"),
    "method_mae_bias": _c("""SELECT method, method_label, avg(abs(e)) AS mae, avg(e) AS bias, row_number() OVER (ORDER BY avg(abs(e)), method) = 1 AS is_best
      FROM errors GROUP BY 1, 2""", d="mae bias"),
    "method_mae_by_type": _c("""SELECT variable_type, method, method_label, avg(abs(e)) AS mae, avg(e) AS bias, row_number() OVER (PARTITION BY variable_type ORDER BY avg(abs(e)), method) = 1 AS is_best
      FROM errors GROUP BY 1, 2, 3""", d="mae bias"),
}
