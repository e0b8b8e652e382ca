"""Registered queries: forecasting and report tables."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stationlens.operators import forecast as J
from stationlens.operators import impute as I
from stationlens.operators import profile as P
from stationlens.operators import report as K
from stationlens.operators import temporal as T
from stationlens.plans import adapters as A
from stationlens.plans import stage_network as net
from stationlens.plans import stage_temporal as tem
from stationlens.plans.base import check_sql, present
from stationlens.plans.stage_impute import _c as impute_sql
from stationlens.plans.stage_impute import imputed
from stationlens.plans.stage_load import daily, hourly
from stationlens.plans.stage_temporal import CTES as TEMPORAL
from stationlens.plans.store import stored
from stationlens.session import checkpointed

NAMES = ["NO2", "NOX", "O3", "TI_MAIN", "VV"]
# Fewer and shallower trees than the defaults, given as parameters.
PARAMS = {
    "random_forest": {"num_trees": 20, "max_depth": 5}, "gradient_boosting": {"num_trees": 10, "max_depth": 3},
    "boosting_deep": {"num_trees": 10, "max_depth": 4},
}


def panel(s, d):
    return J.build_panel(hourly(s, d), "daily", NAMES)


def split(s, d):
    return J.chronological_split(J.model_rows(panel(s, d), "NO2"))


def model(name):
    """Importances of one model for one target, written once."""
    def build(s, d):
        rows = checkpointed(split(s, d))
        return J.fit_and_predict(rows.filter("split = 'train'"), rows.filter("split = 'test'"), J.feature_columns(panel(s, d).columns), "NO2", name, **PARAMS[name])
    return lambda s, d: stored(s, d, f"importances_{name}", lambda s, d: build(s, d)[1])


def importances(s, d):
    a, b, c = (model(m)(s, d) for m in PARAMS)
    return a.unionByName(b).unionByName(c)


def predictions(s, d):
    return stored(s, d, "predictions", lambda s, d: J.run_models(hourly(s, d), ["NO2", "O3"], ("random_forest",), params=PARAMS)["predictions"])


def crude(s, d):
    """Predictions that need no fit: one predictor column stands in for the target itself."""
    rows = split(s, d)
    a = rows.select(F.lit("NO2").alias("target"), F.lit("vv").alias("model"), "position", F.col("label").alias("actual"), F.col("VV").alias("predicted"))
    return a.unionAll(rows.select(F.lit("NO2"), F.lit("ti"), "position", "label", "TI_MAIN"))


def crude_folds(s, d):
    rows = crude(s, d).withColumn("fold", (F.col("position") % 4).cast("string"))
    parts = [J.regression_metrics(rows.filter(F.col("fold") == str(f)), f"fold_{f}") for f in range(4)]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


def folds(s, d):
    return stored(s, d, "folds", lambda s, d: J.time_series_folds(split(s, d)))


def linear_folds(s, d):
    """Out-of-fold predictions of a line per fold and feature."""
    rows = folds(s, d)
    return J.side_by_side_linear(rows, "VV", "NO2", "fold").unionByName(J.side_by_side_linear(rows, "TI_MAIN", "NO2", "fold"))


def linear_test(s, d):
    """Predictions for the last fifth of the rows by lines fitted on the rows before."""
    rows = split(s, d).withColumn("role", F.col("split"))
    return J.side_by_side_linear(rows, "VV", "NO2").unionByName(J.side_by_side_linear(rows, "TI_MAIN", "NO2"))


def tree_folds(s, d):
    """Out-of-fold predictions of a forest, written once."""
    names = J.feature_columns(panel(s, d).columns)
    return stored(s, d, "tree_folds", lambda s, d: J.cross_validate(folds(s, d), names, "NO2", "random_forest", **PARAMS["random_forest"]))


def _features(s, d):
    """Which columns of the panel are features, decided from its schema."""
    p = panel(s, d)
    chosen = J.feature_columns(p.columns)
    return J.panel_availability(p).select("column", F.col("column").isin(chosen).alias("is_feature"), "non_null")


def _standardized(s, d):
    rows = J.assemble(split(s, d), J.feature_columns(panel(s, d).columns))
    scaled = J.standardize(rows.filter("split = 'train'")).transform(rows)
    return scaled.select("position", "split", vector_to_array("features").alias("v")).select("position", "split", F.col("v")[0].alias("first_feature"), F.col("v")[1].alias("second_feature"))


QUERIES = {
    "slice_readings": lambda s, d: J.slice_readings(daily(s, d), 1996, 1999, 5),
    "resolve_targets": lambda s, d: J.resolve_targets(daily(s, d)),
    "keep_traffic_family": lambda s, d: J.keep_traffic_family(hourly(s, d)),
    "aggregate_panel": lambda s, d: J.aggregate_panel(J.keep_traffic_family(hourly(s, d))),
    "wide_panel": lambda s, d: J.wide_panel(J.aggregate_panel(hourly(s, d), "hourly"), NAMES),
    "panel_time_features": panel,
    "feature_columns": _features,
    "model_rows": lambda s, d: J.model_rows(panel(s, d), "NO2"),
    "chronological_split": split,
    "time_series_folds": lambda s, d: J.time_series_folds(split(s, d)).select("time_key", "sensor_id", "position", "fold", "role"),
    "standardize": _standardized,
    "fit_random_forest": model("random_forest"),
    "fit_gradient_boosting": model("gradient_boosting"),
    "fit_boosting_deep": model("boosting_deep"),
    "regression_metrics": lambda s, d: J.regression_metrics(crude(s, d)),
    "cv_summary": lambda s, d: J.cv_summary(crude_folds(s, d)),
    "fold_predictions": linear_folds,
    "cross_validation": lambda s, d: J.fold_metrics(linear_folds(s, d)),
    "cross_validation_summary": lambda s, d: J.cv_summary(J.fold_metrics(linear_folds(s, d))),
    "cross_validation_forest": lambda s, d: J.fold_metrics(tree_folds(s, d)),
    "test_metrics": lambda s, d: J.regression_metrics(linear_test(s, d)),
    "best_test_model": lambda s, d: J.best_model(J.regression_metrics(linear_test(s, d))),
    "r2_matrix": lambda s, d: K.metric_matrix(J.regression_metrics(linear_test(s, d)), ["linear_TI_MAIN", "linear_VV"]),
    "feature_importances": importances,
    "panel_availability": lambda s, d: J.panel_availability(panel(s, d)),
    "best_model": lambda s, d: J.best_model(J.regression_metrics(crude(s, d))),
    "predictions": predictions,
    "top_features": lambda s, d: J.top_features(importances(s, d)),
    "top_features_by_model": lambda s, d: J.top_features_by_model(importances(s, d)),
    "top_interpolated": lambda s, d: K.top_interpolated(P.interpolation_by(daily(s, d), "magnitude_name")),
    "top_pollutant_profiles": lambda s, d: K.top_pollutant_profiles(T.yearly_trends(tem.subset(s, d)), "year", 4),
    "top_pollutant_hours": lambda s, d: K.top_pollutant_profiles(T.hourly_cycle(tem.subset(s, d)), "hour", 3),
    "top_pollutant_seasons": lambda s, d: K.top_pollutant_profiles(T.seasonal_cycle(tem.subset(s, d)), "month", 3),
    "sensor_map": lambda s, d: K.sensor_map(daily(s, d)),
    "network_comparison": lambda s, d: K.network_comparison(net.selected(s, d), net.summary(s, d, "correlation")),
    "imputation_comparison": lambda s, d: K.imputation_comparison(I.distribution_summary(imputed(s, d))),
    "metric_matrix": lambda s, d: K.metric_matrix(J.regression_metrics(crude(s, d)), ["ti", "vv"]),
    "top_mean_importance": lambda s, d: K.top_mean_importance(importances(s, d)),
    "utm_to_lonlat": lambda s, d: K.utm_to_lonlat(A.stations(s, d)),
    "edge_geometry": lambda s, d: K.edge_geometry(net.spatial_edges(s, d), A.stations(s, d)),
    "node_radius": lambda s, d: K.node_radius(A.stations(s, d), net.metrics(s, d), "knn_k3"),
    "graph_stats_lookup": lambda s, d: K.graph_stats_lookup(net.summary(s, d), "knn_k2"),
    "table_view": lambda s, d: K.table_view(tem.monthly(s, d), "mean_value", 20),
    "composition": lambda s, d: K.composition(daily(s, d)),
}
QUERIES = {k: (lambda s, d, f=f: present(f(s, d))) for k, f in QUERIES.items()}


def _lonlat():
    """The inverse projection written out in SQL."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    a = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * 0.9996
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    num = lambda x: f"CAST('{x!r}' AS DOUBLE)"
    xi1 = "xi" + "".join(f" - {num(b)} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, b in enumerate(beta, 1))
    eta1 = "eta" + "".join(f" - {num(b)} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, b in enumerate(beta, 1))
    lat = "chi" + "".join(f" + {num(c)} * sin({2 * j} * chi)" for j, c in enumerate(delta, 1))
    return f"""SELECT sensor_id, sensor_name, utm_x, utm_y, degrees(atan2(sinh(eta1), cos(xi1))) - 3 AS lon, degrees({lat}) AS lat FROM (
      SELECT *, asin(sin(xi1) / cosh(eta1)) AS chi FROM (SELECT *, {xi1} AS xi1, {eta1} AS eta1 FROM (SELECT *, utm_y / {num(a)} AS xi, (utm_x - 500000) / {num(a)} AS eta FROM stations)))"""


_LINE = """SELECT 'NO2' AS target, 'linear_{f}' AS model, {g} time_key, sensor_id, position, label AS actual, y + slope * ({f} - x) AS predicted FROM {src}
  JOIN (SELECT {g} coalesce(CASE WHEN var_pop({f}) > 0 THEN regr_slope(label, {f}) END, 0) AS slope, avg(label) AS y, avg({f}) AS x FROM {src} WHERE {role} = 'train' {by}) AS fit {on} WHERE {role} <> 'train'"""
CTES = {
    **TEMPORAL, **net.CTES,
    "pan": "SELECT date_trunc('day', entry_date) AS time_key, sensor_id, magnitude_name, avg(value) AS value FROM hourly GROUP BY ALL",
    "wide": "SELECT time_key, sensor_id, " + ", ".join(f"max(value) FILTER (WHERE magnitude_name = '{n}') AS {n}" for n in NAMES)
    + ", hour(time_key) AS hour, isodow(time_key) - 1 AS weekday, month(time_key) AS month, year(time_key) AS year FROM pan GROUP BY time_key, sensor_id",
    "mrows": """SELECT * FROM (SELECT time_key, sensor_id, TI_MAIN, VV, hour, weekday, month, year, NO2 AS label, count(*) OVER () AS n_rows FROM wide WHERE TI_MAIN IS NOT NULL AND VV IS NOT NULL AND NO2 IS NOT NULL) WHERE n_rows >= 50""",
    "spl": """SELECT *, CASE WHEN position < floor(n_rows * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM (SELECT *, row_number() OVER (ORDER BY time_key, sensor_id) - 1 AS position FROM mrows)""",
    "cru": "SELECT 'NO2' AS target, 'vv' AS model, position, label AS actual, VV AS predicted FROM spl UNION ALL SELECT 'NO2', 'ti', position, label, TI_MAIN FROM spl",
    "folds": """SELECT *, CASE WHEN position < f0 THEN 'train' ELSE 'validation' END AS role FROM (SELECT *, n - (5 - fold) * (n // 6) AS f0 FROM (
      SELECT *, count(*) OVER () AS n FROM spl WHERE split = 'train') CROSS JOIN (SELECT unnest(range(5)) AS fold)) WHERE position < f0 + n // 6""",
    "lin_f": " UNION ALL ".join(_LINE.format(f=f, src="folds", g="fold,", on="USING (fold)", by="GROUP BY fold", role="role") for f in ("VV", "TI_MAIN")),
    "lin_t": " UNION ALL ".join(_LINE.format(f=f, src="spl", g="", on="ON true", by="", role="split") for f in ("VV", "TI_MAIN")),
    "lonlat": _lonlat(),
}


def _c(body, **kw):
    return check_sql(body, ctes=CTES, **kw)


def _metrics(src, split_name, by="target, model"):
    return f"""SELECT target, model, {split_name} AS split, round_even(1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(*)), 4) AS r2, round_even(sqrt(avg((actual - predicted) ** 2)), 4) AS rmse,
      round_even(avg(abs(actual - predicted)), 4) AS mae, count(*) AS n_samples FROM {src} GROUP BY {by}"""


_FOLDS = _metrics("lin_f", "'validation'", "target, model, fold").replace("SELECT target, model,", "SELECT target, model, fold,")
_AVAIL_COLS = ["time_key", "sensor_id", *NAMES, "hour", "weekday", "month", "year"]
_CAL = "hour weekday month year"
_PAN = "NO2 NOX O3 TI_MAIN VV"
CHECKS = {
    "slice_readings": _c("""SELECT * EXCLUDE (was_missing, missing_flag_unknown) FROM daily WHERE year BETWEEN 1996 AND 1999 AND sensor_id IN (
      SELECT sensor_id FROM daily WHERE year BETWEEN 1996 AND 1999 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5)""", d="utm_x utm_y value", i="sensor_id magnitude_id year month hour weekday", t="entry_date"),
    "resolve_targets": _c("SELECT magnitude_name AS target FROM top3"),
    "keep_traffic_family": _c("SELECT * EXCLUDE (was_missing, missing_flag_unknown) FROM hourly", d="utm_x utm_y value", i="sensor_id magnitude_id year month hour weekday", t="entry_date"),
    "aggregate_panel": _c("SELECT * FROM pan", d="value", i="sensor_id", t="time_key"),
    "wide_panel": _c("SELECT entry_date AS time_key, sensor_id, " + ", ".join(f"avg(value) FILTER (WHERE magnitude_name = '{n}') AS {n}" for n in NAMES) + " FROM hourly GROUP BY 1, 2", d=_PAN, i="sensor_id", t="time_key"),
    "panel_time_features": _c("SELECT * FROM wide", d=_PAN, i=f"sensor_id {_CAL}", t="time_key"),
    "feature_columns": _c(" UNION ALL ".join(f"""SELECT '{c}' AS "column", {str(c in ("TI_MAIN", "VV", "hour", "weekday", "month", "year")).lower()} AS is_feature, count({c}) AS non_null FROM wide""" for c in _AVAIL_COLS)),
    "model_rows": _c("SELECT * FROM mrows", d="TI_MAIN VV label", i=f"sensor_id n_rows {_CAL}", t="time_key"),
    "chronological_split": _c("SELECT * FROM spl", d="TI_MAIN VV label", i=f"sensor_id n_rows position {_CAL}", t="time_key"),
    "time_series_folds": _c("""SELECT time_key, sensor_id, position, fold, CASE WHEN position < f0 THEN 'train' ELSE 'validation' END AS role FROM (SELECT *, n - (5 - fold) * (n // 6) AS f0 FROM (
      SELECT *, count(*) OVER () AS n FROM spl WHERE split = 'train') CROSS JOIN (SELECT unnest(range(5)) AS fold)) WHERE position < f0 + n // 6""", i="sensor_id position fold", t="time_key"),
    "standardize": _c("""SELECT position, split, (TI_MAIN - m1) / s1 AS first_feature, (VV - m2) / s2 AS second_feature FROM spl CROSS JOIN (SELECT avg(TI_MAIN) AS m1, stddev_samp(TI_MAIN) AS s1, avg(VV) AS m2, stddev_samp(VV) AS s2
      FROM spl WHERE split = 'train')""", d="first_feature second_feature", i="position"),
    "regression_metrics": _c(_metrics("cru", "'test'"), d="r2 rmse mae"),
    "cv_summary": _c(f"""SELECT target, model, avg(r2) AS mean_r2, stddev_samp(r2) AS std_r2, avg(rmse) AS mean_rmse, avg(mae) AS mean_mae FROM ({_metrics('cru', 'position % 4', 'target, model, position % 4')}) GROUP BY 1, 2""",
      d="mean_r2 std_r2 mean_rmse mean_mae"),
    "fold_predictions": _c("SELECT * FROM lin_f", d="actual predicted", i="sensor_id position fold", t="time_key"),
    "cross_validation": _c(f"SELECT * FROM ({_FOLDS})", d="r2 rmse mae", i="fold"),
    "cross_validation_summary": _c(f"SELECT target, model, avg(r2) AS mean_r2, stddev_samp(r2) AS std_r2, avg(rmse) AS mean_rmse, avg(mae) AS mean_mae FROM ({_FOLDS}) GROUP BY 1, 2", d="mean_r2 std_r2 mean_rmse mean_mae"),
    "test_metrics": _c(_metrics("lin_t", "'test'"), d="r2 rmse mae"),
    "best_test_model": _c(f"SELECT * FROM ({_metrics('lin_t', chr(39) + 'test' + chr(39))}) ORDER BY r2 DESC, model LIMIT 1", d="r2 rmse mae"),
    "r2_matrix": _c(f"SELECT target, max(r2) FILTER (WHERE model = 'linear_TI_MAIN') AS linear_TI_MAIN, max(r2) FILTER (WHERE model = 'linear_VV') AS linear_VV FROM ({_metrics('lin_t', chr(39) + 'test' + chr(39))}) GROUP BY 1", d="linear_TI_MAIN linear_VV"),
    "panel_availability": _c(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS non_null, round_even(1 - count({c}) / count(*)::DOUBLE, 4) AS null_rate FROM wide""" for c in _AVAIL_COLS), d="null_rate"),
    "best_model": _c(f"SELECT * FROM ({_metrics('cru', chr(39) + 'test' + chr(39))}) ORDER BY r2 DESC, model LIMIT 1", d="r2 rmse mae"),
    "top_interpolated": _c("""SELECT magnitude_name, avg(CAST(is_interpolated AS INTEGER)) AS interpolation_rate, count(*) FILTER (WHERE is_interpolated) AS interpolated_rows, count(is_interpolated) AS known_flag_rows, count(*) AS total_rows
      FROM daily GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""", d="interpolation_rate"),
    "top_pollutant_profiles": _c("SELECT magnitude_name, year, avg(mean_value) AS mean_value FROM cyc_y WHERE magnitude_name IN (SELECT magnitude_name FROM cyc_y GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 4) GROUP BY 1, 2", d="mean_value", i="year"),
    "top_pollutant_hours": _c("SELECT magnitude_name, hour, avg(mean_value) AS mean_value FROM cyc_h WHERE magnitude_name IN (SELECT magnitude_name FROM cyc_h GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3) GROUP BY 1, 2", d="mean_value", i="hour"),
    "top_pollutant_seasons": _c("SELECT magnitude_name, month, avg(mean_value) AS mean_value FROM cyc_m WHERE magnitude_name IN (SELECT magnitude_name FROM cyc_m GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3) GROUP BY 1, 2", d="mean_value", i="month"),
    "sensor_map": _c("""SELECT c.*, mean_no2 FROM (SELECT sensor_id, sensor_name, avg(utm_x) AS utm_x, avg(utm_y) AS utm_y FROM daily WHERE utm_x IS NOT NULL GROUP BY 1, 2) c
      LEFT JOIN (SELECT sensor_id, avg(value) AS mean_no2 FROM daily WHERE magnitude_name = 'NO2' GROUP BY 1) n ON c.sensor_id = n.sensor_id""", d="utm_x utm_y mean_no2", i="sensor_id"),
    "network_comparison": _c("""SELECT 'spatial' AS network, graph_name, n_nodes, n_edges, density, average_degree FROM sp_sel UNION ALL SELECT 'correlation', graph_name, n_nodes, n_edges, density, average_degree FROM (SELECT * FROM (
      SELECT *, list_position(['NO2', 'NOX', 'NO'], upper(magnitude)) AS o FROM co_s) WHERE o IS NOT NULL ORDER BY o, round(abs(threshold - 0.70::DOUBLE), 12), threshold LIMIT 1)""", d="density average_degree", i="n_nodes n_edges"),
    "node_radius": _c("""SELECT sensor_id, sensor_name, least(1200, greatest(300, 300 + 1000 * coalesce(betweenness_centrality, 0)))::DOUBLE AS radius FROM stations LEFT JOIN (SELECT * FROM btw WHERE graph_name = 'knn_k3') b ON b.id = sensor_id""", d="radius", i="sensor_id"),
    "graph_stats_lookup": _c("SELECT * FROM sp_s WHERE graph_name = 'knn_k2'", d=net._SUM, i=net._COUNTS + " threshold_m k"),
    "imputation_comparison": impute_sql("SELECT series, avg(x) AS mean FROM tall GROUP BY 1", d="mean"),
    "metric_matrix": _c(f"SELECT target, max(r2) FILTER (WHERE model = 'ti') AS ti, max(r2) FILTER (WHERE model = 'vv') AS vv FROM ({_metrics('cru', chr(39) + 'test' + chr(39))}) GROUP BY 1", d="ti vv"),
    "utm_to_lonlat": _c("SELECT * FROM lonlat", d="utm_x utm_y lon lat", i="sensor_id"),
    "edge_geometry": _c("""SELECT graph_name, src, dst, a.lon AS source_lon, a.lat AS source_lat, b.lon AS target_lon, b.lat AS target_lat FROM sp_e JOIN lonlat a ON a.sensor_id = src JOIN lonlat b ON b.sensor_id = dst""",
      d="source_lon source_lat target_lon target_lat", i="src dst"),
    "table_view": _c("""SELECT magnitude_name, sensor_id, sensor_name, month, round_even(mean_value, 3) AS mean_value, round_even(median_value, 3) AS median_value, round_even(std_value, 3) AS std_value, n_observations
      FROM mon ORDER BY mon.mean_value DESC, magnitude_name, sensor_id, sensor_name, month LIMIT 20""", d="mean_value median_value std_value", i="sensor_id", dates="month"),
    "composition": _c("""SELECT variable_type, count(*) AS n_rows, count(*) / (SELECT count(*) FROM daily)::DOUBLE AS share, avg(CAST(is_interpolated AS INTEGER)) AS missing_rate FROM daily GROUP BY 1""", d="share missing_rate"),
}
