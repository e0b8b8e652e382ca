"""Leakage-safe forecasting of pollutants from weather, traffic and the calendar."""

from functools import reduce

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlens import schema as S
from stationlens.functions.columns import is_pollutant, is_traffic, ratio, upper_name
from stationlens.functions.quantiles import attach_scalar
from stationlens.session import checkpointed

TIME_FEATURES = ["hour", "weekday", "month", "year"]
MIN_MODEL_ROWS = 50


def slice_readings(df: DataFrame, start_year: int = None, end_year: int = None, max_sensors: int = None) -> DataFrame:
    """Years in bounds (inclusive) and, optionally, only the sensors with most rows."""
    if start_year is not None:
        df = df.filter(F.col("year") >= start_year)
    if end_year is not None:
        df = df.filter(F.col("year") <= end_year)
    if max_sensors is None:
        return df
    top = df.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "sensor_id").limit(max_sensors)
    return df.join(F.broadcast(top.select("sensor_id")), "sensor_id", "left_semi")  # at most max_sensors ids


def resolve_targets(df: DataFrame, targets=None, top: int = 3) -> DataFrame:
    """Upper-case target names: the given ones, or the pollutants with most rows."""
    if targets is not None:
        return df.sparkSession.createDataFrame([(t.upper(),) for t in targets], "target string")
    counts = df.filter(is_pollutant()).groupBy("magnitude_name").agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.desc("_n"), "magnitude_name").limit(top).select(F.upper("magnitude_name").alias("target"))


def keep_traffic_family(df: DataFrame) -> DataFrame:
    """Of the traffic variants only the preferred family."""
    return df.filter(~is_traffic() | upper_name().startswith(S.PREFERRED_TRAFFIC_PREFIX))


def aggregate_panel(df: DataFrame, aggregate: str = "daily") -> DataFrame:
    """Mean per (day or hour, sensor, variable)."""
    key = F.date_trunc("day" if aggregate == "daily" else "hour", "entry_date")
    return df.groupBy(key.alias("time_key"), "sensor_id", F.trim("magnitude_name").alias("magnitude_name")).agg(F.avg("value").alias("value"))


def variable_names(panel: DataFrame) -> list:
    """The variables of a panel: a list as long as the catalogue."""
    return sorted(r.magnitude_name for r in panel.select("magnitude_name").distinct().collect())


def wide_panel(panel: DataFrame, names) -> DataFrame:
    """One row per (time, sensor), one column per variable."""
    return panel.groupBy("time_key", "sensor_id").pivot("magnitude_name", list(names)).agg(F.first("value"))


def panel_time_features(wide: DataFrame) -> DataFrame:
    return wide.withColumns(
        {"hour": F.hour("time_key"), "weekday": F.weekday("time_key"), "month": F.month("time_key"), "year": F.year("time_key")}
    )


def build_panel(df: DataFrame, aggregate: str = "daily", names=None) -> DataFrame:
    panel = aggregate_panel(keep_traffic_family(df), aggregate)
    return panel_time_features(wide_panel(panel, names or variable_names(panel)))


def feature_columns(columns) -> list:
    """Weather and traffic columns and the calendar; never a pollutant."""
    def allowed(name):
        up = name.strip().upper()
        return up in S.WEATHER or any(up.startswith(p) for p in S.TRAFFIC_PREFIXES)

    return [c for c in columns if c not in ("time_key", "sensor_id", *TIME_FEATURES) and allowed(c)] + TIME_FEATURES


def model_rows(wide: DataFrame, target: str) -> DataFrame:
    """Complete rows of target and features, with their number; none at all below 50 rows."""
    features = feature_columns(wide.columns)
    rows = wide.select("time_key", "sensor_id", *features, F.col(f"`{target}`").alias("label")).dropna()
    return attach_scalar(rows, rows.agg(F.count(F.lit(1)).alias("n_rows"))).filter(F.col("n_rows") >= MIN_MODEL_ROWS)


def number_rows(rows: DataFrame) -> DataFrame:
    """Position 0, 1, ... by (time, sensor), without gathering the rows.

    Rows are counted per time, the counts (one per calendar step) give each time its offset, and
    rows are ranked inside their time only.
    """
    per_time = rows.groupBy("time_key").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("time_key").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_time.select("time_key", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("time_key").orderBy("sensor_id")
    return rows.withColumn("_r", F.row_number().over(inside)).join(offsets, "time_key").withColumn("position", F.col("_offset") + F.col("_r") - 1).drop("_offset", "_r")


def chronological_split(rows: DataFrame, test_frac: float = 0.2) -> DataFrame:
    """Adds ``position`` and ``split``: the first int((1 - test_frac) * n) rows by time train."""
    cut = F.floor(F.col("n_rows") * F.lit(1 - test_frac))
    return number_rows(rows).withColumn("split", F.when(F.col("position") < cut, "train").otherwise("test"))


def time_series_folds(split: DataFrame, k: int = 5) -> DataFrame:
    """Each training row once per fold it serves: (…, fold, role); folds expand over time."""
    train = split.filter("split = 'train'")
    n = attach_scalar(train, train.agg(F.count(F.lit(1)).alias("n_train")))
    size = F.floor(F.col("n_train") / (k + 1))
    first = F.col("n_train") - (k - F.col("fold")) * size
    role = F.when(F.col("position") < first, "train").when(F.col("position") < first + size, "validation")
    return n.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn("role", role).filter(F.col("role").isNotNull())


def assemble(rows: DataFrame, features) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="raw_features").transform(rows)


def standardize(train: DataFrame):
    """A scaler fitted on training rows only."""
    return StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True).fit(train)


def fit_random_forest(train, num_trees: int = 200, max_depth: int = 10, seed: int = 42):
    return RandomForestRegressor(
        featuresCol="features", labelCol="label", numTrees=num_trees, maxDepth=max_depth, featureSubsetStrategy="all", seed=seed
    ).fit(train)


def fit_gradient_boosting(train, num_trees: int = 100, max_depth: int = 4, rate: float = 0.1, seed: int = 42):
    return GBTRegressor(featuresCol="features", labelCol="label", maxIter=num_trees, maxDepth=max_depth, stepSize=rate, seed=seed).fit(train)


def fit_boosting_deep(train, num_trees: int = 200, max_depth: int = 6, rate: float = 0.1, seed: int = 42):
    return fit_gradient_boosting(train, num_trees, max_depth, rate, seed)


MODELS = {"random_forest": fit_random_forest, "gradient_boosting": fit_gradient_boosting, "boosting_deep": fit_boosting_deep}


def fit_and_predict(train: DataFrame, test: DataFrame, features, target: str, model: str, **params):
    """(predictions, importances) of one model; scaler and model see training rows only."""
    train, test = assemble(train, features), assemble(test, features)
    scaler = standardize(train)
    scaled = scaler.transform(train).cache()  # read once a tree level, only while fitting
    fitted = MODELS[model](scaled, **params)
    scaled.unpersist()
    predicted = fitted.transform(scaler.transform(test)).select(
        F.lit(target).alias("target"), F.lit(model).alias("model"), "time_key", "sensor_id", F.col("label").alias("actual"), F.col("prediction").alias("predicted")
    )
    return predicted, feature_importances(fitted, features, target, model, train.sparkSession)


def feature_importances(fitted, features, target, model, spark) -> DataFrame:
    """(target, model, feature, importance, type); linear models report unscaled coefficients."""
    if hasattr(fitted, "featureImportances"):
        values, kind = fitted.featureImportances.toArray(), "tree_importance"
    else:
        values, kind = fitted.coefficients.toArray(), "coefficient"
    rows = [(target, model, f, float(v), kind) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "target string, model string, feature string, importance double, type string")


def cross_validate(folds: DataFrame, features, target: str, model: str, k: int = 5, **params) -> DataFrame:
    """Predictions for the validation rows of each expanding fold, from a model fitted on the fold's training rows.

    ``folds`` is the table of ``time_series_folds``, written once and read by all folds.
    """
    parts = []
    for f in range(k):
        one = folds.filter(F.col("fold") == f)
        predicted, _ = fit_and_predict(one.filter("role = 'train'"), one.filter("role = 'validation'"), features, target, model, **params)
        parts.append(predicted.withColumn("fold", F.lit(f)))
    return reduce(DataFrame.unionByName, parts)


def side_by_side_linear(rows: DataFrame, feature: str, target: str, *groups: str) -> DataFrame:
    """Predictions of a least-squares line on one feature, a line per group, all groups in one aggregate.

    ``rows`` has ``role`` (train or another); lines are fitted on the training rows of their group
    and give predictions for the others. A group whose feature does not vary predicts its mean.
    """
    train = rows.filter("role = 'train'")
    slope = F.coalesce(F.when(F.var_pop(feature) > 0, F.regr_slope("label", F.col(feature))), F.lit(0.0))
    lines = train.groupBy(*groups).agg(slope.alias("_slope"), F.avg("label").alias("_y"), F.avg(feature).alias("_x"))
    rest = rows.filter("role <> 'train'")
    joined = rest.join(lines, list(groups)) if groups else attach_scalar(rest, lines)
    value = F.col("_y") + F.col("_slope") * (F.col(feature) - F.col("_x"))
    return joined.select(F.lit(target).alias("target"), F.lit(f"linear_{feature}").alias("model"), *groups, "time_key", "sensor_id", "position", F.col("label").alias("actual"), value.alias("predicted"))


def fold_metrics(predictions: DataFrame) -> DataFrame:
    """``regression_metrics`` of every fold in one job: (target, model, fold, split, r2, rmse, mae, n_samples)."""
    named = predictions.withColumn("target", F.struct("target", "fold"))
    rows = regression_metrics(named, "validation")
    return rows.select("target.target", "model", "target.fold", "split", "r2", "rmse", "mae", "n_samples")


def regression_metrics(predictions: DataFrame, split: str = "test") -> DataFrame:
    """r2, rmse and mae per (target, model), rounded to four digits."""
    y, e = F.col("actual"), F.col("actual") - F.col("predicted")
    return predictions.groupBy("target", "model").agg(
        F.lit(split).alias("split"),
        F.bround(1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y)), 4).alias("r2"),
        F.bround(F.sqrt(F.avg(e * e)), 4).alias("rmse"), F.bround(F.avg(F.abs(e)), 4).alias("mae"), F.count(y).alias("n_samples"),
    )


def cv_summary(folds: DataFrame) -> DataFrame:
    return folds.groupBy("target", "model").agg(
        F.avg("r2").alias("mean_r2"), F.stddev_samp("r2").alias("std_r2"), F.avg("rmse").alias("mean_rmse"), F.avg("mae").alias("mean_mae")
    )


def panel_availability(wide: DataFrame) -> DataFrame:
    """(column, non_null, null_rate) of a wide panel."""
    counts = wide.agg(F.count(F.lit(1)).alias("_all"), *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(wide.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_c{i}").alias("non_null")) for i, c in enumerate(wide.columns)])
    return counts.select("_all", F.explode(rows).alias("r")).select("r.*", F.bround(1 - ratio("r.non_null", "_all"), 4).alias("null_rate"))


def best_model(metrics: DataFrame) -> DataFrame:
    w = Window.partitionBy("target").orderBy(F.desc("r2"), "model")
    return metrics.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def top_features(importances: DataFrame, n: int = 10) -> DataFrame:
    """Features by mean absolute importance over models and targets."""
    return importances.groupBy("feature").agg(F.avg(F.abs("importance")).alias("mean_importance")).orderBy(F.desc("mean_importance"), "feature").limit(n)


def top_features_by_model(importances: DataFrame, n: int = 15) -> DataFrame:
    w = Window.partitionBy("target", "model").orderBy(F.desc(F.abs("importance")), "feature")
    return importances.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def run_models(df: DataFrame, targets=None, models=("random_forest", "gradient_boosting"), aggregate="daily", params=None, cv: int = 0):
    """Panel, test metrics, fold metrics, importances and predictions for all targets and models."""
    panel = checkpointed(build_panel(df, aggregate))
    features, params = feature_columns(panel.columns), params or {}
    names = {c.upper(): c for c in panel.columns}
    chosen = [r.target for r in resolve_targets(df, targets).collect()]  # the few target names
    predictions, importances, folds = [], [], []
    for target in [t for t in chosen if t in names]:
        split = checkpointed(chronological_split(model_rows(panel, names[target])))
        if split.isEmpty():
            continue
        for model in models:
            p, i = fit_and_predict(split.filter("split = 'train'"), split.filter("split = 'test'"), features, target, model, **params.get(model, {}))
            predictions.append(p)
            importances.append(i)
            if cv:
                folds.append(fold_metrics(cross_validate(time_series_folds(split, cv), features, target, model, cv, **params.get(model, {}))))
    union = lambda parts: reduce(DataFrame.unionByName, parts) if parts else None
    p = union(predictions)
    return {"panel": panel, "predictions": p, "metrics": None if p is None else regression_metrics(p), "importances": union(importances), "folds": union(folds)}
