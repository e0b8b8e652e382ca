"""Tables for reports and maps, made from the results of the other stages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlens.functions.columns import mean_flag, ratio, upper_name, utm30_to_lonlat
from stationlens.functions.quantiles import attach_scalar
from stationlens.operators.corrnet import nearest_threshold
from stationlens.operators.spatial import sensor_coordinates


def top_interpolated(interpolation: DataFrame, n: int = 10) -> DataFrame:
    return interpolation.orderBy(F.desc_nulls_last("interpolation_rate"), "magnitude_name").limit(n)


def top_pollutant_profiles(table: DataFrame, key: str, n: int) -> DataFrame:
    """Mean over sensors per ``key`` for the n variables with most rows in ``table``."""
    names = table.groupBy("magnitude_name").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "magnitude_name").limit(n)
    kept = table.join(F.broadcast(names.select("magnitude_name")), "magnitude_name", "left_semi")  # n names
    return kept.groupBy("magnitude_name", key).agg(F.avg("mean_value").alias("mean_value"))


def sensor_map(df: DataFrame) -> DataFrame:
    """Sensor positions with their mean NO2."""
    no2 = df.filter(upper_name() == "NO2").groupBy("sensor_id").agg(F.avg("value").alias("mean_no2"))
    return sensor_coordinates(df).join(no2, "sensor_id", "left")


def network_comparison(spatial: DataFrame, correlation: DataFrame, target: float = 0.70) -> DataFrame:
    """The selected spatial graph beside the correlation graph nearest to r = 0.70."""
    cols = ["n_nodes", "n_edges", "density", "average_degree"]
    left = spatial.limit(1).select(F.lit("spatial").alias("network"), "graph_name", *cols)
    return left.unionByName(nearest_threshold(correlation, target).select(F.lit("correlation").alias("network"), "graph_name", *cols))


def imputation_comparison(distribution: DataFrame) -> DataFrame:
    return distribution.select("series", "mean")


def metric_matrix(metrics: DataFrame, models, measure: str = "r2") -> DataFrame:
    """target x model."""
    return metrics.groupBy("target").pivot("model", list(models)).agg(F.first(measure))


def top_mean_importance(importances: DataFrame, n: int = 12) -> DataFrame:
    """Mean importance per feature over tree models, or over all models where there are none."""
    has_trees = importances.agg(F.coalesce(F.max(F.col("type") == "tree_importance"), F.lit(False)).alias("_trees"))
    kept = attach_scalar(importances, has_trees).filter(~F.col("_trees") | (F.col("type") == "tree_importance"))
    return kept.groupBy("feature").agg(F.avg("importance").alias("mean_importance")).orderBy(F.desc("mean_importance"), "feature").limit(n)


def utm_to_lonlat(coords: DataFrame) -> DataFrame:
    lon, lat = utm30_to_lonlat("utm_x", "utm_y")
    return coords.withColumns({"lon": lon, "lat": lat})


def edge_geometry(edges: DataFrame, coords: DataFrame) -> DataFrame:
    """End points of each edge in degrees; edges without both positions are left out."""
    at = utm_to_lonlat(coords)
    a = at.select(F.col("sensor_id").alias("src"), F.col("lon").alias("source_lon"), F.col("lat").alias("source_lat"))
    b = at.select(F.col("sensor_id").alias("dst"), F.col("lon").alias("target_lon"), F.col("lat").alias("target_lat"))
    return edges.join(a, "src").join(b, "dst").select("graph_name", "src", "dst", "source_lon", "source_lat", "target_lon", "target_lat")


def node_radius(coords: DataFrame, metrics: DataFrame, graph_name: str) -> DataFrame:
    """Map radius 300 + 1000 * betweenness within 300..1200; 400 where the graph has no metrics."""
    one = metrics.filter(F.col("graph_name") == graph_name).select(F.col("id").alias("sensor_id"), "betweenness_centrality")
    known = one.agg((F.count(F.lit(1)) > 0).alias("_known"))
    size = F.least(F.lit(1200.0), F.greatest(F.lit(300.0), 300 + 1000 * F.coalesce("betweenness_centrality", F.lit(0.0))))
    joined = attach_scalar(coords.join(one, "sensor_id", "left"), known)
    return joined.select("sensor_id", "sensor_name", F.when(F.col("_known"), size).otherwise(400.0).alias("radius"))


def graph_stats_lookup(summary: DataFrame, graph_name: str) -> DataFrame:
    return summary.filter(F.col("graph_name") == graph_name)


def table_view(table: DataFrame, order_by: str, n: int, digits: int = 3) -> DataFrame:
    """The first n rows by one column, highest first, with rounded numbers."""
    tie = [c for c in table.columns if c != order_by]
    top = table.orderBy(F.desc_nulls_last(order_by), *tie).limit(n)
    return top.select(*[F.bround(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in table.dtypes])


def composition(df: DataFrame) -> DataFrame:
    """Rows, share of all rows and missing rate per variable type."""
    per = df.groupBy("variable_type").agg(F.count(F.lit(1)).alias("n_rows"), mean_flag("is_interpolated").alias("missing_rate"))
    return attach_scalar(per, per.agg(F.sum("n_rows").alias("_all"))).select("variable_type", "n_rows", ratio("n_rows", "_all").alias("share"), "missing_rate")
