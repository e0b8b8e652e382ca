"""Networks of sensors with similar monthly behaviour."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlens.functions.columns import ratio
from stationlens.functions.quantiles import attach_scalar


def monthly_sensor_series(df: DataFrame, magnitudes=None) -> DataFrame:
    """Mean per (variable, month, sensor), labelled by month start; all variables in one job."""
    if magnitudes is not None:
        df = df.filter(F.upper("magnitude_name").isin([m.upper() for m in magnitudes]))
    return df.groupBy("magnitude_name", F.trunc("entry_date", "month").alias("month"), "sensor_id").agg(
        F.avg("value").alias("mean_value"), F.min("sensor_name").alias("sensor_name")
    )


def sensor_coverage(monthly: DataFrame, min_months: int = 24) -> DataFrame:
    return monthly.groupBy("magnitude_name", "sensor_id").agg(
        F.count("mean_value").alias("n_months_available"),
        (F.count("mean_value") >= min_months).alias("kept_for_correlation"),
        F.min("sensor_name").alias("sensor_name"),
    )


def _covered(monthly, min_months):
    kept = sensor_coverage(monthly, min_months).filter("kept_for_correlation").select("magnitude_name", "sensor_id")
    return monthly.join(kept, ["magnitude_name", "sensor_id"], "left_semi")


def sensor_month_matrix(monthly: DataFrame, sensor_ids, min_months: int = 24) -> DataFrame:
    """months x sensors, for export; only covered sensors have values."""
    wide = _covered(monthly, min_months).groupBy("magnitude_name", "month").pivot("sensor_id", list(sensor_ids)).agg(F.first("mean_value"))
    return wide.select("magnitude_name", "month", *[F.col(f"`{i}`").alias(f"sensor_{i}") for i in sensor_ids]).orderBy("magnitude_name", "month")


_PAIR_SCHEMA = "magnitude_name string, sensor_id_1 int, sensor_id_2 int, n_months bigint, correlation double"


def _correlate(left, right):
    """Pearson r and overlap of each row of ``left`` with each row of ``right``, NaN = missing."""
    ml, mr = ~np.isnan(left), ~np.isnan(right)
    l0 = np.where(ml, left - np.nanmean(left, axis=1, keepdims=True), 0.0)
    r0 = np.where(mr, right - np.nanmean(right, axis=1, keepdims=True), 0.0)
    ml, mr = ml.astype(float), mr.astype(float)
    n = ml @ mr.T
    sl, sr = l0 @ mr.T, ml @ r0.T
    ql, qr = (l0 * l0) @ mr.T, ml @ (r0 * r0).T
    with np.errstate(divide="ignore", invalid="ignore"):
        vl, vr = ql - sl * sl / n, qr - sr * sr / n
        r = (l0 @ r0.T - sl * sr / n) / np.sqrt(vl * vr)
    constant = (vl <= 1e-12 * np.maximum(ql, 1e-300)) | (vr <= 1e-12 * np.maximum(qr, 1e-300))
    return np.where(constant | ~np.isfinite(r), np.nan, np.clip(r, -1.0, 1.0)), n


def _block_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    """All sensor pairs between two blocks of sensors of one variable."""
    p, q = int(pdf["_p"].iloc[0]), int(pdf["_q"].iloc[0])
    wide = pdf.pivot_table(index="sensor_id", columns="month", values="mean_value", aggfunc="first")
    block = pdf.drop_duplicates("sensor_id").set_index("sensor_id")["_block"].reindex(wide.index)
    a, b = wide[(block == p).values], wide[(block == q).values]
    if a.empty or b.empty:
        return pd.DataFrame(columns=["magnitude_name", "sensor_id_1", "sensor_id_2", "n_months", "correlation"])
    r, n = _correlate(a.to_numpy(float), b.to_numpy(float))
    i, j = np.meshgrid(a.index.to_numpy(), b.index.to_numpy(), indexing="ij")
    keep = (i < j) if p == q else np.ones_like(i, dtype=bool)
    out = pd.DataFrame({
        "magnitude_name": pdf["magnitude_name"].iloc[0],
        "sensor_id_1": np.minimum(i, j)[keep], "sensor_id_2": np.maximum(i, j)[keep],
        "n_months": n[keep].astype("int64"), "correlation": r[keep],
    })
    out["correlation"] = out["correlation"].astype(object).where(out["correlation"].notna(), None)
    return out


def sensor_correlations(monthly: DataFrame, min_months: int = 24, block_size: int = 256) -> DataFrame:
    """Correlation of every pair of covered sensors over their common months; null below ``min_months``.

    Sensors fall into blocks of about ``block_size``. One task sees two blocks of month vectors
    and writes their pairs, so neither the input of a task nor the rows before the result grow
    with the number of sensors squared times months.
    """
    rows = _covered(monthly.filter(F.col("mean_value").isNotNull()), min_months).select("magnitude_name", "month", F.col("sensor_id").cast("int").alias("sensor_id"), "mean_value")
    count = rows.agg(F.ceil(F.countDistinct("sensor_id") / block_size).cast("int").alias("_blocks"))
    blocked = attach_scalar(rows, count).withColumn("_block", F.pmod(F.xxhash64("sensor_id"), F.greatest("_blocks", F.lit(1))).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.greatest("_blocks", F.lit(1)) - 1))
    paired = blocked.withColumn("_o", other).withColumns({"_p": F.least("_block", "_o"), "_q": F.greatest("_block", "_o")}).drop("_o", "_blocks")
    pairs = paired.groupBy("magnitude_name", "_p", "_q").applyInPandas(_block_pairs, _PAIR_SCHEMA)
    return pairs.withColumn("correlation", F.when(F.col("n_months") >= min_months, F.col("correlation")))


def correlation_matrix(pairs: DataFrame) -> DataFrame:
    """Symmetric long form with the diagonal, for export."""
    ab = pairs.select("magnitude_name", "sensor_id_1", "sensor_id_2", "correlation")
    ba = ab.select("magnitude_name", F.col("sensor_id_2").alias("sensor_id_1"), F.col("sensor_id_1").alias("sensor_id_2"), "correlation")
    both = ab.unionByName(ba)
    own = both.select("magnitude_name", "sensor_id_1", F.col("sensor_id_1").alias("sensor_id_2"), F.lit(1.0).alias("correlation")).distinct()
    return both.unionByName(own)


def correlation_pairs(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """Known correlations, signed and absolute, with "name (id)" labels, highest first."""
    def label(i):
        return names.select("magnitude_name", F.col("sensor_id").alias(f"sensor_id_{i}"), F.format_string("%s (%d)", "sensor_name", "sensor_id").alias(f"sensor_name_{i}"))

    return (
        pairs.filter(F.col("correlation").isNotNull())
        .join(label(1), ["magnitude_name", "sensor_id_1"]).join(label(2), ["magnitude_name", "sensor_id_2"])
        .select("magnitude_name", "sensor_id_1", "sensor_name_1", "sensor_id_2", "sensor_name_2", "correlation", F.abs("correlation").alias("absolute_correlation"))
        .orderBy("magnitude_name", F.desc("correlation"), "sensor_id_1", "sensor_id_2")
    )


def correlation_threshold_graph(pairs: DataFrame, thresholds) -> DataFrame:
    """Edges where the signed correlation reaches each threshold: weight r, distance 1 - r (not below 0)."""
    levels = F.explode(F.array(*[F.lit(float(t)) for t in thresholds]))
    r = F.col("correlation")
    return (
        pairs.filter(r.isNotNull()).withColumn("threshold", levels).filter(r >= F.col("threshold"))
        .select(
            F.concat("magnitude_name", F.format_string("_corr_%.2f", "threshold")).alias("graph_name"), F.col("magnitude_name").alias("magnitude"), "threshold",
            F.col("sensor_id_1").alias("src"), F.col("sensor_id_2").alias("dst"), r.alias("weight"), F.greatest(1 - r, F.lit(0.0)).alias("distance"),
        )
    )


def correlation_nodes(coverage: DataFrame, thresholds) -> DataFrame:
    """Every sensor seen is a node of each of its variable's graphs, also without enough months."""
    levels = F.explode(F.array(*[F.lit(float(t)) for t in thresholds]))
    return coverage.withColumn("threshold", levels).select(
        F.concat("magnitude_name", F.format_string("_corr_%.2f", "threshold")).alias("graph_name"),
        F.col("magnitude_name").alias("magnitude"), "threshold", F.col("sensor_id").alias("id"), "sensor_name",
    )


def select_correlation_graph(summary: DataFrame) -> DataFrame:
    """Per variable the connected graph with the highest threshold, else the largest component."""
    connected = F.col("is_connected").cast("int")
    order = Window.partitionBy("magnitude").orderBy(
        F.desc(connected), F.desc(F.when(F.col("is_connected"), F.col("threshold"))), F.desc("largest_component_size"), "threshold"
    )
    return summary.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


_MEASURES = ["n_nodes", "n_edges", "density", "average_degree", "n_connected_components", "largest_component_size"]


def spatial_vs_correlation(spatial: DataFrame, correlation: DataFrame) -> DataFrame:
    """The selected spatial graph beside each variable's selected correlation graph."""
    left = spatial.select(F.lit("spatial_distance").alias("network_type"), F.col("graph_name").alias("selected_graph"), *_MEASURES)
    right = correlation.select("magnitude", F.lit("correlation_behaviour").alias("network_type"), F.col("graph_name").alias("selected_graph"), *_MEASURES)
    # One spatial row per variable; no rows at all without a spatial result.
    variables = correlation.select("magnitude").distinct()
    joined = left.withColumn("_one", F.lit(1)).join(variables.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return joined.unionByName(right.join(joined.select("magnitude").distinct(), "magnitude", "left_semi"))


def cross_pollutant_summary(summary: DataFrame) -> DataFrame:
    """The lowest-threshold graph of each variable."""
    order = Window.partitionBy("magnitude").orderBy("threshold")
    return summary.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def nearest_threshold(summary: DataFrame, target: float, priority=("NO2", "NOX", "NO")) -> DataFrame:
    """The graph with the threshold nearest to ``target`` of the first available variable."""
    rank = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(priority))):
        rank = F.when(F.upper("magnitude") == name, i).otherwise(rank)
    gap = F.round(F.abs(F.col("threshold") - target), 12)
    return summary.withColumn("_rank", rank).filter(F.col("_rank").isNotNull()).orderBy("_rank", gap, "threshold").limit(1).drop("_rank")


def edge_overlay(spatial_edges: DataFrame, correlation_edges: DataFrame) -> DataFrame:
    """(src, dst, edge_class): shared, spatial_only or correlation_only."""
    undirected = lambda e, tag: e.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct().withColumn(tag, F.lit(True))
    both = undirected(spatial_edges, "_s").join(undirected(correlation_edges, "_c"), ["src", "dst"], "full")
    kind = F.when(F.col("_s") & F.col("_c"), "shared").when(F.col("_s"), "spatial_only").otherwise("correlation_only")
    return both.select("src", "dst", kind.alias("edge_class"))


def overlay_summary(overlay: DataFrame, spatial_graph: str, correlation_graph: str) -> DataFrame:
    n = lambda *kinds: F.count_if(F.col("edge_class").isin(list(kinds)))
    return overlay.agg(
        n("shared", "spatial_only").alias("n_spatial_edges"), n("shared", "correlation_only").alias("n_correlation_edges"),
        n("shared").alias("n_shared_edges"), n("spatial_only").alias("n_spatial_only"), n("correlation_only").alias("n_correlation_only"),
        ratio(n("shared"), F.greatest(F.count(F.lit(1)), F.lit(1))).alias("jaccard_edge_similarity"),
    ).select(F.lit(spatial_graph).alias("spatial_graph"), F.lit(correlation_graph).alias("correlation_graph"), "*")


def overlay_nodes(spatial_nodes: DataFrame, correlation_nodes: DataFrame, coords: DataFrame) -> DataFrame:
    """Nodes of either graph that have coordinates."""
    ids = spatial_nodes.select("id").union(correlation_nodes.select("id")).distinct()
    return ids.join(coords.withColumnRenamed("sensor_id", "id"), "id").select("id", "sensor_name", "utm_x", "utm_y")


def community_jaccard(spatial: DataFrame, correlation: DataFrame) -> DataFrame:
    """Best overlap of each spatial community with a correlation community, averaged, per variable.

    ``spatial`` has (id, community_id); ``correlation`` (magnitude, graph_name, id, community_id).
    """
    s = spatial.select("id", F.col("community_id").alias("_s"))
    c = correlation.select("magnitude", "graph_name", "id", F.col("community_id").alias("_c"))
    size_s = s.groupBy("_s").agg(F.count(F.lit(1)).alias("_ns"))
    graph = ["magnitude", "graph_name"]
    size_c = c.groupBy(*graph, "_c").agg(F.count(F.lit(1)).alias("_nc"))
    shared = s.join(c, "id").groupBy(*graph, "_s", "_c").agg(F.count(F.lit(1)).alias("_n"))
    score = F.col("_n") / (F.col("_ns") + F.col("_nc") - F.col("_n"))
    best = shared.join(size_s, "_s").join(size_c, [*graph, "_c"]).groupBy(*graph, "_s").agg(F.max(score).alias("_j"))
    # Communities without any common sensor score 0, so the sum is divided by all of them.
    totals = size_s.agg(F.count(F.lit(1)).alias("n_spatial_communities"))
    counts = attach_scalar(size_c.groupBy(*graph).agg(F.count(F.lit(1)).alias("n_corr_communities")), totals)
    mean = F.coalesce(F.col("_sum"), F.lit(0.0)) / F.col("n_spatial_communities")
    return (
        counts.join(best.groupBy(*graph).agg(F.sum("_j").alias("_sum")), graph, "left").withColumn("_m", mean)
        .select(
            F.col("magnitude").alias("pollutant"), F.col("graph_name").alias("threshold"), "n_spatial_communities", "n_corr_communities",
            F.bround("_m", 4).alias("mean_best_match_jaccard"),
            F.when(F.col("_m") >= 0.5, "high agreement").when(F.col("_m") >= 0.3, "moderate agreement").otherwise("low agreement").alias("interpretation"),
        )
    )
