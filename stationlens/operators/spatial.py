"""Stations, distances and the graphs built from them."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlens import schema as S
from stationlens.functions.columns import upper_name
from stationlens.functions.quantiles import attach_scalar, grouped_quantiles
from stationlens.scratch import partitions_for

PAIRS_PER_TASK = 500_000
COPIES_PER_TASK = 500_000


def sensor_mean_first_available(df: DataFrame, priority=S.POLLUTION_PRIORITY) -> DataFrame:
    """Mean per sensor of the first pollutant of ``priority`` that occurs at all."""
    rank = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(priority))):
        rank = F.when(upper_name() == name, i).otherwise(rank)
    means = df.withColumn("_rank", rank).filter(F.col("_rank").isNotNull()).groupBy("_rank", "sensor_id").agg(F.avg("value").alias("avg_pollution"))
    first = means.agg(F.min("_rank").alias("_first"))
    return attach_scalar(means, first).filter("_rank = _first").select("sensor_id", "avg_pollution")


def sensor_coordinates(df: DataFrame) -> DataFrame:
    """Mean position per sensor over complete rows."""
    return (
        df.dropna(subset=["sensor_id", "sensor_name", "utm_x", "utm_y"])
        .groupBy("sensor_id", "sensor_name").agg(F.avg("utm_x").alias("utm_x"), F.avg("utm_y").alias("utm_y"))
    )


def _distance(ax, ay, bx, by):
    dx, dy = F.col(ax) - F.col(bx), F.col(ay) - F.col(by)
    return F.sqrt(dx * dx + dy * dy)


def _side(coords, suffix):
    return coords.select(*[F.col(c).alias(f"{c}_{suffix}") for c in ("sensor_id", "sensor_name", "utm_x", "utm_y")])


def _pair_columns():
    return ["sensor_id_1", "sensor_name_1", "sensor_id_2", "sensor_name_2", _distance("utm_x_1", "utm_y_1", "utm_x_2", "utm_y_2").alias("distance_m")]


def pairwise_distances(coords: DataFrame, blocks: int = 16) -> DataFrame:
    """Distance of every pair of stations (the table is all pairs), nearest first.

    Stations fall into hashed blocks and each pair of blocks is one join key, so the pairs are
    spread evenly over tasks by an equi-join.
    """
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = _side(coords, 1).withColumn("_p", F.pmod(F.xxhash64("sensor_id_1"), F.lit(blocks)).cast("int")).withColumn("_q", others)
    right = _side(coords, 2).withColumn("_q", F.pmod(F.xxhash64("sensor_id_2"), F.lit(blocks)).cast("int")).withColumn("_p", others)
    pairs = left.join(right, ["_p", "_q"]).filter("sensor_id_1 < sensor_id_2")
    return pairs.select(*_pair_columns()).orderBy("distance_m", "sensor_id_1", "sensor_id_2")


def pairs_within(coords: DataFrame, radius: float, per_key: int = 100) -> DataFrame:
    """Pairs of stations no further apart than ``radius``, by an equi-join on grid cells.

    Cells are counted first. One with more than ``per_key`` stations is split over as many join
    keys as it needs, and only stations around it are copied to each of them; each two cells meet
    once. Both sides are dealt to a number of tasks that goes by the pairs to be compared: the
    copies outgrow any estimate made from the stations, so they are never broadcast.
    """
    cell = lambda c: F.floor(F.col(c) / radius)
    left = _side(coords, 1).withColumns({"_cx": cell("utm_x_1"), "_cy": cell("utm_y_1")})
    counts = left.groupBy("_cx", "_cy").agg(F.count(F.lit(1)).alias("_n"))
    crowded = counts.select("_cx", "_cy", F.ceil(F.col("_n") / per_key).cast("int").alias("_parts")).filter("_parts > 1")
    crowded = F.broadcast(crowded)  # fewer rows than stations / per_key
    parts = F.coalesce("_parts", F.lit(1))
    steps = [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]  # a cell and half of those around it: the others meet it from their side
    around = lambda df: df.withColumn("_d", F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in steps])))
    met = around(counts).select((F.col("_cx") - F.col("_d.x")).alias("_cx"), (F.col("_cy") - F.col("_d.y")).alias("_cy"), F.col("_n").alias("_m"))
    compared = counts.join(met.hint("shuffle_hash"), ["_cx", "_cy"]).agg(F.sum(F.col("_n") * F.col("_m"))).first()[0] or 0
    tasks = partitions_for(compared, PAIRS_PER_TASK, most=2_000)
    split = left.join(crowded, ["_cx", "_cy"], "left").withColumn("_s", F.pmod(F.xxhash64("sensor_id_1"), parts).cast("int")).drop("_parts")
    right = (
        around(_side(coords, 2).repartition(partitions_for(compared, COPIES_PER_TASK * per_key, most=200))).withColumns({"_cx": cell("utm_x_2") - F.col("_d.x"), "_cy": cell("utm_y_2") - F.col("_d.y")})
        .withColumn("_same", (F.col("_d.x") == 0) & (F.col("_d.y") == 0)).drop("_d")
        .join(crowded, ["_cx", "_cy"], "left").withColumn("_s", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    )
    key = ["_cx", "_cy", "_s"]
    pairs = split.repartition(tasks, *key).hint("shuffle_hash").join(right.repartition(tasks, *key), key)
    forward = F.col("sensor_id_1") < F.col("sensor_id_2")
    pairs = pairs.filter((forward | ~F.col("_same")) & (F.col("sensor_id_1") != F.col("sensor_id_2")))
    near = pairs.withColumn("distance_m", _distance("utm_x_1", "utm_y_1", "utm_x_2", "utm_y_2")).filter(F.col("distance_m") <= radius)
    ordered = [F.when(forward, F.col(f"{c}_{i}")).otherwise(F.col(f"{c}_{3 - i}")).alias(f"{c}_{i}") for i in (1, 2) for c in ("sensor_id", "sensor_name")]
    return near.select(*ordered, "distance_m")


def distance_quantiles(distances: DataFrame, probs=(0.10, 0.25, 0.50, 0.75), **opts) -> DataFrame:
    """(quantile, distance_m, threshold_m): exact quantiles and their half-even rounding."""
    q = grouped_quantiles(distances, [], "distance_m", {f"q{i}": p for i, p in enumerate(probs)}, **opts)
    rows = F.array(*[F.struct(F.lit(p).alias("quantile"), F.col(f"q{i}").alias("distance_m")) for i, p in enumerate(probs)])
    return q.select(F.explode(rows).alias("r")).select("r.*", F.bround("r.distance_m", 0).cast("int").alias("threshold_m"))


def edge_weights(edges: DataFrame) -> DataFrame:
    return edges.withColumn("similarity", 1 / (1 + F.col("distance")))


def threshold_graph(coords: DataFrame, thresholds) -> DataFrame:
    """Edges of one graph per threshold: (graph_name, method, threshold_m, k, src, dst, distance, similarity)."""
    levels = sorted({int(t) for t in thresholds})
    near = pairs_within(coords, float(max(levels)))
    # Names are written out per level: building them row by row cost more than the distances.
    named = F.array(*[F.struct(F.lit(f"threshold_{t}m").alias("graph_name"), F.lit(t).alias("threshold_m")) for t in levels])
    per = near.withColumn("_g", F.explode(named)).filter(F.col("distance_m") <= F.col("_g.threshold_m"))
    return edge_weights(
        per.select(
            "_g.graph_name", F.lit("threshold").alias("method"), "_g.threshold_m",
            F.lit(None).cast("int").alias("k"), F.col("sensor_id_1").alias("src"), F.col("sensor_id_2").alias("dst"), F.col("distance_m").alias("distance"),
        )
    )


def nearest_neighbors(coords: DataFrame, k: int, levels: int = 16) -> DataFrame:
    """The k nearest stations of each station, exactly: (sensor_id, neighbor_id, distance, rank).

    The plane is gridded at ``levels`` cell sizes, each half the one before. For each station the
    finest size is found at which the nine cells around it hold more than k stations; the k
    nearest then lie within nine cells four times as wide, and only those are compared. Of the
    stations at one spot the k + 1 lowest ids are enough, because equal distances go by id.
    """
    pts = coords.select("sensor_id", "utm_x", "utm_y")
    frame = pts.agg(
        F.min("utm_x").alias("_x0"), F.min("utm_y").alias("_y0"),
        F.greatest(F.max("utm_x") - F.min("utm_x"), F.max("utm_y") - F.min("utm_y"), F.lit(1e-6)).alias("_span"),
    )
    placed = attach_scalar(pts, frame)
    spot = Window.partitionBy("utm_x", "utm_y").orderBy("sensor_id")
    kept = placed.withColumn("_r", F.row_number().over(spot)).filter(F.col("_r") <= k + 1).drop("_r")
    side = F.col("_span") / F.pow(F.lit(2.0), F.col("_level"))
    cells = {"_cx": F.floor((F.col("utm_x") - F.col("_x0")) / side), "_cy": F.floor((F.col("utm_y") - F.col("_y0")) / side)}
    all_levels = F.explode(F.sequence(F.lit(0), F.lit(levels)))
    around = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    gridded = kept.withColumn("_level", all_levels).withColumns(cells)
    crowd = gridded.groupBy("_level", "_cx", "_cy").agg(F.count(F.lit(1)).alias("_n"))

    def with_neighbors(df):
        near = df.withColumns(cells).withColumn("_dx", around).withColumn("_dy", around)
        return near.withColumns({"_cx": F.col("_cx") + F.col("_dx"), "_cy": F.col("_cy") + F.col("_dy")})

    seen = (
        with_neighbors(placed.withColumn("_level", all_levels)).join(crowd.hint("shuffle_hash"), ["_level", "_cx", "_cy"])
        .groupBy("sensor_id", "_level").agg(F.sum("_n").alias("_n"))
    )
    level = seen.groupBy("sensor_id").agg(F.greatest(F.coalesce(F.max(F.when(F.col("_n") > k, F.col("_level"))) - 2, F.lit(0)), F.lit(0)).alias("_level"))
    candidates = gridded.select("_level", "_cx", "_cy", F.col("sensor_id").alias("neighbor_id"), F.col("utm_x").alias("_nx"), F.col("utm_y").alias("_ny"))
    found = (
        with_neighbors(placed.join(level, "sensor_id")).join(candidates.hint("merge"), ["_level", "_cx", "_cy"])
        .filter("sensor_id <> neighbor_id").withColumn("distance", _distance("utm_x", "utm_y", "_nx", "_ny"))
    )
    order = Window.partitionBy("sensor_id").orderBy("distance", "neighbor_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("sensor_id", "neighbor_id", "distance", "rank")


def knn_graph(coords: DataFrame, ks=(2, 3, 4, 5)) -> DataFrame:
    """Undirected union of each station's k nearest neighbours, one graph per k."""
    near = nearest_neighbors(coords, max(ks)).withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).filter(F.col("rank") <= F.col("k"))
    edges = near.select("k", F.least("sensor_id", "neighbor_id").alias("src"), F.greatest("sensor_id", "neighbor_id").alias("dst"), "distance")
    one = edges.groupBy("k", "src", "dst").agg(F.first("distance").alias("distance"))
    return edge_weights(
        one.select(
            F.format_string("knn_k%d", "k").alias("graph_name"), F.lit("knn").alias("method"), F.lit(None).cast("int").alias("threshold_m"),
            "k", "src", "dst", "distance",
        )
    )


def underfull_sensors(coords: DataFrame, ks) -> DataFrame:
    """Sensors with fewer than k other sensors."""
    total = coords.agg((F.count(F.lit(1)) - 1).alias("available_neighbors"))
    return (
        attach_scalar(coords.select("sensor_id"), total).withColumn("requested_k", F.explode(F.array(*[F.lit(k) for k in ks])))
        .filter(F.col("available_neighbors") < F.col("requested_k"))
    )


def node_table(coords: DataFrame, pollution: DataFrame) -> DataFrame:
    return coords.join(pollution, "sensor_id", "left").select("sensor_id", "sensor_name", "utm_x", "utm_y", "avg_pollution")


def graph_nodes(coords: DataFrame, graphs) -> DataFrame:
    """Every station is a node of every graph; ``graphs`` is a list of (name, method, threshold_m, k)."""
    names = F.array(*[
        F.struct(F.lit(g).alias("graph_name"), F.lit(m).alias("method"), F.lit(t).cast("int").alias("threshold_m"), F.lit(k).cast("int").alias("k"))
        for g, m, t, k in graphs
    ])
    return coords.withColumn("_g", F.explode(names)).select("_g.*", F.col("sensor_id").alias("id"))
