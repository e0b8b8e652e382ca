"""Registered queries: spatial graphs, correlation graphs and graph analytics."""

from pyspark.sql import functions as F

from stationlens.operators import community as C
from stationlens.operators import corrnet as H
from stationlens.operators import distances as D
from stationlens.operators import graph as N
from stationlens.operators import paths as P
from stationlens.operators import spatial as G
from stationlens.operators.clean import clean_readings
from stationlens.plans import adapters as A
from stationlens.plans.base import check_sql, present
from stationlens.plans.stage_load import daily
from stationlens.plans.store import stored
from stationlens.session import scratch_path
from stationlens.sources.graphs import read_graph, write_graph

KS = (2, 3, 4, 5)
THRESHOLDS = (0.05, 0.10, 0.15, 0.90)
ATTRIBUTES = ["method", "threshold_m", "k"]


def thresholds(s, d):
    """The distance thresholds: at most four numbers."""
    q = stored(s, d, "distance_quantiles", lambda s, d: D.pair_distance_quantiles(A.stations(s, d)))
    return sorted({r.threshold_m for r in q.select("threshold_m").collect()})


def spatial_edges(s, d):
    def build(s, d):
        coords = A.stations(s, d)
        return G.threshold_graph(coords, thresholds(s, d)).unionByName(G.knn_graph(coords, KS))
    return stored(s, d, "spatial_edges", build)


def spatial_nodes(s, d):
    graphs = [(f"threshold_{t}m", "threshold", t, None) for t in thresholds(s, d)] + [(f"knn_k{k}", "knn", None, k) for k in KS]
    coords = G.node_table(A.stations(s, d), G.sensor_mean_first_available(daily(s, d)))
    attrs = coords.select("sensor_id", "sensor_name", "utm_x", "utm_y", "avg_pollution")
    return G.graph_nodes(coords, graphs).join(attrs.withColumnRenamed("sensor_id", "id"), "id")


def monthly(s, d, every=False):
    """Monthly means of the folded sensors, or with ``every`` of each station."""
    if every:
        return stored(s, d, "station_months", lambda s, d: H.monthly_sensor_series(clean_readings(A.readings_daily(s, d, sensors=0))))
    return stored(s, d, "sensor_months", lambda s, d: H.monthly_sensor_series(daily(s, d)))


def pairs(s, d, every=False):
    return stored(s, d, "station_pairs" if every else "sensor_pairs", lambda s, d: H.sensor_correlations(monthly(s, d, every)))


def corr_edges(s, d, every=False):
    return stored(s, d, "station_edges" if every else "correlation_edges", lambda s, d: H.correlation_threshold_graph(pairs(s, d, every), THRESHOLDS))


def corr_nodes(s, d, every=False):
    return H.correlation_nodes(H.sensor_coverage(monthly(s, d, every)), THRESHOLDS)


def _kind(kind):
    """Nodes and edges: "spatial", "correlation" of the folded sensors, or correlation of the "stations" that the spatial graphs have."""
    if kind == "spatial":
        return spatial_nodes, spatial_edges
    every = kind == "stations"
    return (lambda s, d: corr_nodes(s, d, every)), (lambda s, d: corr_edges(s, d, every))


def components(s, d, kind="spatial"):
    nodes, edges = _kind(kind)
    return stored(s, d, f"{kind}_components", lambda s, d: N.connected_components(nodes(s, d), edges(s, d)))


def paths(s, d, kind="spatial"):
    nodes, edges = _kind(kind)
    return stored(s, d, f"{kind}_paths", lambda s, d: N.shortest_paths(nodes(s, d), edges(s, d)))


def summary(s, d, kind="spatial"):
    nodes, edges = _kind(kind)
    attrs = ATTRIBUTES if kind == "spatial" else ["magnitude", "threshold"]
    return stored(s, d, f"{kind}_summary", lambda s, d: N.graph_summary(
        nodes(s, d), edges(s, d), components(s, d, kind), paths(s, d, kind), attrs, None if kind == "spatial" else "weight"))


def between(s, d, kind="spatial"):
    nodes, edges = _kind(kind)
    return stored(s, d, f"{kind}_betweenness", lambda s, d: N.betweenness(nodes(s, d), edges(s, d), paths(s, d, kind)))


def eigen(s, d, kind="correlation"):
    nodes, edges = _kind(kind)
    weight = "similarity" if kind == "spatial" else "weight"
    return stored(s, d, f"{kind}_eigenvector", lambda s, d: N.eigenvector_centrality(nodes(s, d), edges(s, d), weight))


def metrics(s, d, kind="spatial"):
    nodes, edges = _kind(kind)
    rest = ("similarity",) if kind == "spatial" else ("weight", "zero", True)
    return stored(s, d, f"{kind}_metrics", lambda s, d: N.node_metrics(
        nodes(s, d), edges(s, d), paths(s, d, kind), *rest, between=between(s, d, kind), eigen=eigen(s, d, kind)))


def groups(s, d, kind="spatial"):
    nodes, edges = _kind(kind)
    return stored(s, d, f"{kind}_communities", lambda s, d: N.communities(nodes(s, d), edges(s, d), "similarity" if kind == "spatial" else "weight"))


def profile(s, d):
    return stored(s, d, "spatial_profile", lambda s, d: P.distance_profile(spatial_nodes(s, d), spatial_edges(s, d), bands=2.0))


def selected(s, d):
    return N.select_graph(summary(s, d))


def _corr_groups(s, d):
    """Communities of each variable's lowest-threshold graph over all stations, those that the spatial communities have."""
    lowest = H.cross_pollutant_summary(summary(s, d, "stations")).select("graph_name", "magnitude")
    return groups(s, d, "stations").join(lowest, "graph_name")


def _overlay_parts(s, d):
    """Edges of the 2-neighbour graph and of the first pollutant's graph nearest to r = 0.10."""
    corr = H.nearest_threshold(summary(s, d, "correlation"), 0.10).select("graph_name")
    return spatial_edges(s, d).filter("graph_name = 'knn_k2'"), corr_edges(s, d).join(F.broadcast(corr), "graph_name", "left_semi")


def _graph_store(s, d):
    path = scratch_path(s, "graphs")
    nodes, edges = spatial_nodes(s, d), spatial_edges(s, d)
    write_graph(path, nodes.select("graph_name", *ATTRIBUTES).distinct(), nodes.select("graph_name", "id", "sensor_name"), edges)
    graphs, nodes, edges = read_graph(s, path)
    n = nodes.groupBy("graph_name").agg(F.count("id").alias("n_nodes"))
    m = edges.groupBy("graph_name").agg(F.count("src").alias("n_edges"), F.sum("distance").alias("total_distance"))
    return graphs.join(n, "graph_name").join(m, "graph_name", "left")


def halves(df):
    """A fixed two-community split by id, to check modularity on."""
    return df.select("graph_name", "id", (F.col("id") % 2).alias("community"))


QUERIES = {
    "write_graph_read_graph": _graph_store,
    "sensor_mean_first_available": lambda s, d: G.sensor_mean_first_available(daily(s, d)),
    "sensor_coordinates": lambda s, d: G.sensor_coordinates(daily(s, d)),
    "pairwise_distances": lambda s, d: G.pairwise_distances(A.stations(s, d)),
    "distance_quantiles": lambda s, d: D.pair_distance_quantiles(A.stations(s, d)),
    "threshold_graph": lambda s, d: G.threshold_graph(A.stations(s, d), thresholds(s, d)),
    "knn_graph": lambda s, d: G.knn_graph(A.stations(s, d), KS),
    "underfull_sensors": lambda s, d: G.underfull_sensors(A.stations(s, d), (3, 5000)),
    "edge_weights": lambda s, d: G.edge_weights(G.pairwise_distances(A.stations(s, d)).withColumnRenamed("distance_m", "distance")).select("sensor_id_1", "sensor_id_2", "distance", "similarity"),
    "node_table": lambda s, d: G.node_table(A.stations(s, d), G.sensor_mean_first_available(daily(s, d))),
    "degree": lambda s, d: N.degree(spatial_nodes(s, d), spatial_edges(s, d)),
    "degree_distribution": lambda s, d: N.degree_distribution(N.degree(spatial_nodes(s, d), spatial_edges(s, d))),
    "monthly_sensor_series": monthly,
    "sensor_coverage": lambda s, d: H.sensor_coverage(monthly(s, d)),
    "sensor_month_matrix": lambda s, d: H.sensor_month_matrix(monthly(s, d), range(24)),
    "sensor_correlations": lambda s, d: H.sensor_correlations(monthly(s, d)),
    "correlation_matrix": lambda s, d: H.correlation_matrix(pairs(s, d)),
    "correlation_pairs": lambda s, d: H.correlation_pairs(pairs(s, d), H.sensor_coverage(monthly(s, d))),
    "correlation_threshold_graph": lambda s, d: H.correlation_threshold_graph(pairs(s, d), THRESHOLDS),
    "connected_components": components,
    "connected_components_correlation": lambda s, d: components(s, d, "correlation"),
    "clustering": lambda s, d: N.clustering(spatial_nodes(s, d), spatial_edges(s, d)),
    "clustering_weighted": lambda s, d: N.clustering(corr_nodes(s, d), corr_edges(s, d), "weight"),
    "weighted_degree": lambda s, d: N.weighted_degree(corr_nodes(s, d), corr_edges(s, d)),
    "modularity": lambda s, d: N.modularity(corr_edges(s, d), halves(corr_nodes(s, d)), "weight"),
    "shortest_paths": paths,
    "average_shortest_path": lambda s, d: N.average_shortest_path(paths(s, d), components(s, d)),
    "closeness": lambda s, d: N.closeness(spatial_nodes(s, d), paths(s, d)),
    "closeness_estimated": lambda s, d: P.closeness_estimated(spatial_nodes(s, d), profile(s, d)),
    "average_shortest_path_estimated": lambda s, d: P.average_shortest_path_estimated(profile(s, d), components(s, d)),
    "betweenness_sampled": lambda s, d: N.betweenness(spatial_nodes(s, d), spatial_edges(s, d), samples=64),
    "graph_summary": summary,
    "graph_summary_correlation": lambda s, d: summary(s, d, "correlation"),
    "select_graph": selected,
    "graph_comparison": lambda s, d: N.graph_comparison(summary(s, d)),
    "select_correlation_graph": lambda s, d: H.select_correlation_graph(summary(s, d, "correlation")),
    "spatial_vs_correlation": lambda s, d: H.spatial_vs_correlation(selected(s, d), H.select_correlation_graph(summary(s, d, "correlation"))),
    "cross_pollutant_summary": lambda s, d: H.cross_pollutant_summary(summary(s, d, "correlation")),
    "nearest_threshold": lambda s, d: H.nearest_threshold(summary(s, d, "correlation"), 0.60),
    "edge_overlay": lambda s, d: H.edge_overlay(*_overlay_parts(s, d)),
    "overlay_summary": lambda s, d: H.overlay_summary(H.edge_overlay(*_overlay_parts(s, d)), "knn_k2", "NO2_corr_0.10"),
    "overlay_nodes": lambda s, d: H.overlay_nodes(spatial_nodes(s, d), corr_nodes(s, d), A.stations(s, d)),
    "communities": groups,
    "communities_correlation": lambda s, d: groups(s, d, "correlation"),
    "community_quality": lambda s, d: C.partition_quality(spatial_edges(s, d), groups(s, d), "similarity"),
    "community_quality_correlation": lambda s, d: C.partition_quality(corr_edges(s, d), groups(s, d, "correlation"), "weight"),
    "community_jaccard": lambda s, d: H.community_jaccard(N.selected_table(groups(s, d), selected(s, d)), _corr_groups(s, d)),
    "eigenvector_centrality": eigen,
    "pagerank": lambda s, d: N.pagerank(spatial_nodes(s, d), spatial_edges(s, d), "similarity"),
    "betweenness": between,
    "node_metrics": metrics,
    "node_metrics_correlation": lambda s, d: metrics(s, d, "correlation"),
    "selected_tables": lambda s, d: N.selected_table(metrics(s, d), selected(s, d)),
    "top_nodes": lambda s, d: N.top_nodes(metrics(s, d), ["betweenness_centrality", "closeness_centrality", "eigenvector_centrality", "avg_pollution"]),
}
QUERIES = {k: (lambda s, d, f=f: present(f(s, d))) for k, f in QUERIES.items()}

_COMPONENTS = """WITH RECURSIVE reach AS (SELECT graph_name, id, id AS other FROM {n} UNION SELECT r.graph_name, r.id, e.dst FROM reach r JOIN {both} e ON e.graph_name = r.graph_name AND e.src = r.other)
  SELECT graph_name, id, min(other) AS component FROM reach GROUP BY 1, 2"""
_PATHS = """WITH RECURSIVE d(graph_name, source, node, dist) USING KEY (graph_name, source, node) AS (SELECT graph_name, id, id, 0.0::DOUBLE FROM {n}
  UNION SELECT d.graph_name, d.source, e.dst, min(d.dist + e.distance) FROM d JOIN {w} e ON e.graph_name = d.graph_name AND e.src = d.node
    LEFT JOIN recurring.d r ON r.graph_name = d.graph_name AND r.source = d.source AND r.node = e.dst WHERE r.dist IS NULL OR d.dist + e.distance < r.dist GROUP BY 1, 2, 3)
  SELECT * FROM d"""
_MEAN_PATH = """SELECT graph_name, avg(dist) AS l FROM {p} p JOIN (SELECT graph_name, id FROM {c} c JOIN (SELECT graph_name, component, row_number() OVER (PARTITION BY graph_name ORDER BY count(*) DESC, component) AS r
    FROM {c} GROUP BY 1, 2) USING (graph_name, component) WHERE r = 1) m USING (graph_name) WHERE m.id = p.source AND p.source <> p.node GROUP BY 1"""
_SUMMARY = """WITH deg AS (SELECT n.graph_name, {attrs}, n.id, count(e.src) AS deg FROM {n} n LEFT JOIN {both} e ON e.graph_name = n.graph_name AND e.src = n.id GROUP BY ALL),
  base AS (SELECT graph_name, {attrs}, count(*) AS n_nodes, CAST(sum(deg) / 2 AS BIGINT) AS n_edges, avg(deg) AS average_degree, min(deg) AS min_degree, max(deg) AS max_degree FROM deg GROUP BY ALL),
  comp AS (SELECT graph_name, count(*) = 1 AS is_connected, count(*) AS n_connected_components, max(s) AS largest_component_size FROM (SELECT graph_name, component, count(*) AS s FROM {c} GROUP BY 1, 2) GROUP BY 1),
  cl AS (SELECT graph_name, coalesce(avg(clustering_coefficient), 0) AS average_clustering FROM ({clus}) GROUP BY 1), pl AS (""" + _MEAN_PATH + """)
  SELECT base.*, CASE WHEN n_nodes > 1 THEN 2 * n_edges / (n_nodes * (n_nodes - 1))::DOUBLE ELSE 0 END AS density, is_connected, n_connected_components, largest_component_size, average_clustering,
    CASE WHEN n_edges > 0 THEN l END AS average_shortest_path_largest_component
  FROM base LEFT JOIN comp USING (graph_name) LEFT JOIN cl USING (graph_name) LEFT JOIN pl USING (graph_name)"""


def _clustering(n, edges, w):
    weight = "1.0::DOUBLE" if w is None else f"{w} / max({w}) OVER (PARTITION BY graph_name)"
    t = "count(*)::DOUBLE" if w is None else "sum((x.w * y.w * z.w) ** (1.0::DOUBLE / 3))"
    return f"""WITH e AS (SELECT graph_name, src, dst, {weight} AS w FROM {edges}), b AS (SELECT * FROM e UNION ALL SELECT graph_name, dst, src, w FROM e),
      t AS (SELECT x.graph_name, x.src AS id, {t} AS t FROM b x JOIN b y ON x.graph_name = y.graph_name AND x.src = y.src AND x.dst < y.dst JOIN e z ON z.graph_name = x.graph_name AND z.src = x.dst AND z.dst = y.dst GROUP BY 1, 2),
      d AS (SELECT graph_name, src AS id, count(*) AS d FROM b GROUP BY 1, 2)
      SELECT n.graph_name, n.id, coalesce(2 * t / (d * (d - 1)), 0) AS clustering_coefficient FROM {n} n LEFT JOIN d ON d.graph_name = n.graph_name AND d.id = n.id LEFT JOIN t ON t.graph_name = n.graph_name AND t.id = n.id"""


_DIST = "sqrt((a.utm_x - b.utm_x) * (a.utm_x - b.utm_x) + (a.utm_y - b.utm_y) * (a.utm_y - b.utm_y))"
CTES = {
    "dists": f"SELECT a.sensor_id AS sensor_id_1, a.sensor_name AS sensor_name_1, b.sensor_id AS sensor_id_2, b.sensor_name AS sensor_name_2, {_DIST} AS distance_m FROM stations a JOIN stations b ON a.sensor_id < b.sensor_id",
    "thr": """SELECT DISTINCT CAST(round_even(q, 0) AS INTEGER) AS threshold_m FROM (SELECT unnest(quantile_cont(distance_m, [0.1, 0.25, 0.5, 0.75])) AS q FROM dists)""",
    "thr_e": """SELECT 'threshold_' || threshold_m || 'm' AS graph_name, 'threshold' AS method, threshold_m, NULL::INTEGER AS k, sensor_id_1 AS src, sensor_id_2 AS dst, distance_m AS distance,
      1 / (1 + distance_m) AS similarity FROM dists JOIN thr ON distance_m <= threshold_m""",
    "ranked_n": f"""SELECT a.sensor_id AS s, b.sensor_id AS n, {_DIST} AS distance, row_number() OVER (PARTITION BY a.sensor_id ORDER BY {_DIST}, b.sensor_id) AS r
      FROM stations a JOIN stations b ON a.sensor_id <> b.sensor_id""",
    "knn_e": """SELECT DISTINCT 'knn_k' || k AS graph_name, 'knn' AS method, NULL::INTEGER AS threshold_m, k, least(s, n) AS src, greatest(s, n) AS dst, distance, 1 / (1 + distance) AS similarity
      FROM ranked_n JOIN (SELECT unnest([2, 3, 4, 5]) AS k) ON r <= k""",
    "sp_e": "SELECT * FROM thr_e UNION ALL SELECT * FROM knn_e",
    "sp_g": "SELECT 'threshold_' || threshold_m || 'm' AS graph_name, 'threshold' AS method, threshold_m, NULL::INTEGER AS k FROM thr UNION ALL SELECT 'knn_k' || k, 'knn', NULL, k FROM (SELECT unnest([2, 3, 4, 5]) AS k)",
    "sp_n": "SELECT graph_name, sensor_id AS id FROM sp_g CROSS JOIN stations",
    "sp_both": "SELECT graph_name, src, dst FROM sp_e UNION ALL SELECT graph_name, dst, src FROM sp_e",
    "first_pol": """SELECT sensor_id, avg(value) AS avg_pollution FROM daily WHERE upper(trim(magnitude_name)) = (SELECT n FROM (SELECT unnest(['NO2', 'NOX', 'NO']) AS n, unnest([0, 1, 2]) AS o)
      WHERE n IN (SELECT upper(trim(magnitude_name)) FROM daily) ORDER BY o LIMIT 1) GROUP BY 1""",
    "sm": "SELECT magnitude_name, date_trunc('month', entry_date)::DATE AS month, sensor_id, avg(value) AS mean_value, min(sensor_name) AS sensor_name FROM daily GROUP BY ALL",
    "cov": "SELECT magnitude_name, sensor_id, count(mean_value) AS n_months_available, count(mean_value) >= 24 AS kept_for_correlation, min(sensor_name) AS sensor_name FROM sm GROUP BY ALL",
    "prs": """SELECT a.magnitude_name, a.sensor_id AS sensor_id_1, b.sensor_id AS sensor_id_2, count(*) AS n_months, CASE WHEN count(*) >= 24 AND min(a.mean_value) < max(a.mean_value) AND min(b.mean_value) < max(b.mean_value)
      THEN corr(a.mean_value, b.mean_value) END AS correlation FROM (SELECT sm.* FROM sm JOIN cov USING (magnitude_name, sensor_id) WHERE kept_for_correlation) a
      JOIN (SELECT sm.* FROM sm JOIN cov USING (magnitude_name, sensor_id) WHERE kept_for_correlation) b ON a.magnitude_name = b.magnitude_name AND a.month = b.month AND a.sensor_id < b.sensor_id GROUP BY ALL""",
    "levels": "SELECT unnest([0.05::DOUBLE, 0.10, 0.15, 0.90]) AS threshold",
    "co_e": """SELECT magnitude_name || '_corr_' || printf('%.2f', threshold) AS graph_name, magnitude_name AS magnitude, threshold, sensor_id_1 AS src, sensor_id_2 AS dst, correlation AS weight,
      greatest(1 - correlation, 0) AS distance FROM prs JOIN levels ON correlation >= threshold""",
    "co_n": "SELECT magnitude_name || '_corr_' || printf('%.2f', threshold) AS graph_name, magnitude_name AS magnitude, threshold, sensor_id AS id FROM cov CROSS JOIN levels",
    "co_both": "SELECT graph_name, src, dst, weight FROM co_e UNION ALL SELECT graph_name, dst, src, weight FROM co_e",
    "sp_w": "SELECT graph_name, src, dst, distance FROM sp_e UNION ALL SELECT graph_name, dst, src, distance FROM sp_e",
    "sp_p": _PATHS.format(n="sp_n", w="sp_w"),
    "sp_c": _COMPONENTS.format(n="sp_n", both="sp_both"),
    "sp_s": _SUMMARY.format(attrs="method, threshold_m, k", n="(SELECT * FROM sp_n JOIN sp_g USING (graph_name))", both="sp_both", c="sp_c", p="sp_p", clus=_clustering("sp_n", "sp_e", None)),
    "sp_sel": """SELECT * FROM (SELECT *, CASE WHEN method = 'knn' AND is_connected THEN 0 WHEN graph_name = 'knn_k3' THEN 1 ELSE 2 END AS fit FROM sp_s)
      ORDER BY fit, CASE WHEN fit = 0 THEN k END NULLS FIRST, graph_name LIMIT 1""",
    "co_w": "SELECT graph_name, src, dst, distance FROM co_e UNION ALL SELECT graph_name, dst, src, distance FROM co_e",
    "co_p": _PATHS.format(n="co_n", w="co_w"),
    "co_c": _COMPONENTS.format(n="co_n", both="co_both"),
    "co_s": _SUMMARY.format(attrs="magnitude, threshold", n="co_n", both="co_both", c="co_c", p="co_p", clus=_clustering("co_n", "co_e", "weight")),
    "co_sel": """SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY magnitude ORDER BY is_connected DESC, CASE WHEN is_connected THEN threshold END DESC NULLS LAST, largest_component_size DESC, threshold) AS r FROM co_s) WHERE r = 1""",
    "btw": """WITH RECURSIVE tight AS (SELECT e.graph_name, a.source, e.src AS u, e.dst AS v FROM sp_w e JOIN sp_p a ON a.graph_name = e.graph_name AND a.node = e.src
        JOIN sp_p b ON b.graph_name = e.graph_name AND b.source = a.source AND b.node = e.dst WHERE a.dist + e.distance = b.dist),
      walk(graph_name, source, node, via) AS (SELECT graph_name, id, id, []::BIGINT[] FROM sp_n
        UNION ALL SELECT w.graph_name, w.source, t.v, CASE WHEN w.node = w.source THEN w.via ELSE list_append(w.via, w.node::BIGINT) END FROM walk w JOIN tight t ON t.graph_name = w.graph_name AND t.source = w.source AND t.u = w.node),
      shared AS (SELECT graph_name, unnest(via) AS id, 1 / ways AS part FROM (SELECT *, count(*) OVER (PARTITION BY graph_name, source, node)::DOUBLE AS ways FROM walk)),
      sums AS (SELECT graph_name, id, sum(part) AS b FROM shared GROUP BY 1, 2)
      SELECT n.graph_name, n.id, coalesce(b, 0) / nullif((count(*) OVER (PARTITION BY n.graph_name) - 1) * (count(*) OVER (PARTITION BY n.graph_name) - 2), 0)::DOUBLE AS betweenness_centrality
      FROM sp_n n LEFT JOIN sums s ON s.graph_name = n.graph_name AND s.id = n.id""",
    "overlay": """SELECT coalesce(s.src, c.src) AS src, coalesce(s.dst, c.dst) AS dst, CASE WHEN s.src IS NULL THEN 'correlation_only' WHEN c.src IS NULL THEN 'spatial_only' ELSE 'shared' END AS edge_class
      FROM (SELECT src, dst FROM knn_e WHERE k = 2) s FULL JOIN (SELECT src, dst FROM co_e WHERE magnitude = 'NO2' AND threshold = 0.1::DOUBLE) c ON s.src = c.src AND s.dst = c.dst""",
}


def _c(body, **kw):
    return check_sql(body, ctes=CTES, **kw)


_DEG = """SELECT n.graph_name, n.id, count(e.src) AS degree, count(e.src) / (count(*) OVER (PARTITION BY n.graph_name) - 1)::DOUBLE AS degree_centrality
  FROM sp_n n LEFT JOIN sp_both e ON e.graph_name = n.graph_name AND e.src = n.id GROUP BY 1, 2"""
_SUM = "density average_degree average_clustering average_shortest_path_largest_component"
_COUNTS = "n_nodes n_edges min_degree max_degree n_connected_components largest_component_size"
_SIX = "n_nodes, n_edges, density, average_degree, n_connected_components, largest_component_size"
_SE = dict(d="distance similarity", i="threshold_m k src dst")
CHECKS = {
    "write_graph_read_graph": _c("""SELECT g.*, (SELECT count(*) FROM stations) AS n_nodes, n_edges, total_distance FROM sp_g g LEFT JOIN
      (SELECT graph_name, count(*) AS n_edges, sum(distance) AS total_distance FROM sp_e GROUP BY 1) e ON g.graph_name = e.graph_name""", d="total_distance", i="threshold_m k", digits=6),
    "sensor_mean_first_available": _c("SELECT * FROM first_pol", d="avg_pollution", i="sensor_id"),
    "sensor_coordinates": _c("SELECT sensor_id, sensor_name, avg(utm_x) AS utm_x, avg(utm_y) AS utm_y FROM daily WHERE utm_x IS NOT NULL AND utm_y IS NOT NULL GROUP BY 1, 2", d="utm_x utm_y", i="sensor_id"),
    "pairwise_distances": _c("SELECT * FROM dists", d="distance_m", i="sensor_id_1 sensor_id_2"),
    "distance_quantiles": _c("SELECT q AS quantile, distance_m, CAST(round_even(distance_m, 0) AS BIGINT) AS threshold_m FROM (SELECT unnest([0.1::DOUBLE, 0.25, 0.5, 0.75]) AS q, unnest(quantile_cont(distance_m, [0.1, 0.25, 0.5, 0.75])) AS distance_m FROM dists)", d="quantile distance_m"),
    "threshold_graph": _c("SELECT * FROM thr_e", **_SE),
    "knn_graph": _c("SELECT * FROM knn_e", **_SE),
    "underfull_sensors": _c("SELECT sensor_id, (SELECT count(*) - 1 FROM stations) AS available_neighbors, k AS requested_k FROM stations CROSS JOIN (SELECT unnest([3, 5000]) AS k) WHERE (SELECT count(*) - 1 FROM stations) < k", i="sensor_id requested_k"),
    "edge_weights": _c("SELECT sensor_id_1, sensor_id_2, distance_m AS distance, 1 / (1 + distance_m) AS similarity FROM dists", d="distance similarity", i="sensor_id_1 sensor_id_2"),
    "node_table": _c("SELECT s.*, avg_pollution FROM stations s LEFT JOIN first_pol USING (sensor_id)", d="utm_x utm_y avg_pollution", i="sensor_id"),
    "degree": _c(_DEG, d="degree_centrality", i="id"),
    "degree_distribution": _c(f"SELECT graph_name, degree, count(*) AS n_sensors FROM ({_DEG}) GROUP BY 1, 2"),
    "monthly_sensor_series": _c("SELECT * FROM sm", d="mean_value", i="sensor_id", dates="month"),
    "sensor_coverage": _c("SELECT * FROM cov", i="sensor_id"),
    "sensor_month_matrix": _c("SELECT magnitude_name, month, " + ", ".join(f"max(mean_value) FILTER (WHERE sensor_id = {i}) AS sensor_{i}" for i in range(24)) + " FROM sm JOIN cov USING (magnitude_name, sensor_id) WHERE kept_for_correlation GROUP BY 1, 2",
                              d=" ".join(f"sensor_{i}" for i in range(24)), dates="month"),
    "sensor_correlations": _c("SELECT * FROM prs", d="correlation", i="sensor_id_1 sensor_id_2"),
    "correlation_matrix": _c("""SELECT magnitude_name, sensor_id_1, sensor_id_2, correlation FROM prs UNION ALL SELECT magnitude_name, sensor_id_2, sensor_id_1, correlation FROM prs
      UNION ALL SELECT magnitude_name, sensor_id, sensor_id, 1.0 FROM cov WHERE kept_for_correlation""", d="correlation", i="sensor_id_1 sensor_id_2"),
    "correlation_pairs": _c("""SELECT magnitude_name, sensor_id_1, 'station_' || sensor_id_1 || ' (' || sensor_id_1 || ')' AS sensor_name_1, sensor_id_2, 'station_' || sensor_id_2 || ' (' || sensor_id_2 || ')' AS sensor_name_2,
      correlation, abs(correlation) AS absolute_correlation FROM prs WHERE correlation IS NOT NULL""", d="correlation absolute_correlation", i="sensor_id_1 sensor_id_2"),
    "correlation_threshold_graph": _c("SELECT * FROM co_e", d="threshold weight distance", i="src dst"),
    "connected_components": _c("SELECT * FROM sp_c", i="id component"),
    "connected_components_correlation": _c("SELECT * FROM co_c", i="id component"),
    "clustering": _c(_clustering("sp_n", "sp_e", None), d="clustering_coefficient", i="id"),
    "clustering_weighted": _c(_clustering("co_n", "co_e", "weight"), d="clustering_coefficient", i="id"),
    "weighted_degree": _c("SELECT n.graph_name, n.id, coalesce(sum(weight), 0) AS weighted_degree FROM co_n n LEFT JOIN co_both e ON e.graph_name = n.graph_name AND e.src = n.id GROUP BY 1, 2", d="weighted_degree", i="id"),
    "modularity": _c("""SELECT graph_name, sum(inside / total - (k / total) ** 2) AS modularity FROM (SELECT *, sum(k) OVER (PARTITION BY graph_name) AS total FROM (
      SELECT graph_name, src % 2 AS c, sum(weight) AS k, coalesce(sum(weight) FILTER (WHERE src % 2 = dst % 2), 0) AS inside FROM co_both GROUP BY 1, 2)) GROUP BY 1""", d="modularity"),
    "shortest_paths": _c("SELECT * FROM sp_p", d="dist", i="source node"),
    "average_shortest_path": _c("SELECT graph_name, l AS average_shortest_path FROM sp_g LEFT JOIN (" + _MEAN_PATH.format(p="sp_p", c="sp_c") + ") USING (graph_name)", d="average_shortest_path"),
    "closeness": _c("""SELECT n.graph_name, n.id, CASE WHEN s > 0 AND total > 1 THEN r / s * r / (total - 1) ELSE 0 END AS closeness_centrality FROM (SELECT *, count(*) OVER (PARTITION BY graph_name) AS total FROM sp_n) n
      JOIN (SELECT graph_name, node AS id, count(*) - 1 AS r, sum(dist) AS s FROM sp_p GROUP BY 1, 2) USING (graph_name, id)""", d="closeness_centrality", i="id"),
    "betweenness": _c("SELECT * FROM btw", d="betweenness_centrality", i="id"),
    "graph_summary": _c("SELECT * FROM sp_s", d=_SUM, i=_COUNTS + " threshold_m k"),
    "graph_summary_correlation": _c("SELECT * FROM co_s", d=_SUM + " threshold", i=_COUNTS),
    "select_graph": _c("SELECT * EXCLUDE (fit) FROM sp_sel", d=_SUM, i=_COUNTS + " threshold_m k"),
    "graph_comparison": _c("""SELECT graph_name, unnest(['density', 'n_connected_components', 'average_degree']) AS measure, unnest([density::DOUBLE, n_connected_components::DOUBLE, average_degree::DOUBLE]) AS value FROM sp_s""", d="value"),
    "select_correlation_graph": _c("SELECT * FROM co_sel", d=_SUM + " threshold", i=_COUNTS),
    "spatial_vs_correlation": _c(f"""SELECT 'spatial_distance' AS network_type, graph_name AS selected_graph, {_SIX}, magnitude FROM sp_sel CROSS JOIN (SELECT magnitude FROM co_sel)
      UNION ALL SELECT 'correlation_behaviour', graph_name, {_SIX}, magnitude FROM co_sel""", d="density average_degree", i="n_nodes n_edges n_connected_components largest_component_size"),
    "cross_pollutant_summary": _c("SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY magnitude ORDER BY threshold) AS r FROM co_s) WHERE r = 1", d=_SUM + " threshold", i=_COUNTS),
    "nearest_threshold": _c("""SELECT * EXCLUDE (o) FROM (SELECT *, list_position(['NO2', 'NOX', 'NO'], upper(magnitude)) AS o FROM co_s) WHERE o IS NOT NULL ORDER BY o, round(abs(threshold - 0.60::DOUBLE), 12), threshold LIMIT 1""", d=_SUM + " threshold", i=_COUNTS),
    "community_quality": _c("SELECT graph_name, true AS modularity_equal, 0::BIGINT AS gaining_moves FROM sp_g"),
    "community_quality_correlation": _c("SELECT DISTINCT graph_name, true AS modularity_equal, 0::BIGINT AS gaining_moves FROM co_n"),
    "edge_overlay": _c("SELECT * FROM overlay", i="src dst"),
    "overlay_summary": _c("""SELECT 'knn_k2' AS spatial_graph, 'NO2_corr_0.10' AS correlation_graph, count(*) FILTER (WHERE edge_class IN ('shared', 'spatial_only')) AS n_spatial_edges,
      count(*) FILTER (WHERE edge_class IN ('shared', 'correlation_only')) AS n_correlation_edges, count(*) FILTER (WHERE edge_class = 'shared') AS n_shared_edges, count(*) FILTER (WHERE edge_class = 'spatial_only') AS n_spatial_only,
      count(*) FILTER (WHERE edge_class = 'correlation_only') AS n_correlation_only, count(*) FILTER (WHERE edge_class = 'shared') / greatest(count(*), 1)::DOUBLE AS jaccard_edge_similarity FROM overlay""", d="jaccard_edge_similarity"),
    "overlay_nodes": _c("SELECT sensor_id AS id, sensor_name, utm_x, utm_y FROM stations", d="utm_x utm_y", i="id"),
}
