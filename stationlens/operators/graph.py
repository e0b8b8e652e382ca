"""Graph analytics on tables of nodes and edges, for any number of graphs at once.

``nodes`` has (graph_name, id), ``edges`` (graph_name, src, dst, weights) with each undirected
edge once. Vector iterations write several rounds as one plan and checkpoint between such blocks;
links lie in a table bucketed by their first end, so a round moves the state alone. Rounds carry a
node's own state along a loop edge, so a plan refers to the state once per round and stays linear
in the number of rounds. Paths and communities are in modules of their own.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlens.functions.columns import ratio
from stationlens.functions.components import contract_components, starred
from stationlens.operators.blocks import triangle_sums
from stationlens.operators.community import communities, modularity  # noqa: F401
from stationlens.operators.links import G, Adjacency, both_ways
from stationlens.operators.paths import average_shortest_path, betweenness, closeness, component_sizes, shortest_paths  # noqa: F401
from stationlens.scratch import Scratch, partitions_for
from stationlens.session import checkpointed

DENSE_WEDGES = 20_000_000
ROUND_LINKS = 250_000


def _loops(nodes, **values):
    return nodes.select(G, F.col("id").alias("src"), F.col("id").alias("dst"), *[F.lit(v).alias(k) for k, v in values.items()])


def _own(c):
    """Aggregate that keeps the value a node sends to itself."""
    return F.max(F.when(F.col("src") == F.col("dst"), F.col(c)))


def degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(graph_name, id, degree, degree_centrality); isolated nodes have degree 0."""
    counts = both_ways(edges).groupBy(G, F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("_d"))
    sizes = nodes.groupBy(G).agg(F.count(F.lit(1)).alias("_n"))
    d = F.coalesce("_d", F.lit(0))
    # A graph of a single node has centrality 1, as the convention is.
    central = F.when(F.col("_n") <= 1, 1.0).otherwise(d / (F.col("_n") - 1))
    return nodes.select(G, "id").join(counts, [G, "id"], "left").join(sizes, G).select(G, "id", d.alias("degree"), central.alias("degree_centrality"))


def weighted_degree(nodes: DataFrame, edges: DataFrame, weight: str = "weight") -> DataFrame:
    sums = both_ways(edges, weight).groupBy(G, F.col("src").alias("id")).agg(F.sum(weight).alias("_w"))
    return nodes.select(G, "id").join(sums, [G, "id"], "left").select(G, "id", F.coalesce("_w", F.lit(0.0)).alias("weighted_degree"))


def degree_distribution(degrees: DataFrame) -> DataFrame:
    return degrees.groupBy(G, "degree").agg(F.count(F.lit(1)).alias("n_sensors")).orderBy(G, "degree")


def clustering(nodes: DataFrame, edges: DataFrame, weight: str = None, dense_wedges: int = DENSE_WEDGES) -> DataFrame:
    """Clustering coefficient per node; with ``weight`` the geometric mean of normalised weights.

    Triangles are listed from edges pointed at the node of higher degree, so no node opens more
    wedges than the square root of the number of edges allows. Graphs that open more than
    ``dense_wedges`` of them, and more than a thousandth of n^3, take matrix products of node
    blocks instead (``blocks.triangle_sums``), which make no row per wedge.
    """
    scratch = Scratch(nodes.sparkSession, "triangles")
    deg = degree(nodes, edges).select(G, "id", "degree")
    w = F.col(weight) if weight else F.lit(1.0)
    e = edges.select(G, F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"), w.alias("w"))
    top = e.groupBy(G).agg(F.max("w").alias("_top"))
    e = e.join(top, G).select(G, "u", "v", (F.col("w") / F.col("_top")).alias("w"))
    ends = e.join(deg.select(G, F.col("id").alias("u"), F.col("degree").alias("du")), [G, "u"]).join(
        deg.select(G, F.col("id").alias("v"), F.col("degree").alias("dv")), [G, "v"]
    )
    forward = F.struct("du", "u") < F.struct("dv", "v")
    low = ends.select(G, F.when(forward, F.col("u")).otherwise(F.col("v")).alias("a"), F.when(forward, F.col("v")).otherwise(F.col("u")).alias("b"), "w")
    low = scratch.put("low", low)
    n = nodes.groupBy(G).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    opened = low.groupBy(G, "a").agg(F.count(F.lit(1)).cast("double").alias("_d")).groupBy(G).agg(F.sum(F.col("_d") * F.col("_d") / 2).alias("_wedges"))
    crowded = (F.col("_wedges") > dense_wedges) & (F.col("_wedges") * 1000 > F.pow("_n", F.lit(3)))
    dense = scratch.put("dense", opened.join(n, G).filter(crowded).select(G))

    few = low.join(dense, G, "left_anti")
    second = few.select(G, "a", F.col("b").alias("c"), F.col("w").alias("w2"))
    wedges = few.join(second, [G, "a"]).filter("b < c")
    closed = wedges.join(e.select(G, F.col("u").alias("b"), F.col("v").alias("c"), F.col("w").alias("w3")), [G, "b", "c"])
    size = F.pow(F.col("w") * F.col("w2") * F.col("w3"), F.lit(1.0 / 3)) if weight else F.lit(1.0)
    corner = closed.select(G, size.alias("_t"), F.explode(F.array("a", "b", "c")).alias("id")).groupBy(G, "id").agg(F.sum("_t").alias("_t"))
    if not dense.isEmpty():
        root = F.pow(F.col("w"), F.lit(1.0 / 3)) if weight else F.lit(1.0)
        many = lambda links, a, b: links.join(dense, G, "left_semi").select(G, a, b, root.alias("x"))
        ids = nodes.select(G, "id").join(dense, G, "left_semi")
        inner = Scratch(nodes.sparkSession, "corners", partitions_for(edges.count()))
        corner = corner.unionByName(triangle_sums(inner, ids, many(low, "a", "b"), many(e, "u", "v")))
    d = F.col("degree")
    return deg.join(corner, [G, "id"], "left").select(
        G, "id", F.coalesce(F.try_divide(2 * F.col("_t"), d * (d - 1)), F.lit(0.0)).alias("clustering_coefficient")
    )


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(graph_name, id, component): the smallest node id each node can reach.

    Links are contracted, so their number falls with every round and the rounds grow with the
    logarithm of the number of nodes. Before the first one, each task replaces its links by one
    per node, so dense graphs do not move their links at all.
    """
    ends = [F.struct(F.col(G), F.col(c).alias("id")).alias(c) for c in ("src", "dst")]
    labels = contract_components(starred(edges.select(G, "src", "dst")).select(*ends), "src", "dst")
    least = labels.groupBy("label").agg(F.min("id.id").alias("component"))
    found = labels.join(least, "label").select(f"id.{G}", "id.id", "component")
    return nodes.select(G, "id").join(found, [G, "id"], "left").select(G, "id", F.coalesce("component", "id").alias("component"))


def component_summary(components: DataFrame) -> DataFrame:
    """Number of components, the largest one and whether the graph is connected."""
    return component_sizes(components).groupBy(G).agg(
        F.count(F.lit(1)).alias("n_connected_components"), F.max("component_size").alias("largest_component_size"),
        (F.count(F.lit(1)) == 1).alias("is_connected"),
    )


def _shifted(block):
    """Aggregates that keep a node's last ``block`` values, the newest as h0; the same for every round, so that they compile once."""
    return [_own("x" if i == 0 else f"h{i - 1}").alias(f"h{i}") for i in range(block)]


def _iterate(state, step, sizes, tol, max_rounds, block, normalise):
    """Run ``step`` until each graph's vector moves less than n * tol in total.

    ``step`` turns (graph_name, src, x, h0, h1, ..., extras) into the next round, where h0 is the x
    before it, h1 the one before that and so on; single numbers, so that a round sums in a hash map
    and does not sort the links. Returns (graph_name, id, x) of the graphs that settled.
    """
    settled, done = [], 0
    while done < max_rounds:
        n = min(block, max_rounds - done)
        run = state.select("*", *[F.lit(None).cast("double").alias(f"h{i}") for i in range(block)])
        for _ in range(n):
            run = step(run)
        run = checkpointed(run)
        hist = F.array(*[f"h{i}" for i in reversed(range(n))], "x")
        rows = run.select(G, F.col("src").alias("id"), F.posexplode(hist).alias("t", "y"))
        if normalise:
            norms = rows.groupBy(G, "t").agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("_norm"))
            scale = F.when((F.col("t") == 0) | (F.col("_norm") == 0), 1.0).otherwise(F.col("_norm"))
            rows = rows.join(norms, [G, "t"]).withColumn("y", F.col("y") / scale)
        w = Window.partitionBy(G, "id").orderBy("t")  # one row per round of this block
        moved = rows.withColumn("_m", F.abs(F.col("y") - F.lag("y").over(w))).filter("t > 0").groupBy(G, "t").agg(F.sum("_m").alias("_m"))
        stops = checkpointed(moved.join(sizes, G).filter(F.col("_m") < F.col("n") * tol).groupBy(G).agg(F.min("t").alias("t")))
        settled.append(rows.join(stops, [G, "t"]).select(G, "id", F.col("y").alias("x")))
        last = rows.filter(F.col("t") == n).join(stops, G, "left_anti").select(G, F.col("id").alias("src"), F.col("y").alias("x"))
        extras = [c for c in state.columns if c not in (G, "src", "x")]
        state = last.join(run.select(G, "src", *extras), [G, "src"]) if extras else last
        state = checkpointed(state)
        done += n
        if state.isEmpty():
            break
    return reduce(DataFrame.unionByName, settled)


def eigenvector_centrality(nodes: DataFrame, edges: DataFrame, weight: str, tol: float = 1e-6, max_rounds: int = 500, block: int = 20) -> DataFrame:
    """Power iteration on I + A from a uniform start; null where a graph did not settle, 0 without edges."""
    active = edges.select(G).distinct()
    scratch = Scratch(nodes.sparkSession, "eigen", partitions_for(edges.count()))
    members = scratch.put("members", nodes.select(G, "id").join(active, G, "left_semi"))
    sizes = scratch.put("sizes", members.groupBy(G).agg(F.count(F.lit(1)).alias("n")))
    links = Adjacency(scratch, both_ways(edges, weight).withColumnRenamed(weight, "w").unionAll(_loops(members, w=1.0)), bucket_links=ROUND_LINKS)

    def step(s):
        return (
            links.meet(s).groupBy(G, "dst").agg(F.sum(F.col("w") * F.col("x")).alias("x"), *_shifted(block))
            .withColumnRenamed("dst", "src")
        )

    start = members.join(sizes, G).select(G, F.col("id").alias("src"), (1 / F.col("n")).alias("x"))
    found = scratch.give(scratch.put("settled", _iterate(start, step, sizes, tol, max_rounds, block, True)))
    scratch.close()
    value = F.when(F.col("_active").isNull(), 0.0).otherwise(F.col("x"))
    return nodes.select(G, "id").join(found, [G, "id"], "left").join(active.withColumn("_active", F.lit(1)), G, "left").select(G, "id", value.alias("eigenvector_centrality"))


def pagerank(nodes: DataFrame, edges: DataFrame, weight: str, damping: float = 0.85, tol: float = 1e-6, max_rounds: int = 100, block: int = 20) -> DataFrame:
    """Weighted PageRank with uniform teleport; nodes without links spread evenly."""
    scratch = Scratch(nodes.sparkSession, "pagerank", partitions_for(edges.count()))
    out = both_ways(edges, weight).groupBy(G, "src").agg(F.sum(weight).alias("_s"))
    members = scratch.put("members", nodes.select(G, "id"))
    sizes = scratch.put("sizes", members.groupBy(G).agg(F.count(F.lit(1)).alias("n")))
    linked = out.groupBy(G).agg(F.count(F.lit(1)).alias("_linked"))
    facts = sizes.join(linked, G, "left").select(G, "n", (F.col("n") - F.coalesce("_linked", F.lit(0))).alias("alone"))
    shares = both_ways(edges, weight).join(out, [G, "src"]).select(G, "src", "dst", (F.col(weight) / F.col("_s")).alias("w"))
    links = Adjacency(scratch, shares.unionAll(_loops(nodes, w=0.0)), bucket_links=ROUND_LINKS)
    # All nodes without links share one value, which is all that is spread evenly: it needs no sum.
    base = (1 - damping) / F.col("n") + damping * F.col("alone") * F.col("z") / F.col("n")

    def step(s):
        summed = links.meet(s).groupBy(G, "dst").agg(
            F.sum(F.col("w") * F.col("x")).alias("_in"), *_shifted(block), *[_own(c).alias(c) for c in ("n", "alone", "z")]
        )
        return summed.withColumn("z", base).withColumn("x", damping * F.col("_in") + F.col("z")).select(
            G, F.col("dst").alias("src"), "x", *[f"h{i}" for i in range(block)], "n", "alone", "z"
        )

    start = members.join(facts, G).select(G, F.col("id").alias("src"), (1 / F.col("n")).alias("x"), "n", "alone", (1 / F.col("n")).alias("z"))
    found = scratch.give(scratch.put("settled", _iterate(start, step, sizes, tol, max_rounds, block, False)))
    scratch.close()
    return nodes.select(G, "id").join(found, [G, "id"], "left").select(G, "id", F.col("x").alias("pagerank"))


def graph_summary(nodes: DataFrame, edges: DataFrame, components: DataFrame, paths: DataFrame, attributes=(), weight: str = None) -> DataFrame:
    """Size, density, degrees, components, clustering and mean path length per graph.

    ``attributes`` are columns of ``nodes`` that belong to the graph (method, threshold, k).
    """
    facts = nodes.groupBy(G, *attributes).agg(F.count(F.lit(1)).alias("n_nodes"))
    n_edges = edges.groupBy(G).agg(F.count(F.lit(1)).alias("n_edges"))
    deg = degree(nodes, edges).groupBy(G).agg(F.avg("degree").alias("average_degree"), F.min("degree").alias("min_degree"), F.max("degree").alias("max_degree"))
    clus = clustering(nodes, edges, weight).groupBy(G).agg(F.avg("clustering_coefficient").alias("average_clustering"))
    n, m = F.col("n_nodes"), F.coalesce("n_edges", F.lit(0))
    return (
        facts.join(n_edges, G, "left").join(deg, G, "left").join(component_summary(components), G, "left").join(clus, G, "left")
        .join(average_shortest_path(paths, components), G, "left")
        .select(
            G, *attributes, "n_nodes", m.alias("n_edges"), F.coalesce(ratio(2 * m, n * (n - 1)), F.lit(0.0)).alias("density"),
            "average_degree", "min_degree", "max_degree", "is_connected", "n_connected_components", "largest_component_size",
            F.coalesce("average_clustering", F.lit(0.0)).alias("average_clustering"),
            F.when(m > 0, F.col("average_shortest_path")).alias("average_shortest_path_largest_component"),
        )
    )


def node_metrics(nodes: DataFrame, edges: DataFrame, paths: DataFrame, weight: str, fallback: str = "pagerank", extended: bool = False,
                 between: DataFrame = None, eigen: DataFrame = None) -> DataFrame:
    """One row per (graph, node) with all centralities beside the columns of ``nodes``.

    ``fallback`` says what stands in for an eigenvector that did not settle: "pagerank" or "zero".
    ``extended`` adds the weighted degree and the weighted clustering coefficient. ``between`` and
    ``eigen`` are results of ``betweenness`` and ``eigenvector_centrality`` already at hand.
    """
    key = [G, "id"]
    eigen = checkpointed(eigenvector_centrality(nodes, edges, weight)) if eigen is None else eigen
    between = betweenness(nodes, edges, paths) if between is None else between
    if fallback == "pagerank":
        missing = eigen.filter(F.col("eigenvector_centrality").isNull()).select(G).distinct()
        if not missing.isEmpty():
            ranks = pagerank(nodes.join(missing, G, "left_semi"), edges.join(missing, G, "left_semi"), weight)
            eigen = eigen.join(ranks, key, "left").select(*key, F.coalesce("eigenvector_centrality", "pagerank").alias("eigenvector_centrality"))
    eigen = eigen.na.fill(0.0, ["eigenvector_centrality"])
    out = nodes.join(degree(nodes, edges), key)
    if extended:
        out = out.join(weighted_degree(nodes, edges, weight), key)
    out = out.join(between, key).join(closeness(nodes, paths), key)
    if extended:
        out = out.join(clustering(nodes, edges, weight), key)
    return out.join(eigen, key)


def select_graph(summary: DataFrame, default: str = "knn_k3") -> DataFrame:
    """The connected neighbour graph with the smallest k; else ``default``; else the first graph."""
    fit = F.when((F.col("method") == "knn") & F.col("is_connected"), 0).when(F.col(G) == default, 1).otherwise(2)
    return summary.withColumn("_fit", fit).orderBy("_fit", F.when(F.col("_fit") == 0, F.col("k")), G).limit(1).drop("_fit")


def selected_table(table: DataFrame, selected: DataFrame) -> DataFrame:
    """Rows of the selected graph only."""
    return table.join(F.broadcast(selected.select(G)), G, "left_semi")  # one graph name


def top_nodes(metrics: DataFrame, columns, n: int = 3) -> DataFrame:
    """The n highest nodes per graph and metric, nulls left out: (graph_name, metric, rank, id, value)."""
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns])
    tall = metrics.select(G, "id", F.explode(cells).alias("r")).select(G, "id", "r.*").filter(F.col("value").isNotNull())
    w = Window.partitionBy(G, "metric").orderBy(F.desc("value"), "id")
    return tall.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def graph_comparison(summary: DataFrame, measures=("density", "n_connected_components", "average_degree")) -> DataFrame:
    """(graph_name, measure, value) over all graphs, null as 0."""
    cells = F.array(*[F.struct(F.lit(c).alias("measure"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("value")) for c in measures])
    return summary.select(G, F.explode(cells).alias("r")).select(G, "r.*")
