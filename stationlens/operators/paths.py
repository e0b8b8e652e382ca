"""Shortest paths and the measures that rest on them."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stationlens.operators.blocks import BLOCK_NODES, CELLS, TIGHT_LINKS, ball_sums, block_paths, dependency_sums, numbered_links, tight_links
from stationlens.operators.links import G, Adjacency, both_ways
from stationlens.scratch import Scratch, partitions_for

STATE_ROWS = 50_000_000
LOCAL_LINKS = 1_000_000
EXACT_NODES = 1 << 15
EXACT_LINKS = 1 << 25


def shortest_paths(nodes: DataFrame, edges: DataFrame, weight: str = "distance", sources: DataFrame = None, width: float = None, **blocks) -> DataFrame:
    """(graph_name, source, node, dist) for all reachable pairs, or from the given ``sources``.

    Nodes are dealt into blocks and sources into strips; a state row holds the distances of one
    strip to one block, a link row the links from one block to another, both as arrays of bounded
    size (see ``blocks``). A round joins the blocks that got shorter with the links out of them
    and merges the candidates, so a link is one addition per source and never a row per source.
    Entries beyond the current step of ``width`` (per graph four longest links by default) wait,
    so few are extended before their distance is final. A graph that fits one block is finished
    in one round.

    Distances are the sums of weights from the source on, added in that order. Weights are finite
    and not negative.
    """
    starts = nodes.select(G, "id") if sources is None else sources.select(G, "id").distinct()
    scratch = Scratch(nodes.sparkSession, "paths", partitions_for(pair_count(starts, nodes), 1_000_000))
    return scratch.give(block_paths(scratch, starts, edges, weight, width, **blocks))


def pair_count(sources: DataFrame, nodes: DataFrame) -> int:
    """How many rows a table of all sources by all nodes of their graph can have."""
    n = nodes.groupBy(G).agg(F.count(F.lit(1)).alias("_n"))
    k = sources.groupBy(G).agg(F.count(F.lit(1)).alias("_k"))
    return n.join(k, G).agg(F.sum(F.col("_n") * F.col("_k"))).first()[0] or 0


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy(G, "component").agg(F.count(F.lit(1)).alias("component_size"))


def _largest(components: DataFrame) -> DataFrame:
    """(graph_name, component): the largest one per graph, of equal ones that of the smallest id."""
    best = F.min(F.struct((-F.col("component_size")).alias("_s"), "component")).alias("_b")
    return component_sizes(components).groupBy(G).agg(best).select(G, "_b.component")


def average_shortest_path(paths: DataFrame, components: DataFrame) -> DataFrame:
    """Mean distance between the nodes of each graph's largest component; null for a single node."""
    members = components.join(_largest(components), [G, "component"]).select(G, F.col("id").alias("source"))
    inside = paths.join(members, [G, "source"], "left_semi")  # all its paths stay in the component
    mean = inside.groupBy(G).agg(F.avg(F.when(F.col("source") != F.col("node"), F.col("dist"))).alias("average_shortest_path"))
    return components.select(G).distinct().join(mean, G, "left")


def _closeness(nodes, per):
    """Closeness from (graph_name, id, reached, total), with the share of reachable nodes as a factor."""
    sizes = nodes.groupBy(G).agg(F.count(F.lit(1)).alias("_n"))
    value = F.when((F.col("total") > 0) & (F.col("_n") > 1), F.col("reached") / F.col("total") * F.col("reached") / (F.col("_n") - 1)).otherwise(0.0)
    return nodes.select(G, "id").join(per, [G, "id"], "left").join(sizes, G).select(G, "id", F.coalesce(value, F.lit(0.0)).alias("closeness_centrality"))


def closeness(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Closeness with the share of reachable nodes as a factor."""
    return _closeness(nodes, paths.groupBy(G, F.col("node").alias("id")).agg((F.count(F.lit(1)) - 1).alias("reached"), F.sum("dist").alias("total")))


def distance_profile(nodes: DataFrame, edges: DataFrame, weight: str = "distance", bands: float = 4.0, lg_k: int = 12, exact_nodes: int = EXACT_NODES, exact_links: int = EXACT_LINKS) -> DataFrame:
    """(graph_name, id, reached, total): per node, how many nodes it reaches and their summed distance, in bands of length.

    The bounded route beside all pairs. A node's ball of t bands is the union of its own last ball
    and of its neighbours' balls that are the link's length shorter. ``bands`` is the number of
    bands in a graph's mean link; lengths are rounded to bands, at least one.

    Graphs of at most ``exact_nodes`` nodes and ``exact_links`` edges keep balls as bits, one per
    node, which are no larger than a sketch there: links are packed once and a task runs all
    rounds for a strip of the nodes that balls hold (``blocks.ball_sums``). In larger graphs a
    ball is a mergeable distinct-count sketch (HyperLogLog, 2^lg_k registers); the state is one
    sketch per node and band that changed it, never pairs, and only balls that grew are sent on.

    Error: bits count exactly; a sketch's relative standard error is 1.04 / sqrt(2^lg_k) (1.6 % by
    default; counts up to a few hundred are exact). Rounding adds at most half a band per link of
    a path, and up to a whole one on links shorter than half a band.
    """
    per = lambda t: t.groupBy(G).agg(F.count(F.lit(1)).alias("_n"))
    members = nodes.select(G, "id").distinct()
    band = edges.groupBy(G).agg((F.avg(weight) / bands).alias("_band"), F.count(F.lit(1)).alias("_m"), F.max(weight).alias("_most"))
    outer = Scratch(nodes.sparkSession, "bands")
    facts = outer.put("facts", per(members).join(band, G, "left").select(
        G, "_n", _band_size().alias("_size"), (F.col("_band").isNotNull()).alias("_linked"), "_most",
        ((F.col("_n") <= exact_nodes) & (F.coalesce("_m", F.lit(0)) <= exact_links)).alias("_exact")))
    few = members.join(facts.filter("_exact").select(G), G, "left_semi")
    exact = ball_sums(Scratch(nodes.sparkSession, "balls", partitions_for(edges.count(), 1_000_000)), few, edges, facts.filter("_exact and _linked"), weight)
    sums = few.join(exact, [G, "id"], "left").join(facts, G).select(
        G, "id", F.coalesce("reached", F.lit(0)).alias("reached"), (F.coalesce("bands", F.lit(0)) * F.when(F.col("_linked"), F.col("_size")).otherwise(0.0)).alias("total"))
    large = facts.filter("not _exact").select(G)
    if not large.isEmpty():
        sums = sums.unionByName(_sketched_profile(nodes.join(large, G, "left_semi"), edges.join(large, G, "left_semi"), weight, bands, lg_k))
    out = outer.put("profile", sums)
    outer.close(out)
    return outer.give(out)


def _band_size():
    return F.when(F.col("_band") > 0, F.col("_band")).otherwise(1.0)


def _sketched_profile(nodes, edges, weight, bands, lg_k):
    """``distance_profile`` with a sketch per ball."""
    scratch = Scratch(nodes.sparkSession, "profile", partitions_for(nodes.count(), 10_000))
    both = both_ways(edges, weight).filter(F.col(weight).isNotNull())
    band = edges.groupBy(G).agg((F.avg(weight) / bands).alias("_band"))
    size = _band_size()
    scaled = both.join(band, G).select(G, "src", "dst", F.greatest(F.lit(1), F.round(F.col(weight) / size)).cast("int").alias("w"))
    links = Adjacency(scratch, scaled.groupBy(G, "src", "dst").agg(F.min("w").alias("w")))
    ball = scratch.put("ball", nodes.select(G, F.col("id").alias("node")).groupBy(G, "node").agg(F.hll_sketch_agg(F.xxhash64("node"), F.lit(lg_k)).alias("ball"))
                       .withColumn("count", F.lit(1)).withColumn("total", F.lit(0).cast("long")).withColumn("_grew", F.lit(True)))
    waiting, t = None, 0
    while True:
        grown = ball.filter("_grew").select(G, F.col("node").alias("src"), "ball")
        sent = links.meet(grown).select(G, F.col("dst").alias("node"), (F.col("w") + t).alias("due"), "ball")
        every = sent if waiting is None else sent.unionByName(waiting.filter(F.col("due") > t))
        # Balls that reach a node at one time merge before they wait.
        seen = Observation()
        every = every.groupBy(G, "node", "due").agg(F.hll_union_agg("ball").alias("ball")).observe(seen, F.min("due").alias("due"))
        merged = scratch.put("waiting", every)
        scratch.drop(waiting)
        waiting = merged
        t = seen.get["due"]
        if t is None:
            break
        now = waiting.filter(F.col("due") == t).select(G, "node", F.col("ball").alias("_new"))
        both_balls = F.when(F.col("_new").isNotNull(), F.hll_union("ball", "_new")).otherwise(F.col("ball"))
        joined = ball.join(now, [G, "node"], "left").select(G, "node", both_balls.alias("ball"), F.col("count").alias("_old"), "total", F.col("_new").isNotNull().alias("_met"))
        counted = joined.withColumn("count", F.when(F.col("_met"), F.greatest("_old", F.hll_sketch_estimate("ball").cast("int"))).otherwise(F.col("_old")))
        grew = F.col("count") > F.col("_old")
        new = scratch.put("ball", counted.select(G, "node", "ball", "count", (F.col("total") + F.lit(t) * (F.col("count") - F.col("_old"))).alias("total"), grew.alias("_grew")))
        scratch.drop(ball)
        ball = new
    out = scratch.put("profile", ball.join(band, G, "left").select(G, F.col("node").alias("id"), (F.col("count") - 1).cast("long").alias("reached"), (F.col("total") * F.coalesce(size, F.lit(0.0))).alias("total")))
    scratch.close(out)
    return scratch.give(out)


def closeness_estimated(nodes: DataFrame, profile: DataFrame) -> DataFrame:
    """Closeness from ``distance_profile``."""
    return _closeness(nodes, profile)


def average_shortest_path_estimated(profile: DataFrame, components: DataFrame) -> DataFrame:
    """Mean distance in each graph's largest component from ``distance_profile``; null for a single node."""
    members = components.join(_largest(components), [G, "component"]).select(G, "id")
    sums = profile.join(members, [G, "id"]).groupBy(G).agg(F.try_divide(F.sum("total"), F.sum("reached")).alias("average_shortest_path"))
    return components.select(G).distinct().join(sums, G, "left")


def _depth_of_ties(paths, dag, ties, scratch):
    """(graph_name, source, node, depth): how many edges of distance 0 in a row lead to a node.

    The source and nodes that an edge of positive length reaches have depth 0, others one more
    than the shallowest neighbour at distance 0.
    """
    key = [G, "source", "node"]
    reached = dag.filter("not _tie").select(G, "source", F.col("dst").alias("node"))
    known = scratch.put("depth", paths.filter("source = node").select(*key).unionByName(reached).distinct().withColumn("depth", F.lit(0)))
    front = known
    while not front.isEmpty():
        step = ties.join(front.withColumnRenamed("node", "src"), [G, "source", "src"]).groupBy(G, "source", F.col("dst").alias("node")).agg((F.min("depth") + 1).alias("depth"))
        front = scratch.put("front", step.join(known, key, "left_anti"))
        known = scratch.put("depth", known.unionByName(front))
    return known


def shortest_path_links(names: DataFrame, links: DataFrame, paths: DataFrame, scratch: Scratch, cells: int = CELLS) -> tuple:
    """(reach, dag): ``paths`` by node numbers and the links (graph_name, part, source, src, dst) on shortest paths from each source, an acyclic graph.

    An edge of distance 0 joins nodes of one distance; it counts in the direction away from the
    nodes that edges of positive length reach (see ``_depth_of_ties``), so no cycle is left.
    """
    reach, dag = tight_links(scratch, names, links, paths, cells)
    ties = dag.filter("_tie").drop("_tie")
    if ties.isEmpty():
        return reach, dag.drop("_tie")
    depth = _depth_of_ties(reach, dag, ties.drop("part"), scratch)
    deeper = ties.join(depth.withColumnRenamed("node", "src").withColumnRenamed("depth", "_a"), [G, "source", "src"]).join(
        depth.withColumnRenamed("node", "dst").withColumnRenamed("depth", "_b"), [G, "source", "dst"]
    ).filter("_b > _a").select(G, "part", "source", "src", "dst")
    return reach, scratch.put("acyclic", dag.filter("not _tie").drop("_tie").unionByName(deeper))


def _flow(scratch, links, starts, offset):
    """(graph_name, source, node, x) after ``x`` has run along the acyclic ``links`` (..., src, dst, c) from ``starts``.

    A node's x is ``offset`` plus the sum of c * x over its incoming links, so it is ready when
    all of them have arrived. Each hop sends the frontier of ready nodes on; what has arrived at
    nodes that are not ready waits. Every link is used once.
    """
    into = links.groupBy(G, "source", "dst").agg(F.count(F.lit(1)).alias("_in"))
    table = Adjacency(scratch, links.join(into, [G, "source", "dst"]), "source")
    front, waiting, done = scratch.put("front", starts.select(G, "source", "node", "x")), None, []
    while True:
        done.append(front)
        sent = table.meet(front.withColumnRenamed("node", "src")).groupBy(G, "source", F.col("dst").alias("node")).agg(
            F.sum(F.col("c") * F.col("x")).alias("x"), F.count(F.lit(1)).alias("_got"), F.max("_in").alias("_in"))
        both = sent if waiting is None else sent.unionByName(waiting).groupBy(G, "source", "node").agg(F.sum("x").alias("x"), F.sum("_got").alias("_got"), F.max("_in").alias("_in"))
        seen, ready = Observation(), F.col("_got") == F.col("_in")
        step = scratch.put("hop", both.observe(seen, F.count_if(ready).alias("ready"), F.count_if(~ready).alias("open")))
        previous, waiting = waiting, step.filter(~ready) if seen.get["open"] else None
        if not seen.get["ready"]:
            break
        front = step.filter(ready).select(G, "source", "node", (F.col("x") + offset).alias("x"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    out = scratch.put("flow", out)
    scratch.drop(table.table)
    return out


def _dependencies(scratch, names, links, paths, cells, local_links):
    """(graph_name, id, sum): how much of the shortest paths from the sources in ``paths`` goes through each node.

    Sources with at most ``local_links`` links on their shortest paths are summed a few at a
    time, each by one task; if one has more, all run hop by hop through joins.
    """
    key = [G, "source"]
    reach, dag = shortest_path_links(names, links, paths, scratch, cells)
    most = dag.groupBy(*key).agg(F.count(F.lit(1)).alias("_d")).agg(F.max("_d")).first()[0] or 0
    if most <= local_links:
        return dependency_sums(dag).join(names.select(G, "num", "id"), [G, "num"]).select(G, "id", "_b")
    dag = dag.drop("part")
    at_source = reach.filter("source = node").select(G, "source", "node", F.lit(1.0).alias("x"))
    sigma = _flow(scratch, dag.withColumn("c", F.lit(1.0)), at_source, 0.0)
    back = (
        dag.join(sigma.select(*key, F.col("node").alias("src"), F.col("x").alias("_u")), [*key, "src"])
        .join(sigma.select(*key, F.col("node").alias("dst"), F.col("x").alias("_v")), [*key, "dst"])
        .select(*key, F.col("dst").alias("src"), F.col("src").alias("dst"), (F.col("_u") / F.col("_v")).alias("c"))
    )
    ends = reach.select(*key, "node").join(dag.select(*key, F.col("src").alias("node")).distinct(), [*key, "node"], "left_anti").withColumn("x", F.lit(1.0))
    delta = _flow(scratch, back, ends, 1.0)
    sums = delta.filter("source <> node").groupBy(G, F.col("node").alias("num")).agg(F.sum(F.col("x") - 1.0).alias("_b"))
    return sums.join(names.select(G, "num", "id"), [G, "num"]).select(G, "id", "_b")


def betweenness(nodes: DataFrame, edges: DataFrame, paths: DataFrame = None, weight: str = "distance", samples: int = None, seed: int = 42, state_rows: int = STATE_ROWS, cells: int = CELLS,
                block_nodes: int = BLOCK_NODES, block_links: int = TIGHT_LINKS, local_links: int = LOCAL_LINKS) -> DataFrame:
    """Share of shortest paths through each node, weighted, normalised, end points excluded.

    Brandes' sums in batches of sources: a batch holds as many sources as keep sources x nodes
    near ``state_rows``, its distances and path counts are dropped before the next one, and only
    one number per node is carried on. ``paths`` are distances already at hand; without them each
    batch finds its own. With ``samples`` about that many sources per graph are drawn by hash
    (Brandes-Pich) and the sums scaled up by the share drawn; the standard error of a node's value
    then falls with the square root of the number drawn.

    The links on shortest paths are found on blocks of nodes (``blocks.tight_links``), so a row
    is made per source and such link, not per source and link.
    """
    scratch = Scratch(nodes.sparkSession, "between")
    sizes = scratch.put("sizes", nodes.groupBy(G).agg(F.count(F.lit(1)).cast("double").alias("_n")))
    sources = nodes.select(G, "id")
    if samples is not None:
        lot = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        sources = sources.join(sizes, G).filter(lot < F.lit(float(samples)) / F.col("_n")).select(G, "id")
    sources = scratch.put("sources", sources)
    drawn = scratch.put("drawn", sources.groupBy(G).agg(F.count(F.lit(1)).alias("_k")))
    need = pair_count(sources, nodes)
    batches = max(1, -(-need // state_rows))
    sums = None
    outer = Scratch(nodes.sparkSession, "blocks", partitions_for(edges.count()))
    names, links = numbered_links(outer, nodes, edges.select(G, "src", "dst", weight), weight, block_nodes, block_links)
    for b in range(batches):
        inner = Scratch(nodes.sparkSession, "batch", partitions_for(min(need, state_rows)))
        part = sources.filter(F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(batches)) == b)
        if paths is None:
            reach = inner.put("reach", shortest_paths(nodes, edges, weight, part))
        else:
            reach = inner.put("reach", paths.join(part.withColumnRenamed("id", "source"), [G, "source"], "left_semi"))
        own = inner.put("own", _dependencies(inner, names, links, reach, cells, local_links))
        total = own if sums is None else own.unionByName(sums).groupBy(G, "id").agg(F.sum("_b").alias("_b"))
        previous, sums = sums, scratch.put("sums", total)
        scratch.drop(previous)
        inner.close()
    outer.close()
    scratch.close(sums, sizes, drawn)
    n = F.col("_n")
    value = F.try_divide(F.coalesce("_b", F.lit(0.0)) * n / F.col("_k"), (n - 1) * (n - 2))
    out = nodes.select(G, "id").join(sums, [G, "id"], "left").join(sizes, G).join(drawn, G, "left")
    return out.select(G, "id", F.coalesce(value, F.lit(0.0)).alias("betweenness_centrality"))
