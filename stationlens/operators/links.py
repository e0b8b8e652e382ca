"""Links of graphs as a table that iterative operators read round after round."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlens.scratch import Scratch

G = "graph_name"
BUCKET_LINKS = 100_000
HUB_LINKS = 50_000
MAX_BUCKETS = 10_000


def both_ways(edges: DataFrame, *weights: str) -> DataFrame:
    """Each undirected edge in both directions."""
    a = edges.select(G, "src", "dst", *weights)
    b = edges.select(G, F.col("dst").alias("src"), F.col("src").alias("dst"), *weights)
    return a.unionAll(b)


class Adjacency:
    """Directed links (graph_name, src, part, dst, ...) bucketed by their first end.

    Written once, so a round moves its state to the links and never the links. A node with more
    than ``hub_links`` of them has its links dealt over parts, each a bucket key of its own, and
    its state goes to every part.
    """

    def __init__(self, scratch: Scratch, links: DataFrame, *keys: str, bucket_links: int = BUCKET_LINKS, hub_links: int = HUB_LINKS):
        self.keys = [G, *keys, "src"]
        counts = scratch.put("degrees", links.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_d")))
        total = counts.agg(F.sum("_d").alias("n"), F.max("_d").alias("most")).first()
        self.buckets = min(MAX_BUCKETS, max(1, (total.n or 0) // bucket_links))
        self.hubs = None
        if (total.most or 0) > hub_links:
            self.hubs = scratch.put("hubs", counts.filter(F.col("_d") > hub_links).select(*self.keys, F.ceil(F.col("_d") / hub_links).cast("int").alias("_parts")))
            spread = F.coalesce("_parts", F.lit(1))
            links = links.join(self.hubs, self.keys, "left").withColumn("part", F.pmod(F.xxhash64("dst"), spread).cast("int")).drop("_parts")
        else:
            links = links.withColumn("part", F.lit(0))
        self.table = scratch.bucketed("links", links, self.buckets, *self.keys, "part")
        scratch.drop(counts)

    def meet(self, state: DataFrame) -> DataFrame:
        """``state`` (keyed like the links' first end) joined with the links of each of its rows.

        A bucket's part of the state is a hash map, at most one row per link there, so that no
        round sorts the links.
        """
        if self.hubs is None:
            state = state.withColumn("part", F.lit(0))
        else:
            parts = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
            state = state.join(self.hubs, self.keys, "left").withColumn("part", parts).drop("_parts")
        return state.hint("shuffle_hash").join(self.table, [*self.keys, "part"]).drop("part")
