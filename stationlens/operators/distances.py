"""Quantiles of all pair distances without all pairs."""

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlens.scratch import Scratch, partitions_for

DEPTH = 24
BINS = 4096
RANGE_ROWS = 200_000
FEW_PLACES = 5_000_000


def _cells(points, level):
    """Cells of a level: place in the grid, number of stations and of their places, and the box around them."""
    at = [F.shiftright(F.col(c), DEPTH - level).alias(c) for c in ("cx", "cy")]
    return points.select(*at, "x", "y", "n").groupBy("cx", "cy").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("p"), F.min("x").alias("x1"), F.max("x").alias("x2"), F.min("y").alias("y1"), F.max("y").alias("y2"))


def _measured(pairs):
    """Cell pairs with the number of station pairs they hold and the least and greatest distance of those."""
    near = lambda c: F.greatest(F.lit(0.0), F.col(f"b.{c}1") - F.col(f"a.{c}2"), F.col(f"a.{c}1") - F.col(f"b.{c}2"))
    wide = lambda c: F.greatest(F.col(f"b.{c}2") - F.col(f"a.{c}1"), F.col(f"a.{c}2") - F.col(f"b.{c}1"))
    length = lambda dx, dy: F.sqrt(dx * dx + dy * dy)
    alone = (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy"))
    n = F.when(alone, F.col("a.n") * (F.col("a.n") - 1) / 2).otherwise(F.col("a.n") * F.col("b.n")).cast("long")
    places = F.when(alone, F.col("a.p") * (F.col("a.p") + 1) / 2).otherwise(F.col("a.p") * F.col("b.p")).cast("long")
    return pairs.select("a", "b", n.alias("n"), places.alias("places"), length(near("x"), near("y")).alias("least"), length(wide("x"), wide("y")).alias("most")).filter("n > 0")


def _split(pairs, points, level, deeper):
    """The pairs of the cells ``deeper`` levels down, each unordered pair once."""
    kids = _cells(points, level + deeper)
    kid = F.struct("cx", "cy", "n", "p", "x1", "x2", "y1", "y2")
    up = lambda side: kids.select(F.shiftright("cx", deeper).alias(f"{side}x"), F.shiftright("cy", deeper).alias(f"{side}y"), kid.alias(f"k{side}"))
    keyed = pairs.select(*[F.col(f"{s}.c{c}").alias(f"{s}{c}") for s in "ab" for c in "xy"])
    both = keyed.join(up("a"), ["ax", "ay"]).join(up("b"), ["bx", "by"])
    apart = (F.col("ax") != F.col("bx")) | (F.col("ay") != F.col("by"))
    ordered = F.struct("ka.cx", "ka.cy") <= F.struct("kb.cx", "kb.cy")
    return _measured(both.filter(apart | ordered).select(F.col("ka").alias("a"), F.col("kb").alias("b")))


def _bounds(pairs, ranks, base, low, high):
    """(from, to) around the distance of each rank, from histograms of the least and greatest distances."""
    width = (high - low) / BINS or 1.0
    bin_of = lambda c: F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((F.col(c) - low) / width))).cast("int")
    sides = F.explode(F.array(*[F.struct(F.lit(c).alias("side"), bin_of(c).alias("bin")) for c in ("least", "most")])).alias("s")
    rows = pairs.select("n", sides).groupBy("s.side", "s.bin").agg(F.sum("n").alias("n")).collect()  # two histograms of fixed size
    counts = {c: np.zeros(BINS, dtype=object) for c in ("least", "most")}
    for r in rows:
        counts[r["side"]][r["bin"]] = r["n"]
    out = []
    for rank, below in zip(ranks, base):
        i = int(np.argmax(np.cumsum(counts["least"]) > rank - below))
        j = int(np.argmax(np.cumsum(counts["most"]) > rank - below))
        # A bin edge, and a bin more against rounding; the outer bins are open.
        out.append((-math.inf if i < 2 else low + (i - 1) * width, math.inf if j > BINS - 3 else low + (j + 2) * width))
    return out


def _at_ranks(scratch, values, ranks):
    """The values at 0-based ``ranks`` of the table ``values`` (d, n), where d counts n times."""
    n = values.count()
    ranged = scratch.put("ranged", values.repartitionByRange(max(1, -(-n // RANGE_ROWS)), "d").withColumn("part", F.spark_partition_id()))
    parts = sorted(ranged.groupBy("part").agg(F.sum("n").alias("n")).collect(), key=lambda r: r["part"])  # one row per range
    starts, at = {}, 0
    for r in parts:
        starts[r["part"]] = (at, at + r["n"])
        at += r["n"]
    wanted = [(k, next(p for p, (a, b) in starts.items() if a <= k < b)) for k in ranks]
    start = F.create_map(*[F.lit(x) for p in {p for _, p in wanted} for x in (p, starts[p][0])])
    some = ranged.filter(F.col("part").isin([p for _, p in wanted]))
    running = some.withColumn("to", F.sum("n").over(Window.partitionBy("part").orderBy("d")) + start[F.col("part")])
    hit = F.lit(False)
    for k, p in wanted:
        hit = hit | ((F.col("part") == p) & (F.col("to") > k) & (F.col("to") - F.col("n") <= k))
    found = running.filter(hit).select("d", "n", "to").collect()
    return [next(r["d"] for r in found if r["to"] - r["n"] <= k < r["to"]) for k, _ in wanted]


def pair_distance_quantiles(coords: DataFrame, probs=(0.10, 0.25, 0.50, 0.75)) -> DataFrame:
    """(quantile, distance_m, threshold_m): exact quantiles of the distances of all pairs of stations, and their half-even rounding.

    Rank selection on a grid. Pairs of cells carry the number of their station pairs and bounds of
    their distance; histograms of the bounds give an interval around the distance of each wanted
    rank. Pairs of cells wholly outside all intervals are counted and dropped, the rest is split
    into smaller cells. When few station pairs are left or splitting no longer drops much, the
    stations of the remaining cells are paired and the wanted ranks picked from those. Stations at one place count as one point
    with a number. For evenly spread stations the work grows with n^1.5 instead of n^2.

    Stations without a position are left out; fewer than two give null distances.
    """
    spark = coords.sparkSession
    scratch = Scratch(spark, "distances", partitions_for(coords.count(), 1_000))  # the pairs in hand grow faster than stations
    places = coords.filter("utm_x is not null and utm_y is not null").groupBy(F.col("utm_x").cast("double").alias("x"), F.col("utm_y").cast("double").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    box = places.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y"), F.sum("n"), F.count(F.lit(1))).first()
    x1, x2, y1, y2, stations, n_places = box
    pairs_in_all = (stations or 0) * ((stations or 0) - 1) // 2
    schema = "quantile double, distance_m double, threshold_m int"
    if not pairs_in_all:
        return spark.createDataFrame([(float(p), None, None) for p in probs], schema)
    side = max(x2 - x1, y2 - y1) or 1.0
    cell = lambda c, low: F.least(F.lit((1 << DEPTH) - 1), F.floor((F.col(c) - low) / side * (1 << DEPTH))).cast("int")
    points = scratch.put("points", places.select(cell("x", x1).alias("cx"), cell("y", y1).alias("cy"), "x", "y", "n"))
    spots = [p * (pairs_in_all - 1) for p in probs]
    ranks = sorted({f(s) for s in spots for f in (math.floor, math.ceil)})
    base, level, low, high = [0] * len(ranks), 0, 0.0, math.hypot(x2 - x1, y2 - y1)
    whole = F.struct("cx", "cy", "n", "p", "x1", "x2", "y1", "y2")
    pairs = _measured(_cells(points, 0).select(whole.alias("a"), whole.alias("b")))
    while level < DEPTH:
        deeper = min(3 if level < 3 else 1, DEPTH - level)
        split = scratch.put("split", _split(pairs, points, level, deeper))
        level += deeper
        around = _bounds(split, ranks, base, low, high)
        open_ = F.lit(False)
        for a, b in around:
            open_ = open_ | ((F.col("least") <= b) & (F.col("most") >= a))
        facts = split.agg(F.sum(F.when(open_, F.col("places"))).alias("places"), F.count_if(open_).alias("pairs"), *[F.sum(F.when(~open_ & (F.col("most") < a), F.col("n")).otherwise(0)).alias(f"b{i}") for i, (a, _) in enumerate(around)]).first()
        base = [b + facts[f"b{i}"] for i, b in enumerate(base)]
        previous, pairs = pairs, scratch.put("pairs", split.filter(open_).select("a", "b"))
        scratch.drop(split, previous)
        finite = [v for a, b in around for v in (a, b) if math.isfinite(v)]
        low, high = (min(finite), max(finite)) if all(math.isfinite(v) for a, b in around for v in (a, b)) else (low, high)
        if facts["places"] <= max(FEW_PLACES, 16 * n_places, 2 * facts["pairs"]):
            break
    at = points.select(F.shiftright("cx", DEPTH - level).alias("cx"), F.shiftright("cy", DEPTH - level).alias("cy"), F.struct("x", "y", "n").alias("p"))
    side_of = lambda s: at.select(F.col("cx").alias(f"{s}x"), F.col("cy").alias(f"{s}y"), F.col("p").alias(f"p{s}"))
    keyed = pairs.select(*[F.col(f"{s}.c{c}").alias(f"{s}{c}") for s in "ab" for c in "xy"])
    both = keyed.join(side_of("a"), ["ax", "ay"]).join(side_of("b"), ["bx", "by"])
    alone = (F.col("ax") == F.col("bx")) & (F.col("ay") == F.col("by"))
    same = F.col("pa") == F.col("pb")
    order = F.struct("pa.x", "pa.y") <= F.struct("pb.x", "pb.y")
    n = F.when(alone & same, (F.col("pa.n") * (F.col("pa.n") - 1) / 2).cast("long")).otherwise(F.col("pa.n") * F.col("pb.n"))
    dx, dy = F.col("pa.x") - F.col("pb.x"), F.col("pa.y") - F.col("pb.y")
    values = both.filter(~alone | order).select(F.sqrt(dx * dx + dy * dy).alias("d"), n.alias("n")).filter("n > 0").groupBy("d").agg(F.sum("n").alias("n"))
    found = dict(zip(ranks, _at_ranks(scratch, scratch.put("values", values), [r - b for r, b in zip(ranks, base)])))
    scratch.close()
    rows = []
    for p, s in zip(probs, spots):
        a, b = found[math.floor(s)], found[math.ceil(s)]
        rows.append((float(p), a + (s - math.floor(s)) * (b - a), None))
    return spark.createDataFrame(rows, schema).withColumn("threshold_m", F.bround("distance_m", 0).cast("int"))
