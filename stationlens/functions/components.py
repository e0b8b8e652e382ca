"""Connected components by contraction of links."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlens.session import checkpointed

STAR_LINKS = 1 << 20


def _coded(column):
    """(codes, values) of an array; null is a value of its own."""
    known = pc.dictionary_encode(column, null_encoding="encode")
    known = known.combine_chunks() if isinstance(known, pa.ChunkedArray) else known
    return known.indices.to_numpy(zero_copy_only=False).astype(np.int64), known.dictionary


def least_ends(a, b, n):
    """Per vertex of 0..n-1 the smallest vertex that the links a-b join it to."""
    label = np.arange(n)
    while a.size:
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        a, b = label[a], label[b]
        open_ = a != b
        a, b = a[open_], b[open_]
    return label


def _stars(batches):
    held, size = [], 0

    def rows():
        t = pa.Table.from_batches(held)
        group, groups = _coded(t.column(0))
        ends, ids = _coded(pa.chunked_array([*t.column(1).chunks, *t.column(2).chunks]))
        vertices, at = np.unique(np.concatenate([group, group]) * len(ids) + ends, return_inverse=True)
        label = least_ends(at[:size], at[size:], len(vertices))
        out = np.flatnonzero(label != np.arange(len(vertices)))
        a, b = vertices[out], vertices[label[out]]
        cells = [groups.take(pa.array(a // len(ids))), ids.take(pa.array(a % len(ids))), ids.take(pa.array(b % len(ids)))]
        yield pa.RecordBatch.from_arrays(cells, schema=t.schema)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= STAR_LINKS:
            yield from rows()
            held, size = [], 0
    if size:
        yield from rows()


def starred(links: DataFrame) -> DataFrame:
    """Links (group, a, b) that join the same vertices: of each million, one per vertex to the first of its component there."""
    return links.mapInArrow(_stars, links.schema)


def contract_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(id, label): one row per end of a link; ends that links connect share a label.

    Each round maps every vertex to the vertex of smallest hash around it, then to that one's
    own choice, and replaces both ends of each link by their images; links inside an image
    vanish. A constant share of the vertices goes with each round, so rounds grow with the
    logarithm of their number, for chains as for stars. Images of equal links collapse before
    the next round. Labels are vertices of their component, the same for all of its members.
    """
    a, b = F.col(left), F.col(right)
    edges = checkpointed(links.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).filter("u is not null and v is not null").distinct())
    ends = edges.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    labels = ends.select("id", F.col("id").alias("label"))
    edges = edges.filter("u <> v")
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min(F.struct(F.xxhash64("v").alias("h"), F.col("v").alias("v"))).alias("m"))
        own = F.struct(F.xxhash64("u").alias("h"), F.col("u").alias("v"))
        step = checkpointed(near.select("u", F.least("m", own)["v"].alias("p")))
        jump = step.select(F.col("u").alias("p"), F.col("p").alias("q"))
        image = checkpointed(step.join(jump, "p").select("u", F.col("q").alias("p")))
        x, y = image.select("u", F.col("p").alias("pu")), image.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        moved = edges.join(x, "u").join(y, "v").filter("pu <> pv")
        edges = checkpointed(moved.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct())
        labels = labels.join(image.select(F.col("u").alias("label"), "p"), "label", "left").select("id", F.coalesce("p", "label").alias("label"))
        labels = checkpointed(labels)
    return labels
