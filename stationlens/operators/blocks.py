"""Graphs as blocks: distances and links as arrays of bounded size that Spark joins and merges."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from stationlens.operators.links import G, both_ways
from stationlens.scratch import Scratch

CELLS = 1 << 20
BLOCK_NODES = 8192
BLOCK_LINKS = 1 << 19
TILE = 128
LONG_RUN = 48
TRIANGLE_NODES = 1024
TIGHT_LINKS = 1 << 20
PLACE_BITS = 20
PART_SOURCES = 16
PACK_LINKS = 1 << 19
BALL_BYTES = 1 << 27
STATE = "graph_name string, strip int, block int, n_sources int, n_nodes int, n_blocks int, step double, dist binary, due binary, low double"
MATRIX = "graph_name string, row int, col int, n_row int, n_col int, cells binary"
LINKS = "graph_name string, block int, to int, n_to int, src binary, dst binary, w binary"
DIST = "graph_name string, strip int, block int, n_sources int, n_nodes int, dist binary"
TIGHT = "graph_name string, part int, source long, src long, dst long, _tie boolean"


_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_BATCH_KEYS = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")


def session_for_blocks(scratch: Scratch, rows: int = 8) -> None:
    """Rows of a few megabytes are read and handed to Python a few at a time."""
    for key in _BATCH_KEYS:
        scratch.spark.conf.set(key, str(rows))


def session_for_rows(scratch: Scratch) -> None:
    """Plain rows again in batches of the usual size."""
    for key in _BATCH_KEYS:
        scratch.spark.conf.unset(key)


def numbered(ids: DataFrame, facts: DataFrame) -> DataFrame:
    """(graph_name, id, block, pos, n_nodes, n_blocks) from distinct (graph_name, id); ``facts`` has a graph's ``n_blocks``."""
    block = F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int")
    placed = ids.join(facts.select(G, "n_blocks"), G).withColumn("block", block)
    inside = Window.partitionBy(G, "block")
    return placed.withColumn("pos", (F.row_number().over(inside.orderBy("id")) - 1).cast("int")).withColumn("n_nodes", F.count(F.lit(1)).over(inside).cast("int"))


def _rows(batches, *columns):
    """Rows of record batches as tuples; binary cells are buffers."""
    for batch in batches:
        cells = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        for k in range(batch.num_rows):
            yield tuple(c[k].as_buffer() if pa.types.is_binary(c.type) and c[k].is_valid else c[k].as_py() for c in cells)


def _batch(schema, **values):
    return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)


_TYPES = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
_schema = lambda text: pa.schema([(n, _TYPES[t]) for n, t in (c.split() for c in text.split(", "))])


def _bits(packed, shape):
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=shape[0] * shape[1]).reshape(shape).astype(bool)


def _low(dist, due):
    return float(dist[due].min()) if due.any() else None


def relax(dist, due, src, dst, w, size):
    """Least distances (node, source) one link further from the entries that are due; infinite elsewhere.

    Links come ordered by ``dst``. Sources are taken in tiles and links in runs that fit a
    processor's cache; links whose first end has nothing due in a tile are left out.
    """
    out = np.full((size, dist.shape[1]), np.inf)
    for a in range(0, dist.shape[1], TILE):
        some = due[:, a:a + TILE]
        picked = np.flatnonzero(some.any(axis=1)[src])
        if not picked.size:
            continue
        at = np.where(some, dist[:, a:a + TILE], np.inf)
        s, d, x, part = src[picked], dst[picked], w[picked], out[:, a:a + TILE]
        first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        if len(s) >= LONG_RUN * len(first):
            room = np.empty((int(np.diff(np.r_[first, len(s)]).max()), at.shape[1]))
            for b, c in zip(first, np.r_[first[1:], len(s)]):
                far = np.take(at, s[b:c], axis=0, out=room[:c - b], mode="clip")
                far += x[b:c, None]
                part[d[b]] = far.min(axis=0)
            continue
        for b in range(0, len(s), 1024):
            ends = d[b:b + 1024]
            first = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
            far = at[s[b:b + 1024]]
            far += x[b:b + 1024, None]
            part[ends[first]] = np.minimum(part[ends[first]], np.minimum.reduceat(far, first, axis=0))
    return out


def _link_block(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(list(batches))
    src, dst, w = (t.column(c).to_numpy() for c in ("src", "dst", "w"))
    order = np.lexsort((src, dst))
    yield _batch(_schema(LINKS), graph_name=key[0].as_py(), block=key[1].as_py(), to=key[2].as_py(), n_to=t.column("n_to")[0].as_py(),
                 src=src[order].astype(np.int32).tobytes(), dst=dst[order].astype(np.int32).tobytes(), w=w[order].astype(np.float64).tobytes())


def _start_block(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(list(batches))
    n_sources, n_nodes, n_blocks, step = (t.column(c)[0].as_py() for c in ("n_sources", "n_nodes", "n_blocks", "step"))
    dist = np.full((n_nodes, n_sources), np.inf)
    dist[t.column("pos").to_numpy(), t.column("row").to_numpy()] = 0.0
    yield _batch(_schema(STATE), graph_name=key[0].as_py(), strip=key[1].as_py(), block=key[2].as_py(), n_sources=n_sources, n_nodes=n_nodes,
                 n_blocks=n_blocks, step=step, dist=dist.tobytes(), due=np.packbits(dist == 0.0).tobytes(), low=0.0)


def _extended(level):
    """Candidates for the blocks that links lead to, from entries within ``level``."""
    def run(batches):
        columns = ("graph_name", "strip", "n_sources", "n_nodes", "n_blocks", "step", "dist", "due", "to", "n_to", "src", "dst", "w")
        for g, strip, n_sources, n_nodes, n_blocks, step, dist, due, to, n_to, src, dst, w in _rows(batches, *columns):
            shape = (n_nodes, n_sources)
            dist = np.frombuffer(dist, np.float64).reshape(shape)
            due = _bits(due, shape) & (np.floor(dist / step) <= level)
            found = relax(dist, due, np.frombuffer(src, np.int32), np.frombuffer(dst, np.int32), np.frombuffer(w, np.float64), n_to)
            if np.isfinite(found).any():
                yield _batch(_schema(STATE), graph_name=g, strip=strip, block=to, n_sources=n_sources, n_nodes=n_to, n_blocks=n_blocks, step=step, dist=found.tobytes())
    return run


def _finished(batches):
    """Blocks of graphs that lie in one block, extended until nothing gets shorter."""
    columns = ("graph_name", "strip", "block", "n_sources", "n_nodes", "n_blocks", "step", "dist", "due", "src", "dst", "w")
    for g, strip, block, n_sources, n_nodes, n_blocks, step, dist, due, src, dst, w in _rows(batches, *columns):
        shape = (n_nodes, n_sources)
        dist, due = np.frombuffer(dist, np.float64).reshape(shape).copy(), _bits(due, shape)
        src, dst, w = np.frombuffer(src, np.int32), np.frombuffer(dst, np.int32), np.frombuffer(w, np.float64)
        while due.any():
            found = relax(dist, due, src, dst, w, n_nodes)
            due = found < dist
            np.minimum(dist, found, out=dist)
        yield _batch(_schema(STATE), graph_name=g, strip=strip, block=block, n_sources=n_sources, n_nodes=n_nodes, n_blocks=n_blocks, step=step,
                     dist=dist.tobytes(), due=np.packbits(due).tobytes())


def _merged(level):
    """A block's old distances (those with ``due``) and its candidates, one batch after the other."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = old = waiting = shape = None
        for n_sources, n_nodes, n_blocks, step, dist, due in _rows(batches, "n_sources", "n_nodes", "n_blocks", "step", "dist", "due"):
            shape = (n_nodes, n_sources)
            dist = np.frombuffer(dist, np.float64).reshape(shape)
            if due is not None:
                old, waiting = dist, _bits(due, shape) & (np.floor(dist / step) > level)
            best = dist if best is None else np.minimum(best, dist)
        due = np.isfinite(best) if old is None else (best < old) | waiting
        low = _low(best, due)
        yield _batch(_schema(STATE), graph_name=key[0].as_py(), strip=key[1].as_py(), block=key[2].as_py(), n_sources=shape[1], n_nodes=shape[0], n_blocks=n_blocks,
                     step=step, dist=best.tobytes(), due=np.packbits(due).tobytes(), low=None if low is None else low / step)
    return run


def _reached(batches):
    """(graph_name, source, node, dist) of the reached entries of each block."""
    for batch in batches:
        for k, (g, n_sources, n_nodes, dist) in enumerate(_rows([batch], "graph_name", "n_sources", "n_nodes", "dist")):
            sources, nodes = (batch.column(batch.schema.get_field_index(c))[k].values for c in ("sources", "nodes"))
            dist = np.frombuffer(dist, np.float64).reshape(n_nodes, n_sources)
            for a in range(0, n_sources, TILE):
                node, source = np.nonzero(np.isfinite(dist[:, a:a + TILE]))
                if node.size:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([g] * len(node), pa.string()), sources.take(pa.array(source + a)), nodes.take(pa.array(node)), pa.array(dist[node, source + a])],
                        names=["graph_name", "source", "node", "dist"])


def block_paths(scratch: Scratch, starts: DataFrame, edges: DataFrame, weight: str, width: float = None, cells: int = CELLS, block_nodes: int = BLOCK_NODES, block_links: int = BLOCK_LINKS) -> DataFrame:
    """(graph_name, source, node, dist) from ``starts``; see ``paths.shortest_paths``."""
    session_for_blocks(scratch)
    links = both_ways(edges, weight).select(G, "src", "dst", F.col(weight).cast("double").alias("w")).filter("w is not null and src is not null")
    starts = scratch.put("starts", starts.select(F.col(G).cast("string").alias(G), "id").distinct())
    ends = links.select(G, F.col("src").alias("id")).unionAll(links.select(G, F.col("dst").alias("id")))
    ids = scratch.put("ends", starts.unionByName(ends).distinct())
    count = lambda t, name: t.groupBy(G).agg(F.count(F.lit(1)).alias(name))
    most = links.groupBy(G).agg(F.count(F.lit(1)).alias("_m"), F.max("w").alias("_w"))
    facts = count(ids, "_n").join(count(starts, "_k"), G, "left").join(most, G, "left")
    n_blocks = F.greatest(F.ceil(F.col("_n") / block_nodes), F.ceil(F.sqrt(F.coalesce("_m", F.lit(0)) / block_links)), F.lit(1)).cast("int")
    step = F.when(F.col("_w") > 0, 4 * F.col("_w") if width is None else F.lit(float(width))).otherwise(1.0)
    rows = F.greatest(F.lit(1), F.floor(F.lit(cells) * n_blocks / F.col("_n")))
    facts = scratch.put("facts", facts.select(G, n_blocks.alias("n_blocks"), F.greatest(F.lit(1), F.ceil(F.col("_k") / rows)).cast("int").alias("n_strips"), step.alias("step")))
    names = scratch.put("names", numbered(ids, facts))

    src = names.select(G, F.col("id").alias("src"), "block", F.col("pos").alias("_s"))
    dst = names.select(F.col(G).alias("_g"), F.col("id").alias("_id"), F.col("block").alias("to"), F.col("pos").alias("_d"), F.col("n_nodes").alias("n_to"))
    placed = links.join(src, [G, "src"]).join(dst, (F.col(G) == F.col("_g")) & F.col("dst").eqNullSafe(F.col("_id")))
    placed = placed.select(G, "block", "to", "n_to", F.col("_s").alias("src"), F.col("_d").alias("dst"), "w")
    links = scratch.put("links", placed.groupBy(G, "block", "to").applyInArrow(_link_block, LINKS))

    strip = Window.partitionBy(G, "strip")
    own = names.select(F.col(G).alias("_g"), F.col("id").alias("_id"), "block", "pos", "n_nodes", "n_blocks")
    dealt = starts.join(facts.drop("n_blocks"), G).withColumn("strip", F.pmod(F.xxhash64("id", F.lit(1)), F.col("n_strips")).cast("int"))
    dealt = scratch.put("dealt", dealt.withColumn("row", (F.row_number().over(strip.orderBy("id")) - 1).cast("int")).withColumn("n_sources", F.count(F.lit(1)).over(strip).cast("int")))
    begun = dealt.join(own, (F.col(G) == F.col("_g")) & F.col("id").eqNullSafe(F.col("_id"))).select(G, "strip", "block", "row", "pos", "n_sources", "n_nodes", "n_blocks", "step")
    begun = scratch.put("begun", begun.groupBy(G, "strip", "block").applyInArrow(_start_block, STATE))

    # Graphs of one block without links have nothing to extend.
    single = begun.filter("n_blocks = 1").join(links.drop("n_to", "to").hint("merge"), [G, "block"], "left")
    done = scratch.put("single", single.filter("w is not null").mapInArrow(_finished, STATE).unionByName(single.filter("w is null").select(begun.columns)))
    state, level = scratch.put("state", begun.filter("n_blocks > 1")), 0
    if not state.isEmpty():
        while True:
            sent = state.filter(F.floor("low") <= level).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
            found = sent.join(links.hint("merge"), [G, "block", "to"]).mapInArrow(_extended(level), STATE)
            merged, seen = state.unionByName(found).groupBy(G, "strip", "block").applyInArrow(_merged(level), STATE), Observation()
            previous, state = state, scratch.put("state", merged.observe(seen, F.min(F.floor("low")).alias("level")))
            scratch.drop(previous)
            if seen.get["level"] is None:
                break
            level = seen.get["level"]

    listed = lambda t, key, n, out: t.groupBy(G, key).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(n).alias("p"), "id"))), lambda x: x["id"]).alias(out))
    whole = done.unionByName(state).join(listed(dealt, "strip", "row", "sources"), [G, "strip"]).join(listed(names, "block", "pos", "nodes"), [G, "block"])
    id_type = names.schema["id"].dataType.simpleString()
    paths = scratch.put("paths", whole.mapInArrow(_reached, f"graph_name string, source {id_type}, node {id_type}, dist double"))
    scratch.close(paths)
    return paths


def numbered_links(scratch: Scratch, nodes: DataFrame, edges: DataFrame, weight: str, block_nodes: int = BLOCK_NODES, block_links: int = TIGHT_LINKS) -> tuple:
    """(names, links): the ``numbered`` nodes with one number ``num`` each, and the links of each two blocks as arrays."""
    both = both_ways(edges, weight).select(F.col(G).cast("string").alias(G), "src", "dst", F.col(weight).cast("double").alias("w"))
    both = scratch.put("both", both.filter("w is not null and src is not null and dst is not null"))
    ends = both.select(G, F.col("src").alias("id"))  # both directions, so every end is a first one
    ids = scratch.put("ids", nodes.select(F.col(G).cast("string").alias(G), "id").unionByName(ends).filter("id is not null").distinct())
    n, m = ids.groupBy(G).agg(F.count(F.lit(1)).alias("_n")), both.groupBy(G).agg(F.count(F.lit(1)).alias("_m"))
    n_blocks = F.greatest(F.ceil(F.col("_n") / block_nodes), F.ceil(F.sqrt(F.coalesce("_m", F.lit(0)) / block_links)), F.lit(1)).cast("int")
    facts = n.join(m, G, "left").select(G, "_n", n_blocks.alias("n_blocks"))
    names = numbered(ids, facts).withColumn("num", F.shiftleft(F.col("block").cast("long"), PLACE_BITS) + F.col("pos"))
    names = scratch.put("names", names.join(facts.drop("n_blocks"), G))
    src = names.select(G, F.col("id").alias("src"), "block", F.col("pos").alias("_s"))
    dst = names.select(G, F.col("id").alias("dst"), F.col("block").alias("to"), F.col("pos").alias("_d"), F.col("n_nodes").alias("n_to"))
    placed = both.join(src, [G, "src"]).join(dst, [G, "dst"]).select(G, "block", "to", "n_to", F.col("_s").alias("src"), F.col("_d").alias("dst"), "w")
    links = scratch.put("links", placed.groupBy(G, "block", "to").applyInArrow(_link_block, LINKS))
    scratch.drop(both, ids)
    return names, links


def _dist_block(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    dist = None
    for b in batches:
        pos, row, n_sources, n_nodes, d = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("pos", "row", "n_sources", "n_nodes", "dist"))
        dist = np.full((n_nodes[0], n_sources[0]), np.inf) if dist is None else dist
        dist[pos, row] = d
    yield _batch(_schema(DIST), graph_name=key[0].as_py(), strip=key[1].as_py(), block=key[2].as_py(), n_sources=dist.shape[1], n_nodes=dist.shape[0], dist=dist.tobytes())


def tight(near, far, src, dst, w):
    """(link, source) of the links that end a shortest path: distance ``near`` plus length equals distance ``far``, both finite.

    Links come ordered by ``dst``; sources and links are taken in pieces that fit a processor's cache.
    """
    first = np.flatnonzero(np.r_[True, dst[1:] != dst[:-1]])
    ends = np.r_[first[1:], len(dst)]
    long = len(dst) >= LONG_RUN * len(first)
    for a in range(0, near.shape[1], TILE):
        at, to = np.ascontiguousarray(near[:, a:a + TILE]), far[:, a:a + TILE]
        to = np.where(np.isfinite(to), to, np.nan)
        for b, c in zip(first, ends) if long else zip(range(0, len(src), 1024), range(1024, len(src) + 1024, 1024)):
            step = np.take(at, src[b:c], axis=0)
            step += w[b:c, None]
            hit = step == (to[dst[b]] if long else to[dst[b:c]])
            if hit.any():
                link, source = np.nonzero(hit)
                yield link + b, source + a


def _tight(batches):
    """Rows of ``TIGHT`` from the distances of one strip to two blocks and the links between these."""
    columns = ("graph_name", "strip", "block", "to", "n_sources", "n_nodes", "n_to", "near", "far", "src", "dst", "w")
    for batch in batches:
        for k, (g, strip, block, to, n_sources, n_nodes, n_to, near, far, src, dst, w) in enumerate(_rows([batch], *columns)):
            sources = batch.column(batch.schema.get_field_index("sources"))[k].values.to_numpy()
            src, dst, w = np.frombuffer(src, np.int32), np.frombuffer(dst, np.int32), np.frombuffer(w, np.float64)
            near, far = np.frombuffer(near, np.float64).reshape(n_nodes, n_sources), np.frombuffer(far, np.float64).reshape(n_to, n_sources)
            held, size = [], 0
            for link, source in tight(near, far, src, dst, w):
                held.append((link, source))
                size += len(link)
                if size > 500_000:
                    yield _tight_rows(g, strip, block, to, sources, src, dst, w, held)
                    held, size = [], 0
            if held:
                yield _tight_rows(g, strip, block, to, sources, src, dst, w, held)


def _tight_rows(g, strip, block, to, sources, src, dst, w, held):
    link, source = (np.concatenate(x) for x in zip(*held))
    number = lambda b, pos: (np.int64(b) << PLACE_BITS) + pos.astype(np.int64)
    part = (strip << 16) + source // PART_SOURCES
    return pa.RecordBatch.from_arrays(
        [pa.array([g] * len(link), pa.string()), pa.array(part.astype(np.int32)), pa.array(sources[source]), pa.array(number(block, src[link])), pa.array(number(to, dst[link])), pa.array(w[link] == 0)],
        names=[c.split()[0] for c in TIGHT.split(", ")])


def tight_links(scratch: Scratch, names: DataFrame, links: DataFrame, paths: DataFrame, cells: int = CELLS) -> tuple:
    """(reach, dag): ``paths`` by node numbers, and a row of ``TIGHT`` per source and link on a shortest path.

    A row per link and source is made only where the link lies on a shortest path: distances of a
    strip of sources to the blocks of both ends meet the links between them as arrays. ``part``
    deals the sources of a graph into small groups.
    """
    session_for_rows(scratch)
    number = lambda c: names.select(G, F.col("id").alias(c), F.col("num").alias(f"_{c}"))
    reach = paths.join(number("source"), [G, "source"]).join(number("node"), [G, "node"])
    reach = scratch.put("numbers", reach.select(G, F.col("_source").alias("source"), F.col("_node").alias("node"), "dist"))
    begun = reach.select(G, "source").distinct()
    sizes = names.groupBy(G).agg(F.first("_n").alias("_n"), F.first("n_blocks").alias("n_blocks"))
    rows = F.greatest(F.lit(1), F.floor(F.lit(cells) * F.col("n_blocks") / F.col("_n")))
    strips = begun.groupBy(G).agg(F.count(F.lit(1)).alias("_k")).join(sizes, G).select(G, F.greatest(F.lit(1), F.ceil(F.col("_k") / rows)).cast("int").alias("n_strips"))
    strip = Window.partitionBy(G, "strip")
    dealt = begun.join(strips, G).withColumn("strip", F.pmod(F.xxhash64("source"), F.col("n_strips")).cast("int"))
    dealt = scratch.put("dealt", dealt.withColumn("row", (F.row_number().over(strip.orderBy("source")) - 1).cast("int")).withColumn("n_sources", F.count(F.lit(1)).over(strip).cast("int")))
    pos = F.col("node").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
    placed = reach.join(dealt, [G, "source"]).select(G, "strip", "row", "n_sources", F.shiftright("node", PLACE_BITS).cast("int").alias("block"), pos.alias("pos"), "dist")
    placed = placed.join(names.select(G, "block", "n_nodes").distinct(), [G, "block"])
    arrays = scratch.put("arrays", placed.groupBy(G, "strip", "block").applyInArrow(_dist_block, DIST))
    session_for_blocks(scratch, 1)
    listed = dealt.groupBy(G, "strip").agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "source"))), lambda x: x["source"]).alias("sources"))
    near = arrays.select(G, "strip", "block", "n_sources", "n_nodes", F.col("dist").alias("near"))
    far = arrays.select(G, "strip", F.col("block").alias("to"), F.col("dist").alias("far"))
    met = near.join(links.hint("merge"), [G, "block"]).join(far.hint("merge"), [G, "strip", "to"]).join(listed, [G, "strip"])
    dag = scratch.put("tight", met.mapInArrow(_tight, TIGHT))
    session_for_rows(scratch)
    scratch.drop(arrays)
    return reach, dag


def _through(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(graph_name, num, _b): Brandes' sums over a few sources, each with all its acyclic links.

    Entries are pairs of source and node; a level holds those all of whose incoming links have
    been used. Numbers of paths run forward by levels, shares of them back.
    """
    t = pa.Table.from_batches(list(batches))
    source, src, dst = (t.column(c).to_numpy() for c in ("source", "src", "dst"))
    names, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
    who = np.unique(source, return_inverse=True)[1] * len(names)
    entries, at = np.unique(np.concatenate([who, who]) + at, return_inverse=True)
    u, v = at[:len(src)], at[len(src):]
    order = np.argsort(u, kind="stable")
    u, v = u[order], v[order]
    n = len(entries)
    out = np.bincount(u, minlength=n)
    begin = np.cumsum(out) - out
    left = np.bincount(v, minlength=n)
    first = front = np.flatnonzero(left == 0)
    ways, used = np.zeros(n), []
    ways[front] = 1.0
    while front.size:
        size = out[front]
        link = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - begin[front], size)
        used.append(link)
        to = v[link]
        np.add.at(ways, to, ways[u[link]])
        np.subtract.at(left, to, 1)
        to = np.unique(to)
        front = to[left[to] == 0]
    share = np.zeros(n)
    for link in reversed(used):
        a, b = u[link], v[link]
        np.add.at(share, a, ways[a] / ways[b] * (1.0 + share[b]))
    share[first] = 0.0  # end points are left out
    sums = np.bincount(entries % len(names), share, minlength=len(names))
    live = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()] * len(live), pa.string()), pa.array(names[live]), pa.array(sums[live])], names=["graph_name", "num", "_b"])


def dependency_sums(dag: DataFrame) -> DataFrame:
    """(graph_name, num, _b): how much of the shortest paths over the acyclic ``dag`` goes through each node."""
    return dag.groupBy(G, "part").applyInArrow(_through, "graph_name string, num long, _b double").groupBy(G, "num").agg(F.sum("_b").alias("_b"))


def _packed(batches):
    """Rows (graph, a, b, w) as a row of three arrays per graph and about ``PACK_LINKS`` links."""
    held, size = {}, 0

    def rows():
        for g, parts in held.items():
            a, b, w = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), *[pa.array([x.astype(t).tobytes()], pa.binary()) for x, t in ((a, np.uint16), (b, np.uint16), (w, np.int32))]], names=["g", "a", "b", "w"])

    for batch in batches:
        g, *links = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("g", "a", "b", "w"))
        for one in np.unique(g):
            at = g == one
            held.setdefault(int(one), []).append([x[at].astype(t) for x, t in zip(links, (np.uint16, np.uint16, np.int32))])
        size += len(g)
        if size >= PACK_LINKS:
            yield from rows()
            held, size = {}, 0
    yield from rows()


def _ones(bits):
    return _BITS[bits.view(np.uint8)].sum(axis=1, dtype=np.int64)


def _met(new, delta, src, first, dst, wanted):
    """Adds to ``new`` the bits of ``delta`` that links bring; their runs begin at ``first`` and end in ``dst``."""
    ends = np.r_[first[1:], len(src)]
    if len(src) >= LONG_RUN * len(first):
        for k in np.flatnonzero(wanted[dst]):
            new[dst[k]] |= np.bitwise_or.reduce(np.take(delta, src[first[k]:ends[k]], axis=0), axis=0)
        return
    at = 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(ends, first[at] + 4096, side="right")))
        some = np.take(delta, src[first[at]:ends[to - 1]], axis=0)
        new[dst[at:to]] |= np.bitwise_or.reduceat(some, first[at:to] - first[at], axis=0)
        at = to


def balls(n, low, high, links):
    """(reached, bands): per node, how many of the nodes from ``low`` to ``high`` it reaches and their summed distance, itself left out.

    ``links`` are undirected: a length in bands to arrays of both ends. Balls are rows of bits; a
    node passes on the bits that are new to it, a link's length later.
    """
    runs = {}
    for w, (a, b) in links.items():
        src, dst = np.concatenate([a, b]), np.concatenate([b, a])
        order = np.argsort(dst, kind="stable")  # a radix sort of 16-bit numbers
        src, count = src[order].astype(np.int32), np.bincount(dst, minlength=n)
        ends = np.flatnonzero(count)
        runs[w] = src, (np.cumsum(count) - count)[ends], ends
    ball = np.zeros((n, -(-(high - low) // 64)), np.uint64)
    member = np.arange(high - low)
    ball[member + low, member >> 6] = np.uint64(1) << (member & 63).astype(np.uint64)
    count, bands = _ones(ball), np.zeros(n, np.int64)
    own, sent, t = count, {0: ball.copy()}, 0
    longest = max(runs, default=0)
    while sent:
        t += 1
        new, wanted = np.zeros_like(ball), count < high - low
        for w, (src, first, dst) in runs.items():
            if t - w in sent and wanted.any():
                _met(new, sent[t - w], src, first, dst, wanted)
        new &= ~ball
        if new.any():
            ball |= new
            grown = _ones(ball)
            bands += t * (grown - count)
            count, sent[t] = grown, new
        sent.pop(t - longest, None)
    return count - own, bands


def _ball_strip(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = {}
    for n, n_strips, a, b, w in _rows(batches, "n", "n_strips", "a", "b", "w"):
        a, b, w = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16), np.frombuffer(w, np.int32)
        for one in np.unique(w):
            at = w == one
            held.setdefault(int(one), []).append((a[at], b[at]))
    links = {w: [np.concatenate(x) for x in zip(*held.pop(w))] for w in sorted(held)}
    g, strip = (k.as_py() for k in key)
    reached, bands = balls(n, n * strip // n_strips, n * (strip + 1) // n_strips, links)
    live = np.flatnonzero(reached)
    yield pa.RecordBatch.from_arrays([pa.array([g] * len(live), pa.int32()), pa.array(live.astype(np.int32)), pa.array(reached[live]), pa.array(bands[live])], names=["g", "pos", "reached", "bands"])


def ball_sums(scratch: Scratch, ids: DataFrame, edges: DataFrame, facts: DataFrame, weight: str, state_bytes: int = BALL_BYTES) -> DataFrame:
    """(graph_name, id, reached, bands) of the nodes that reach others: how many, and their summed distance in bands.

    ``facts`` has a row per graph: its number of nodes ``_n`` (at most 65,536), the length of a
    band ``_size`` and of the longest link ``_most``. One task holds the links of a graph and the
    balls' bits for a strip of its nodes, as many as keep the bits near ``state_bytes``.
    """
    links = edges.filter(F.col(weight).isNotNull())
    band_of = lambda c: F.greatest(F.lit(1), F.round(F.col(c) / F.col("_size"))).cast("int")
    strips = F.ceil(F.col("_n") * F.col("_n") * (band_of("_most") + 4) / 8 / state_bytes)
    known = facts.select(G, (F.row_number().over(Window.orderBy(G)) - 1).alias("g"), F.col("_n").cast("int").alias("n"), "_size", F.least(F.greatest(F.lit(1), strips), F.col("_n")).cast("int").alias("n_strips"))  # one row per graph
    known = scratch.put("known", known)
    inside = Window.partitionBy(G).orderBy("id")  # at most 65,536 nodes
    names = scratch.put("names", ids.filter("id is not null").join(known, G).select(G, "g", "id", "_size", (F.row_number().over(inside) - 1).alias("pos")))
    a = names.select(G, "g", "_size", F.col("id").alias("src"), F.col("pos").alias("a"))
    b = names.select(G, F.col("id").alias("dst"), F.col("pos").alias("b"))
    placed = links.filter("src <> dst").join(a, [G, "src"]).join(b, [G, "dst"]).select("g", "a", "b", band_of(weight).alias("w"))
    packed = scratch.put("packed", placed.mapInArrow(_packed, "g int, a binary, b binary, w binary"))
    session_for_blocks(scratch, 4)
    per_strip = packed.join(F.broadcast(known.select("g", "n", "n_strips")), "g")  # one row per graph
    per_strip = per_strip.withColumn("strip", F.explode(F.sequence(F.lit(0), F.col("n_strips") - 1)))
    found = per_strip.groupBy("g", "strip").applyInArrow(_ball_strip, "g int, pos int, reached long, bands long")
    found = scratch.put("found", found)
    session_for_rows(scratch)
    sums = found.groupBy("g", "pos").agg(F.sum("reached").alias("reached"), F.sum("bands").alias("bands"))
    out = scratch.put("sums", sums.join(names, ["g", "pos"]).select(G, "id", "reached", "bands"))
    scratch.close(out)
    return scratch.give(out)


def _matrix(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells = None
    for b in batches:
        row, col, n_row, n_col, x = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("r", "c", "n_row", "n_col", "x"))
        cells = np.zeros((n_row[0], n_col[0])) if cells is None else cells
        np.add.at(cells, (row, col), x)
    yield _batch(_schema(MATRIX), graph_name=key[0].as_py(), row=key[1].as_py(), col=key[2].as_py(), n_row=cells.shape[0], n_col=cells.shape[1], cells=cells.tobytes())


def _corners(batches):
    """What the triangles of three blocks add to their corners a, b and c."""
    array = lambda cells, *shape: np.frombuffer(cells, np.float64).reshape(shape)
    for g, k, i, j, n_k, n_i, n_j, ab, ac, bc in _rows(batches, "graph_name", "k", "i", "j", "n_k", "n_i", "n_j", "ab", "ac", "bc"):
        ab, ac, bc = array(ab, n_k, n_i), array(ac, n_k, n_j), array(bc, n_i, n_j)
        both = (ab.T @ ac) * bc
        for block, t in ((k, ((ab @ bc) * ac).sum(axis=1)), (i, both.sum(axis=1)), (j, both.sum(axis=0))):
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(at), pa.string()), pa.array([block] * len(at), pa.int32()), pa.array(at.astype(np.int32)), pa.array(t[at])], names=["graph_name", "block", "pos", "t"])


def triangle_sums(scratch: Scratch, ids: DataFrame, low: DataFrame, closing: DataFrame, block_nodes: int = TRIANGLE_NODES) -> DataFrame:
    """(graph_name, id, _t): the products x(a, b) * x(a, c) * x(b, c) of all triangles, summed at each of their corners.

    ``low`` has the links (graph_name, a, b, x) that open a triangle, ``closing`` the links
    (graph_name, u, v, x) that close it, u = b and v = c. Links become matrices of pairs of node
    blocks; each three blocks that fit together are one row of two matrix products.
    """
    session_for_blocks(scratch)
    ids = scratch.put("ids", ids.select(F.col(G).cast("string").alias(G), "id").distinct())
    facts = ids.groupBy(G).agg(F.ceil(F.count(F.lit(1)) / block_nodes).cast("int").alias("n_blocks"))
    names = scratch.put("names", numbered(ids, facts))
    side = lambda key, block, pos, n: names.select(G, F.col("id").alias(key), F.col("block").alias(block), F.col("pos").alias(pos), F.col("n_nodes").alias(n))

    def matrices(name, links, a, b):
        placed = links.join(side(a, "row", "r", "n_row"), [G, a]).join(side(b, "col", "c", "n_col"), [G, b])
        return scratch.put(name, placed.select(G, "row", "col", "r", "c", "n_row", "n_col", F.col("x").cast("double").alias("x")).groupBy(G, "row", "col").applyInArrow(_matrix, MATRIX))

    opening, closed = matrices("opening", low, "a", "b"), matrices("closing", closing, "u", "v")
    bc = closed.select(G, F.col("row").alias("i"), F.col("col").alias("j"), F.col("cells").alias("bc"))
    part = lambda block, n, cells: opening.select(G, F.col("row").alias("k"), F.col("col").alias(block), F.col("n_row").alias("n_k"), F.col("n_col").alias(n), F.col("cells").alias(cells))
    ab, ac = part("i", "n_i", "ab"), part("j", "n_j", "ac").drop("n_k")
    three = bc.hint("merge").join(ab, [G, "i"]).join(ac.hint("merge"), [G, "k", "j"])
    found = three.mapInArrow(_corners, "graph_name string, block int, pos int, t double").groupBy(G, "block", "pos").agg(F.sum("t").alias("_t"))
    sums = scratch.put("corners", found.join(names, [G, "block", "pos"]).select(G, "id", "_t"))
    scratch.close(sums)
    return scratch.give(sums)
