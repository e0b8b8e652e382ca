"""Near-duplicates by bottom-k sketches.

A text's set holds its distinct word shingles; its sketch the ``K`` smallest values of one hash
function over the set. Inverted lists of retained values propose pairs, the sketch of the union
estimates their similarity and the whole sets decide it.

Exact copies form one item first. Of an item's retained values only the rarest are listed, as
many as guarantee that two similar items meet in a list (prefix filtering: of s values that must
share o, the s - o + 1 rarest suffice). For sets inside the sketch this is exact; for larger
ones o lies six standard deviations below the number that similar sets share.

Lists with the same members count once: the shingles of a shared passage make many of them. In
each round a list's members are compared with one leader; confirmed links join components, and a
list whose members are all in one component is done. Members of lists that stay mixed after the
leader rounds are listed anew by their whole sets, where similar texts share one of the
(1 - threshold) rarest shingles: passages that many documents share are not among those. After
leader rounds there, the rest is exact: members outside a list's largest component meet the
members of other components, each pair in one list alone, that of their least common value.

Sketches and texts of listed items lie in one table bucketed by item, so a round moves its pairs
and not the texts; tables are deleted when the next step no longer reads them.

Defined cases: null and empty texts have an empty set and stay alone; fewer words than the
shingle length make one shingle; rows that repeat an id are documents of their own with one id;
a null id is never linked, has a null component and is kept.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType

from stationlens.functions.components import contract_components
from stationlens.llm import words as W
from stationlens.scratch import Scratch

K = 64
SKETCH = "n long, item binary, sketch array<long>"


def sketcher(shingle: int, k: int = K):
    """A column function: text to set size, digest of its words and bottom-k sketch."""

    @F.arrow_udf(returnType=SKETCH)
    def sketch(text: pa.Array) -> pa.Array:
        sizes, items, values = [], [], []
        for data, off in W.slices(text):
            w = W.split_words(data, off)
            h = W.word_hashes(w.vocab)[w.codes] if len(w.vocab) else np.zeros(0, np.uint64)
            g = W.gram_hashes(h, shingle).view(np.int64)
            raw = data.tobytes()
            for i in range(len(off) - 1):
                a, b = int(w.starts[i]), int(w.starts[i + 1])
                if b - a >= shingle:
                    own = np.unique(g[a : b - shingle + 1])
                elif b > a:
                    own = W.gram_hashes(h[a:b] ^ np.uint64(b - a), b - a).view(np.int64)
                else:
                    own = np.zeros(0, np.int64)
                sizes.append(len(own))
                items.append(hashlib.blake2b(b" ".join(raw[off[i] : off[i + 1]].lower().split()), digest_size=16).digest() if b > a else None)
                values.append(own[:k])
        offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
        flat = np.concatenate(values) if values else np.zeros(0, np.int64)
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(items, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["n", "item", "sketch"])

    return sketch.asNondeterministic()


@F.arrow_udf(returnType=BinaryType())
def digest(text: pa.Array) -> pa.Array:
    """The item digest alone."""
    texts = (t.as_py() for t in text)
    return pa.array([hashlib.blake2b(b" ".join(t.encode().lower().split()), digest_size=16).digest() if t and t.strip(" \t\n\x0b\x0c\r") else None for t in texts], pa.binary())


@F.arrow_udf(returnType=DoubleType())
def estimate(a: pa.Array, b: pa.Array) -> pa.Array:
    """Similarity from the sketch of the union: the share of its values that both sketches hold."""
    out = np.zeros(len(a))
    xo, xv = a.offsets.to_numpy(), a.values.to_numpy()
    yo, yv = b.offsets.to_numpy(), b.values.to_numpy()
    for i in range(len(out)):
        x, y = xv[xo[i] : xo[i + 1]], yv[yo[i] : yo[i + 1]]
        union = np.sort(np.concatenate([x, y]))
        same = union[1:] == union[:-1]
        distinct = np.concatenate([union[:1], union[1:][~same]])
        k = min(len(distinct), max(len(x), len(y)))
        out[i] = (union[1:][same] <= distinct[k - 1]).sum() / k if k else 0.0
    return pa.array(out)


def overlap(shingle: int):
    """A column function on two texts: sizes of the intersection and the union of their whole sets."""

    def shingles(t):
        w = t.encode().lower().split()
        return set(zip(*(w[i:] for i in range(shingle)))) if len(w) >= shingle else {tuple(w)} if w else set()

    @F.arrow_udf(returnType="both long, either long")
    def measure(a: pa.Array, b: pa.Array) -> pa.Array:
        both, either, last = [], [], (None, None)
        for x, y in zip(a, b):  # one pair's texts at a time
            x, y = x.as_py(), y.as_py()
            if last[0] != x:
                last = (x, shingles(x))
            s, t = last[1], shingles(y)
            n = len(s & t)
            both.append(n)
            either.append(len(s) + len(t) - n)
        return pa.StructArray.from_arrays([pa.array(both, pa.int64()), pa.array(either, pa.int64())], ["both", "either"])

    return measure


def whole_set(shingle: int):
    """A column function: text to the hashes of all its distinct shingles."""

    @F.arrow_udf(returnType="array<long>")
    def hashes(text: pa.Array) -> pa.Array:
        values = []
        for data, off in W.slices(text):
            w = W.split_words(data, off)
            h = W.word_hashes(w.vocab)[w.codes] if len(w.vocab) else np.zeros(0, np.uint64)
            for i in range(len(off) - 1):
                own = h[int(w.starts[i]) : int(w.starts[i + 1])]
                values.append(np.unique(W.gram_hashes(own, min(shingle, len(own))).view(np.int64)) if len(own) else np.zeros(0, np.int64))
        offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)))

    return hashes.asNondeterministic()


def _listed(rows: DataFrame) -> DataFrame:
    """(value, item, n, df, pos): of each item's rows (item, n, p, m, value) the ``p`` rarest of its ``m`` values, ties by value.

    A value of one item proposes nothing, but it still fills a place among the rarest: an item has
    as many of those as rows are lost in the join with the values of several. ``pos`` is the place
    of the value among all of the item's, rarest first and from 1.
    """
    often = rows.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = rows.join(often, "value").groupBy("item", "n", "p", "m").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("v"))
    alone = F.col("m") - F.size("v")
    cut = shared.withColumn("alone", alone).withColumn("free", F.col("p") - alone).filter("free > 0")
    listed = cut.select("item", "n", "alone", F.posexplode(F.expr("slice(v, 1, free)")).alias("at", "v"))
    return listed.select("v.value", "item", "n", "v.df", (F.col("alone") + F.col("at") + 1).alias("pos"))


def _once(lists: DataFrame, *order: str) -> DataFrame:
    """One list of each set of members (told apart by 128 bits of their hashes), without lists of one.

    The list that stays is the first by ``order``, columns that a list's rows share, then by value.
    """
    order = (*order, "value")
    marks = lists.groupBy(*order).agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("item")).alias("x"), F.bit_xor(F.xxhash64("item", F.lit(7))).alias("y")).filter("c > 1")
    first = marks.groupBy("c", "x", "y").agg(F.min(F.struct(*order)).alias("o"))
    return lists.join(first.select(F.col("o.value").alias("value")), "value")


def _sketch_rows(items: DataFrame, t: float, k: int) -> DataFrame:
    low = max(1, math.ceil(k * t - 6 * math.sqrt(k * t * (1 - t))))
    size = F.size("sketch")
    # Sets so small that all their partners lie inside the sketch take the exact bound.
    share = F.when(F.col("n") <= math.floor(t * k), F.ceil(F.col("n") * F.lit(t) - F.lit(1e-9))).otherwise(F.least(F.lit(low), F.ceil(size * F.lit(t)))).cast("int")
    return items.select("item", "n", F.greatest(F.lit(1), size - share + 1).alias("p"), size.alias("m"), F.explode("sketch").alias("value"))


def _whole_rows(texts: DataFrame, t: float, shingle: int) -> DataFrame:
    sets = texts.select("item", whole_set(shingle)("text").alias("v")).withColumn("n", F.size("v").cast("long"))
    p = (F.col("n") - F.ceil(F.col("n") * F.lit(t) - F.lit(1e-9)) + 1).cast("int")
    return sets.select("item", "n", p.alias("p"), F.col("n").cast("int").alias("m"), F.explode("v").alias("value"))


def _confirmed(scratch, pairs, known, threshold_pct, shingle, k):
    """Links among the proposed ``pairs`` (a, b); ``known`` has sketch and text by item."""
    t = threshold_pct / 100
    low = t - 5 * math.sqrt(t * (1 - t) / k)
    side = lambda c, what: known.select(F.col("item").alias(c), F.col(what).alias(f"{what}_{c}"))
    near = pairs.join(side("a", "sketch"), "a").join(side("b", "sketch"), "b")
    near = scratch.put("near", near.filter(estimate("sketch_a", "sketch_b") >= low).select("a", "b"))
    whole = near.join(side("a", "text"), "a").join(side("b", "text"), "b")
    m = whole.select("a", "b", overlap(shingle)("text_a", "text_b").alias("m"))
    links = scratch.put("links", m.filter(100 * F.col("m.both") >= threshold_pct * F.col("m.either")).select("a", "b"))
    scratch.drop(near)
    return links


def _mixed(scratch, lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``lists`` with their ``label``, of those that still hold more than one component."""
    state = lists.withColumn("label", F.col("item")) if labels is None else lists.join(labels, "item", "left").withColumn("label", F.coalesce("label", "item"))
    mixed = state.groupBy("value").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("value")
    return scratch.put("mixed", state.join(mixed, "value"))


def _outside(state: DataFrame, turn: int) -> DataFrame:
    """Members outside their list's largest component, with a ``leader`` (of size ``m``) from that one."""
    sizes = state.groupBy("value", "label").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct(F.xxhash64("item", F.lit(turn), "value").alias("h"), "item", "n")).alias("one"))
    top = sizes.groupBy("value").agg(F.max(F.struct("c", F.col("one.h").alias("h"), F.col("label").alias("main"), F.col("one.item").alias("leader"), F.col("one.n").alias("m"))).alias("t")).select("value", "t.main", "t.leader", "t.m")
    return state.join(top, "value").filter("label <> main")


def _between(state: DataFrame, t: float) -> DataFrame:
    """(item, n, leader, m): all pairs of different components that share a list and can still be similar.

    Of two sets of n <= m values the overlap must reach t / (1 + t) * (n + m). Values are in one
    order for all sets, so a pair's first common value leaves at most the values behind it, in
    either set, to be common too. A pair is met in the list of its first common value alone, and
    only if that bound is reached there; the smaller set must have the value among its first ones.
    """
    need = lambda n, m: F.ceil(F.lit(t / (1 + t)) * (n + m) - F.lit(1e-6))
    mark = F.struct("df", "value")
    values = state.groupBy("item").agg(F.array_sort(F.collect_list(mark)).alias("own"))  # at most the listed values of one text
    rows = state.select("value", mark.alias("v"), "item", "n", "pos", "label").join(values, "item")
    front = rows.filter(1 + F.col("n") - F.col("pos") >= need(F.col("n"), F.col("n")))
    other = rows.select(F.col("value").alias("at"), F.col("item").alias("leader"), F.col("n").alias("m"), F.col("pos").alias("there"), F.col("label").alias("other"), F.col("own").alias("theirs"))
    larger = (F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("item") < F.col("leader")))
    left = 1 + F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("there"))
    first = F.array_min(F.array_intersect("own", "theirs")) == F.col("v")
    on = (F.col("value") == F.col("at")) & (F.col("label") != F.col("other")) & larger & (left >= need(F.col("n"), F.col("m"))) & first
    return front.join(other, on).select("item", "n", "leader", "m")


def _joined(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(item, label) after new ``links`` (a, b): only components that they join are contracted."""
    if labels is None:
        return contract_components(links, "a", "b").select(F.col("id").alias("item"), "label")
    ends = links.select(F.explode(F.array("a", "b")).alias("item")).distinct().join(labels, "item", "left_anti").withColumn("label", F.col("item"))
    known = labels.unionByName(ends)
    side = lambda c: known.select(F.col("item").alias(c), F.col("label").alias(f"_{c}"))
    joins = links.join(side("a"), "a").join(side("b"), "b").filter("_a <> _b")
    moved = contract_components(joins, "_a", "_b").select(F.col("id").alias("label"), F.col("label").alias("_to"))
    return known.join(moved, "label", "left").select("item", F.coalesce("_to", "label").alias("label"))


def link_components(docs: DataFrame, shingle: int = 5, threshold_pct: int = 80, k: int = K, leader_rounds: tuple = (2, 1)):
    """(rows, members): per row of ``docs`` (doc_id, n, digest), and (digest, component_id, first) of all texts with words; ``first`` marks one text per component."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    sketched = scratch.put("sketches", docs.select("doc_id", sketcher(shingle, k)("text").alias("s")).select("doc_id", "s.n", F.col("s.item").alias("digest"), "s.sketch"))
    t = threshold_pct / 100
    linked = sketched.filter("digest is not null and doc_id is not null")
    items = linked.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    # Numbered as it is written, so that the numbers stay what they are.
    items = scratch.put("items", items.withColumn("item", F.monotonically_increasing_id()))
    lists = scratch.put("lists", _once(_listed(_sketch_rows(items, t, k))))
    # Texts are looked up by the representative's id, and checked, for items that share a listed value.
    wanted = lists.select("item").distinct().join(items, "item")
    found = docs.select("doc_id", "text").join(wanted.select(F.col("rep").alias("doc_id"), F.col("digest").alias("_want"), "item", "sketch"), "doc_id")
    texts = found.withColumn("_got", digest("text")).filter("_got = _want").dropDuplicates(["item"]).select("item", "sketch", "text")
    known = scratch.bucketed("known", texts, int(spark.conf.get("spark.sql.shuffle.partitions")), "item")
    labels, tried = None, None

    def fits(n, m):
        return (F.col(n) >= F.col(m) * (t - 1e-9)) & (F.col(m) >= F.col(n) * (t - 1e-9))

    def compare(proposed):
        nonlocal labels, tried
        pairs = proposed.filter(fits("n", "m")).select(F.least("item", "leader").alias("a"), F.greatest("item", "leader").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = scratch.put("pairs", pairs)
        if pairs.isEmpty():
            return
        good = _confirmed(scratch, pairs, known, threshold_pct, shingle, k)
        tried = pairs if tried is None else tried.unionAll(pairs)
        if not good.isEmpty():
            previous, labels = labels, scratch.put("labels", _joined(good, labels))
            scratch.drop(previous)
        scratch.drop(good)

    def turns(number):
        for turn in range(number):
            mixed = _mixed(scratch, lists, labels)
            compare(_outside(mixed, turn))
            scratch.drop(mixed)

    turns(leader_rounds[0])
    mixed = _mixed(scratch, lists, labels)
    open_items = scratch.put("open", mixed.select("item").distinct())
    scratch.drop(mixed, lists)
    if not open_items.isEmpty():
        # What is open still meets by whole sets: similar texts share one of their rarest shingles.
        lists = scratch.put("whole", _once(_listed(_whole_rows(known.join(open_items, "item", "left_semi"), t, shingle)), "df"))
        turns(leader_rounds[1])
        mixed = _mixed(scratch, lists, labels)
        compare(_between(mixed, t))
        scratch.drop(mixed)
    members = items.select("digest", "item", "rep")
    grouped = members.withColumn("label", F.col("item")) if labels is None else members.join(labels, "item", "left").withColumn("label", F.coalesce("label", "item"))
    least = grouped.groupBy("label").agg(F.min(F.struct("rep", "digest")).alias("f"))
    found = grouped.join(least, "label").select("digest", F.col("f.rep").alias("component_id"), (F.col("f.digest") == F.col("digest")).alias("first"))
    found = scratch.put("members", found)
    rows = scratch.put("rows", sketched.select("doc_id", "n", "digest"))
    scratch.close(found, rows)
    return rows, found


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold_pct: int = 80, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    rows, members = link_components(docs, shingle, threshold_pct, k)
    out = rows.join(members, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (component.isNull() | (component == F.col("doc_id"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, threshold_pct: int = 80) -> DataFrame:
    """One row of each group of near-duplicates, with all columns.

    The row of the smallest id stays, of several texts with that id the one of smallest digest.
    Rows that repeat an id are judged by their texts, so each belongs to its own text's group;
    equal rows that repeat an id and a text stay once. Rows without an id or without words stay.
    """
    rows, members = link_components(docs.select("doc_id", "text"), shingle, threshold_pct)
    judged = rows.join(members, "digest", "left")
    kept = F.col("digest").isNull() | F.col("doc_id").isNull() | (F.col("first") & (F.col("component_id") == F.col("doc_id")))
    again = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("doc_id")
    gone = judged.filter(~kept).select("doc_id").distinct()
    every = [F.col(f"`{c}`") for c in docs.columns]
    single = docs.join(gone.unionAll(again), "doc_id", "left_anti").select(*every)
    mark = W.fresh_name(docs, "_digest")
    repeated = docs.join(again, "doc_id", "left_semi").select(*every, digest("text").alias(mark))
    stay = judged.filter(kept).join(again, "doc_id", "left_semi").select("doc_id", F.col("digest").alias(mark)).distinct()
    others = [c for c in docs.columns if c != "doc_id"]
    first = F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("r")
    wordless = repeated.filter(F.col(mark).isNull()).select(*every)
    worded = repeated.join(stay, ["doc_id", mark], "left_semi").groupBy("doc_id", mark).agg(first).select("doc_id", "r.*").select(*every)
    return single.unionByName(wordless).unionByName(worded)
