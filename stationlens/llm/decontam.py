"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are compared in lower case without signs. Each test item gives n-grams; those that no text
holds seed nothing, and of the others all are seeds that are rare in the corpus: held by at most
``RARE`` of the texts (or ``FEW`` of them), or by not much more than the item's middle gram, so
that an item with many copies keeps its seeds; the rarest ``MIN_SEEDS`` are seeds in any case. A
text that holds a seed is aligned with the item around that place, word by word with matches,
mismatches and gaps, so that edited and paraphrased copies still score. The score is the
alignment's share of a perfect one.

The benchmark is taken in blocks of at most ``BLOCK`` items and ``BLOCK_WORDS`` words; a block's
seed index is the only thing sent to all tasks, so its size is bounded whatever the benchmark's.
Texts never leave their task: no shuffle carries them.

Defined cases: null and empty items or texts match nothing; items of fewer than ``N`` words are
one seed as a whole; repeated items each get their rows; item ids of any type, null too, are kept;
of alignments with one score the first found in the text is reported.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlens.llm import words as W

N = 3
MIN_SEEDS = 12
RARE = 1e-4
FEW = 16
BLOCK = 10_000
BLOCK_WORDS = 1_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
HITS = "array<struct<item: int, score: double, start: int, end: int>>"
BLOOM = 1 << 22
SIGNS = re.compile(r"[\W_]+")
ASCII_SIGNS = bytes(c for c in range(128) if not chr(c).isalnum())


def plain_words(data, off):
    """(hash of each word, its text's first word), signs removed and empty words left out."""
    w = W.split_words(data, off)
    # ASCII words are in lower case here; their signs go without decoding.
    shape = [v.translate(None, ASCII_SIGNS) if v.isascii() else SIGNS.sub("", v.decode("utf-8", "replace").lower()).encode() for v in w.vocab.to_pylist()]
    hashes = W.hashes_of(shape)[w.codes] if len(shape) else np.zeros(0, np.uint64)
    there = np.fromiter(map(bool, shape), bool, len(shape))[w.codes] if len(shape) else np.zeros(0, bool)
    if there.all():
        return hashes, w.starts
    starts = np.concatenate([[0], np.cumsum(there)])[w.starts]
    return hashes[there], starts


def item_grams(texts, n=N):
    """(word hashes, first words, gram hashes, item of each gram, place in the item)."""
    data, off = W.text_bytes(pa.array(texts, pa.string()))
    h, starts = plain_words(data, off)
    grams, items, places = [], [], []
    for i in range(len(texts)):
        own = h[starts[i] : starts[i + 1]]
        if len(own):
            g = W.gram_hashes(own, min(n, len(own)))
            if len(own) < n:  # kept apart from n-grams by its length
                g = g ^ np.uint64(len(own))
            grams.append(g)
            items.append(np.full(len(g), i))
            places.append(np.arange(len(g)))
    if not grams:
        return h, starts, np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int)
    return h, starts, np.concatenate(grams), np.concatenate(items), np.concatenate(places)


def _bloom(keys):
    table = np.zeros(BLOOM, bool)
    table[(keys >> np.uint64(20)) & np.uint64(BLOOM - 1)] = True
    return table


def _seen(h, starts, keys, table, lengths):
    """(position, key index) of all places of a slice of texts whose gram is among the sorted ``keys``."""
    at, which = [], []
    for n in lengths:
        g = W.gram_hashes(h, n)
        if n < N:
            g = g ^ np.uint64(n)
        near = np.flatnonzero(table[(g >> np.uint64(20)) & np.uint64(BLOOM - 1)])
        if len(near):
            k = np.minimum(np.searchsorted(keys, g[near]), len(keys) - 1)
            hit = keys[k] == g[near]
            near, k = near[hit], k[hit]
            # The gram lies in one text.
            one = np.searchsorted(starts, near, "right") == np.searchsorted(starts, near + n - 1, "right")
            at.append(near[one])
            which.append(k[one])
    return (np.concatenate(at), np.concatenate(which)) if at else (np.zeros(0, int), np.zeros(0, int))


def gram_frequency(docs: DataFrame, keys: np.ndarray, lengths) -> np.ndarray:
    """In how many texts each gram of the sorted ``keys`` occurs, over all rows."""
    sent = docs.sparkSession.sparkContext.broadcast((keys, _bloom(keys)))

    def tally(batches):
        own, table = sent.value
        total = np.zeros(len(own), np.int64)
        for batch in batches:
            for data, off in W.slices(batch.column(0)):
                h, starts = plain_words(data, off)
                at, k = _seen(h, starts, own, table, lengths)
                text = np.searchsorted(starts, at, "right")
                pair = np.unique(text * np.int64(len(own)) + k)
                total += np.bincount(pair % len(own), minlength=len(own))
        live = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(live, pa.int32()), pa.array(total[live], pa.int64())], ["k", "n"])

    rows = docs.select("text").mapInArrow(tally, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(keys), np.int64)
    for r in rows:
        out[r.k] = r.n
    return out


def align(a, b):
    """(score, first, end) of the best local alignment of item ``a`` inside ``b``."""
    # ``best`` runs along b; a gap inside b is a running maximum with a constant slope.
    m = len(b)
    slope = GAP * np.arange(m + 1)
    best, origin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    top = (0, 0, 0)
    for x in a:
        pair = best[:-1] + np.where(b == x, MATCH, MISMATCH)
        skip = best[1:] + GAP
        row = np.concatenate([[0], np.maximum(np.maximum(pair, skip), 0)])
        start = np.concatenate([[0], np.where(row[1:] == 0, np.arange(1, m + 1), np.where(pair >= skip, origin[:-1], origin[1:]))])
        level = np.maximum.accumulate(row - slope)
        lead = np.maximum.accumulate(np.where(row - slope == level, np.arange(m + 1), 0))
        best, origin = level + slope, start[lead]
        j = int(best.argmax())
        if best[j] > top[0]:
            top = (int(best[j]), int(origin[j]), j)
    return top


def finder(spark, texts, seeds, min_score):
    """A column function: text to the items it holds."""
    h, starts, _, _, _ = item_grams(texts)
    keys, items, places = seeds
    lengths = sorted({min(N, int(n)) for n in np.diff(starts) if n})
    uniq, first = np.unique(keys, return_index=True)
    sent = spark.sparkContext.broadcast((h, starts, uniq, np.append(first, len(keys)), items, places, _bloom(uniq)))

    @F.arrow_udf(returnType=HITS)
    def find(text: pa.Array) -> pa.Array:
        ih, istarts, own, first, items, places, table = sent.value
        found = []
        for data, off in W.slices(text):
            h, starts = plain_words(data, off)
            out = [[] for _ in range(len(off) - 1)]
            at, k = _seen(h, starts, own, table, lengths)
            doc = np.searchsorted(starts, at, "right") - 1
            spots = {}
            for d, p, j in zip(doc.tolist(), at.tolist(), k.tolist()):
                for e in range(first[j], first[j + 1]):
                    spots.setdefault((d, int(items[e])), set()).add(p - int(places[e]))
            for (d, i), begins in spots.items():
                item = ih[istarts[i] : istarts[i + 1]]
                slack = len(item) // 2 + 2
                hit, reach = (0, 0, 0), -1
                for b in sorted(begins):
                    if b <= reach:
                        continue
                    reach = b + slack // 2  # near begins share a window
                    lo, hi = max(int(starts[d]), b - slack), min(int(starts[d + 1]), b + len(item) + 2 * slack)
                    s, x, y = align(item, h[lo:hi])
                    if s > hit[0]:
                        hit = (s, lo + x - int(starts[d]), lo + y - int(starts[d]))
                score = hit[0] / (MATCH * len(item))
                if score >= min_score:
                    out[d].append({"item": i, "score": score, "start": hit[1], "end": hit[2]})
            found += out
        kind = pa.list_(pa.struct([("item", pa.int32()), ("score", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.array(found, kind)

    return find.asNondeterministic()


def _blocks(benchmark: DataFrame):
    """Lists of (item_id, text) of bounded size, in the order of the rows' hash."""
    size = benchmark.select("item_id", "text").filter("text is not null").withColumn("_b", F.pmod(F.xxhash64("item_id", "text"), F.lit(1 << 20)))
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    n, w = size.agg(F.count(F.lit(1)), F.coalesce(F.sum(words), F.lit(0))).first()
    parts = max(1, -(-n // (BLOCK // 2)), -(-w // (BLOCK_WORDS // 2)))
    for p in range(parts):
        yield [(r.item_id, r.text) for r in sorted(size.filter(F.col("_b") % parts == p).collect(), key=lambda r: (r.item_id is None, r.item_id, r.text))]


def rare_grams(items, often, n_texts):
    """True for the grams that are seeds, from each gram's item and number of texts."""
    chosen = np.zeros(len(items), bool)
    for i in np.unique(items):
        own = np.flatnonzero((items == i) & (often > 0))
        if len(own):
            ranked = own[np.argsort(often[own], kind="stable")]
            bound = max(FEW, RARE * n_texts, 2 * often[ranked[len(ranked) // 2]])
            chosen[ranked[:MIN_SEEDS]] = True
            chosen[own[often[own] <= bound]] = True
    return chosen


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = 0.5):
    """For each block of the benchmark: (item ids, a column function from text to hits)."""
    n_texts = docs.count()
    for block in _blocks(benchmark):
        texts = [t for _, t in block]
        _, _, keys, items, places = item_grams(texts)
        if not len(keys):
            continue
        uniq, inverse = np.unique(keys, return_inverse=True)
        lengths = sorted({N, *range(1, N)} & {min(N, len(re.findall(r"\S+", t))) for t in texts} | {N})
        often = gram_frequency(docs, uniq, lengths)[inverse]
        chosen = rare_grams(items, often, n_texts)
        order = np.flatnonzero(chosen)[np.argsort(keys[chosen], kind="stable")]
        yield [i for i, _ in block], finder(docs.sparkSession, texts, (keys[order], items[order], places[order]), min_score)


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_score: float = 0.5) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word) for every item that a text holds; words are counted without signs alone."""
    out, kind = None, dict(benchmark.dtypes)["item_id"]
    for ids, find in contaminated(docs, benchmark, min_score):
        hit = docs.select("doc_id", F.explode(find("text")).alias("h"))
        part = hit.select("doc_id", _named(hit, ids, kind).alias("item_id"), "h.score", F.col("h.start").alias("start_word"), F.col("h.end").alias("end_word"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.select("doc_id", F.lit(None).cast(kind).alias("item_id"), F.lit(0.0).alias("score"), F.lit(0).alias("start_word"), F.lit(0).alias("end_word")).filter("false")
    return out


def _named(hit, ids, kind):
    sent = hit.sparkSession.sparkContext.broadcast(ids)

    @F.arrow_udf(returnType=kind)
    def name(item: pa.Array) -> pa.Array:
        known = sent.value
        return pa.array([known[k] for k in item.to_pylist()], pa.string() if kind == "string" else None if any(i is not None for i in known) else pa.int64())

    return name(F.col("h.item"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = 0.5) -> DataFrame:
    """``docs`` without the texts that hold a test item."""
    rest, hits = docs, W.fresh_name(docs, "_hits")
    for _, find in contaminated(docs, benchmark, min_score):
        rest = rest.withColumn(hits, find("text")).filter(F.col(hits).isNull() | (F.size(hits) == 0)).drop(hits)
    return rest
