"""Periodic runs of words, found on a grammar.

A run is a stretch of words with a smallest period q, at least ``min_length`` and 2 q words long,
that no neighbouring word extends. Texts are taken in slices of bounded size and each slice gets
one grammar for all of its texts:

1. *Re-Pair on word ids.* Each round replaces the occurrences of repeated adjacent pairs by
   nonterminals, most frequent pair first: an occurrence goes if no overlapping pair is more
   frequent. Rounds end when no pair repeats; what is left of each text is folded into a balanced
   tree. So each border between two words belongs to one occurrence of one nonterminal.
2. *Runs across each nonterminal's boundary, once.* For every period up to half the expansion,
   how far the words on both sides of the boundary agree at that distance follows from exact
   ranks of 2^k-word windows. Periods whose three words next to the boundary differ on both sides
   cannot reach six agreeing words and are left out, which loses nothing.
3. *Translation.* The found stretches are shifted to all borders that derive from the
   nonterminal, and stretches inside another of the same period are merged into it. A maximal run
   is found whole at the lowest nonterminal that spans it.

A run makes six consecutive words occur again, so texts without a repeated window of six words
are known to have none and take no part in the grammar.

Defined cases: null and empty texts and texts without words have no runs and an empty collapsed
text; of runs of one length the first start, then the smaller period is the greatest; repeated
rows get equal results; memory follows the slice, or one text where that is longer.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stationlens.llm import words as W

MIN_LENGTH = 12
SEED_WORDS = 6
STEP = 1 << 20
RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def repeated_window(codes, starts, size=SEED_WORDS):
    """Texts in which some window of ``size`` words occurs twice (by hash, so a few more may be named)."""
    h = W.gram_hashes(codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1), size)
    at = np.flatnonzero(W.whole_grams(starts, size, len(codes)))
    text = W.owners(starts)[at]
    keyed = np.sort((h[at] << np.uint64(20)) ^ (h[at] >> np.uint64(44)) ^ (text.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)))
    twice = np.unique(keyed[1:][keyed[1:] == keyed[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64)
    mine = (h[at] << np.uint64(20)) ^ (h[at] >> np.uint64(44)) ^ (text.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    spot = np.minimum(np.searchsorted(twice, mine), len(twice) - 1)
    return np.unique(text[twice[spot] == mine])


def grammar(codes, starts):
    """(rule, left, right, first): the nonterminal of each border, and its two lengths and first border.

    ``rule[b]`` is the nonterminal whose boundary lies before word ``b``, -1 where a text starts.
    """
    n = len(codes)
    rule = np.full(n, -1, np.int64)
    left, right, first = [], [], []
    made, next_symbol = 0, int(codes.max()) + 1 if n else 0
    symbol, place = codes.astype(np.int64), np.arange(n)
    size, text = np.ones(n, np.int64), W.owners(starts)

    def replace(at, group, n_groups):
        """Merge symbol ``at`` with the next one; equal ``group`` makes one nonterminal."""
        nonlocal symbol, place, size, text, made, next_symbol
        lead = np.full(n_groups, len(symbol), np.int64)
        np.minimum.at(lead, group, at)
        left.append(size[lead])
        right.append(size[lead + 1])
        first.append(place[lead + 1])
        rule[place[at + 1]] = made + group
        symbol, size = symbol.copy(), size.copy()
        symbol[at] = next_symbol + group
        size[at] += size[at + 1]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        symbol, place, size, text = symbol[keep], place[keep], size[keep], text[keep]
        made += n_groups
        next_symbol += n_groups

    while len(symbol) > 1:
        inside = text[1:] == text[:-1]
        key = symbol[:-1] * next_symbol + symbol[1:]
        at = np.flatnonzero(inside)
        _, code, count = np.unique(key[at], return_inverse=True, return_counts=True)
        often = np.zeros(len(key), np.int64)
        often[at] = count[code]
        # Priority by count, ties by a hash of the pair; 0 where the pair occurs once.
        mixed = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(34)
        rank = np.where(often > 1, (often.astype(np.int64) << 30) + mixed.astype(np.int64) + 1, 0)
        before, after = np.append(0, rank[:-1]), np.append(rank[1:], 0)
        same_before = np.append(False, key[1:] == key[:-1]) & (before == rank)
        # In a stretch of one symbol every second occurrence goes, counted from its start.
        opens = np.flatnonzero(~same_before)
        odd = (np.arange(len(key)) - opens[np.searchsorted(opens, np.arange(len(key)), "right") - 1]) % 2 == 1
        same_after = np.append(key[1:] == key[:-1], False) & (after == rank)
        chosen = (rank > 0) & ((rank > before) | same_before) & ((rank > after) | same_after) & ~odd
        # Ties of different pairs with one rank: the left occurrence goes.
        clash = np.append(False, chosen[:-1]) & chosen
        chosen &= ~clash
        at = np.flatnonzero(chosen)
        if not len(at):
            break
        pairs, group = np.unique(key[at], return_inverse=True)
        replace(at, group, len(pairs))
    while len(symbol) > 1:
        begins = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        index = np.arange(len(symbol)) - np.repeat(begins, np.diff(np.append(begins, len(symbol))))
        at = np.flatnonzero((index[:-1] % 2 == 0) & (text[1:] == text[:-1]))
        if not len(at):
            break
        replace(at, np.arange(len(at)), len(at))
    empty = [np.zeros(0, np.int64)]
    return rule, *(np.concatenate(x or empty) for x in (left, right, first))


def window_ranks(codes, longest):
    """Exact ranks of the windows of 1, 2, 4, ... words (the last words padded), while some window repeats."""
    ranks, size = [codes.astype(np.int64)], 1
    while size * 2 <= longest:
        r = ranks[-1]
        shifted = np.full(len(r), -1, np.int64)
        shifted[: max(0, len(r) - size)] = r[size:]
        kinds, nxt = np.unique(r * (len(r) + int(codes.max()) + 2) + shifted + 1, return_inverse=True)
        ranks.append(nxt.astype(np.int64))
        size *= 2
        if len(kinds) == len(r):
            break
    return ranks


def _agree(ranks, i, j, room, forward):
    """How many words from ``i`` and ``j`` on (or back) are equal, at most ``room``."""
    i, j, room = i.copy(), j.copy(), room.copy()
    total = np.zeros(len(i), np.int64)
    # Windows of one size may repeat where longer ones do not, so the longest kept size is tried until it fails.
    for k in range(len(ranks) - 1, -1, -1):
        step = 1 << k
        live = np.arange(len(i)) if k == len(ranks) - 1 else np.flatnonzero(room >= step)
        while True:
            live = live[room[live] >= step]
            a, b = (i[live], j[live]) if forward else (i[live] - step + 1, j[live] - step + 1)
            live = live[ranks[k][a] == ranks[k][b]]
            if not len(live):
                break
            total[live] += step
            room[live] -= step
            i[live] += step if forward else -step
            j[live] += step if forward else -step
            if k < len(ranks) - 1:
                break
    return total


def _three(codes):
    """Exact ids of the three words from a position on; the last two positions have ids of their own."""
    n = len(codes)
    out = -1 - np.arange(n)
    if n >= 3:
        base = int(codes.max()) + 1
        _, two = np.unique(codes[:-2] * base + codes[1:-1], return_inverse=True)
        out[: n - 2] = np.unique(two * base + codes[2:], return_inverse=True)[1]
    return out


def boundary_runs(codes, left, right, first, min_length=MIN_LENGTH, step=STEP):
    """(nonterminal, start, end, period): stretches across each boundary, at its first place in the words."""
    codes = codes.astype(np.int64)
    ranks, three = window_ranks(codes, int((left + right).max()) if len(left) else 1), _three(codes)
    begin, end = first - left, first + right
    found = []
    for back in (True, False):  # the period before the boundary, then the one after it
        reach = np.minimum(left if back else right, (left + right) // 2)
        reach = np.where(left + right >= min_length, reach, 0)
        ends = np.cumsum(reach)
        total = int(ends[-1]) if len(ends) else 0
        for lo in range(0, total, step):
            flat = np.arange(lo, min(total, lo + step))
            node = np.searchsorted(ends, flat, "right")
            p = flat - (ends[node] - reach[node]) + 1
            b = first[node]
            i, j = (b - p, b) if back else (b, b + p)
            on = (j + 3 <= end[node]) & (three[i] == three[np.minimum(j, len(codes) - 1)])
            off = (i - 3 >= begin[node]) & (three[np.maximum(i - 3, 0)] == three[np.maximum(j - 3, 0)])
            pick = np.flatnonzero(on | off)
            node, p, i, j = node[pick], p[pick], i[pick], j[pick]
            # Positions outside the expansion have no room and are never compared.
            ahead = _agree(ranks, i, j, np.maximum(0, end[node] - j), True)
            behind = _agree(ranks, i - 1, j - 1, np.maximum(0, i - begin[node]), False)
            s, e = i - behind, j + ahead
            ok = (e - s >= np.maximum(min_length, 2 * p)) & (s < first[node]) & (e > first[node])
            found.append(np.stack([node[ok], s[ok], e[ok], p[ok]]))
    rows = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
    order = np.lexsort((rows[3], rows[2], rows[1], rows[0]))
    rows = rows[:, order]
    fresh = np.ones(rows.shape[1], bool)  # of one stretch the smallest period stays
    fresh[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
    return rows[:, fresh]


def slice_runs(codes, starts, min_length=MIN_LENGTH):
    """(text, start, end, period) arrays of all maximal runs, starts counted in the text, in order of start and period."""
    chosen = repeated_window(codes, starts)
    if not len(chosen):
        return np.zeros((4, 0), np.int64)
    sizes = (starts[1:] - starts[:-1])[chosen]
    own = np.concatenate([[0], np.cumsum(sizes)])
    x = codes[np.repeat(starts[chosen] - own[:-1], sizes) + np.arange(own[-1])]
    x = np.unique(x, return_inverse=True)[1].astype(np.int64)
    rule, left, right, first = grammar(x, own)
    nodes, s, e, p = boundary_runs(x, left, right, first, min_length)
    # Each border of a nonterminal with runs gets its runs.
    border = np.flatnonzero(rule >= 0)
    lo, hi = np.searchsorted(nodes, rule[border]), np.searchsorted(nodes, rule[border], "right")
    border, lo, many = border[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
    pick = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
    shift = np.repeat(border, many) - first[nodes[pick]]
    s, e, p = s[pick] + shift, e[pick] + shift, p[pick]
    order = np.lexsort((-e, s, p))
    s, e, p = s[order], e[order], p[order]
    if len(s):
        group = np.cumsum(np.append(0, p[1:] != p[:-1])) * (len(x) + 1)
        reach = np.maximum.accumulate(group + e)
        keep = np.append(True, (group + e)[1:] > reach[:-1])
        s, e, p = s[keep], e[keep], p[keep]
        order = np.lexsort((p, s))
        s, e, p = s[order], e[order], p[order]
    text = np.searchsorted(own, s, "right") - 1
    return np.stack([chosen[text], s - own[text], e - own[text], p])


def runs_of(min_length: int = MIN_LENGTH):
    """A column function: text to number of words, runs by start and period, and the text without the runs' repeats."""
    if min_length < MIN_LENGTH:
        raise ValueError(f"min_length is at least {MIN_LENGTH}: the windows that rule out texts and periods rely on it")

    @F.arrow_udf(returnType=RESULT)
    def find(text: pa.Array) -> pa.Array:
        counts, lists, flat, collapsed = [], [0], [], []
        for data, off in W.slices(text):
            w = W.split_words(data, off, lower=False)
            texts, s, e, p = slice_runs(w.codes, w.starts, min_length)
            raw = data.tobytes()
            bounds = np.searchsorted(texts, np.arange(len(off)))
            for i in range(len(off) - 1):
                words = raw[off[i] : off[i + 1]].split()
                counts.append(len(words))
                a, b = bounds[i], bounds[i + 1]
                if b > a:
                    gone = np.zeros(len(words) + 1, np.int64)
                    np.add.at(gone, s[a:b] + p[a:b], 1)
                    np.add.at(gone, e[a:b], -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
                collapsed.append(b" ".join(words).decode())
                lists.append(lists[-1] + int(b - a))
            flat.append(np.stack([s, e - s, p]))
        rows = np.concatenate(flat, axis=1) if flat else np.zeros((3, 0), np.int64)
        runs = pa.StructArray.from_arrays([pa.array(r, pa.int64()) for r in rows], ["start", "length", "period"])
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(lists, pa.int32()), runs), pa.array(collapsed, pa.string())], ["n_words", "runs", "collapsed"])

    return find.asNondeterministic()


def periodic_runs(docs: DataFrame, text: str = "text", name: str = "periodic", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with a struct column ``name`` of n_words, runs (start, length, period) and collapsed text."""
    return docs.withColumn(name, runs_of(min_length)(F.col(f"`{text}`")))


@F.arrow_udf(returnType=StringType())
def planted(key: pa.Array, text: pa.Array) -> pa.Array:
    """The query's texts: for one id in ten the words from one on repeat with a period; a null id counts as none of them."""
    out = []
    for k, t in zip(key.to_pylist(), text):
        h = None if k is None else zlib.crc32(k.encode())
        if h is None or h % 10 or not t.is_valid:
            out.append(t.as_py())
            continue
        words, g = t.as_py().encode().split(), h // 10
        n = len(words)
        if n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words[a:] = (words[a : a + p] * (-(-(n - a) // p)))[: n - a]
        out.append(b" ".join(words).decode())
    return pa.array(out, pa.string())


def run_digests(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, the greatest one and digests of all runs and of the collapsed text."""
    found = periodic_runs(docs.select("doc_id", planted(F.col("doc_id").cast("string"), F.col("text")).alias("text")))
    r = F.col("periodic.runs")
    best = F.array_max(F.transform(r, lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("back"), (-x["period"]).alias("short"))))
    rows = found.select("doc_id", F.size(r).cast("long").alias("n_runs"), best.alias("best"), r.alias("runs"), F.col("periodic.collapsed").alias("collapsed"))
    listed = F.concat(F.array_join(F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"])), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    period = -F.col("best.short")
    return rows.select(
        "doc_id", "n_runs", (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"), period.alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / period).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
