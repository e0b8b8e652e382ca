"""Quality rules by line sequence labelling.

A linear-chain conditional random field labels the lines of a text as content or boilerplate;
the share of words in content lines decides whether the text stays. Training lines come from
labelled documents: lines of good documents start as content and lines of bad ones as
boilerplate, a line classifier re-labels the lines that look like the other kind (good lines
inside bad documents), and the field learns from these sequences.

Defined cases: null and empty texts have no words and are not kept; a text of blank lines only
has an empty label sequence; without labelled rows the fields' weights are zero and every line
counts as content, so the base rules alone decide.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlens.llm import words as W

SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
UPPER = np.isin(np.arange(256), range(65, 91))
LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])
DIGIT = np.isin(np.arange(256), range(48, 58))
MARK = np.isin(np.arange(256), list(b".,;:!?'\"()-"))
SHOUT = np.isin(np.arange(256), list(b"!?"))
N_FEATURES = 12
WINDOW = 8
RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"


def line_features(data, off, lines):
    """One row per line: shares of kinds of bytes, length, word length and repetition in the text."""
    starts = lines.starts
    newline = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([off[:-1], newline + 1]), kind="stable")
    # Bytes per line by kind, from running sums; the newline itself belongs to no kind.
    end = np.append(begin[1:], len(data))

    def count(kind):
        total = np.concatenate([[0], np.cumsum(kind[data], dtype=np.int64)])
        return (total[end] - total[begin]).astype(np.float64)

    size = np.maximum(count(~W.IS_BLANK), 1)
    blank = W.IS_BLANK[data]
    first = ~blank
    first[1:] &= blank[:-1]
    first[begin[begin < len(data)]] = ~blank[begin[begin < len(data)]]
    total = np.concatenate([[0], np.cumsum(first, dtype=np.int64)])
    n_words = total[end] - total[begin]
    share = [count(k) / size for k in (SYMBOLS, UPPER, LETTER, DIGIT, MARK, SHOUT)]
    key = W.owners(starts) * np.int64(max(1, len(lines.vocab))) + lines.codes
    _, inverse, copies = np.unique(key, return_inverse=True, return_counts=True)
    repeated = (copies[inverse] > 1).astype(float)
    length = np.log1p(n_words)
    x = np.stack([np.ones(len(begin)), *share, length / 5, size / np.maximum(n_words, 1) / 20, repeated, (n_words <= 3).astype(float), np.minimum(count(SYMBOLS), 5) / 5], 1)
    return x, n_words


def base_columns(data, off):
    """The base counts of each text."""
    w = W.split_words(data, off)
    n_words = np.diff(w.starts)
    solid = ~W.IS_BLANK[data]
    letters = solid & ((data & 0xC0) != 0x80)
    symbols = SYMBOLS[data]
    lines = W.split_lines(data, off)
    used = np.fromiter((bool(v.strip(W.BLANKS)) for v in lines.vocab.to_pylist()), bool, len(lines.vocab))[lines.codes]
    who = W.owners(lines.starts)[used]
    pairs = np.unique(who * np.int64(max(1, len(lines.vocab))) + lines.codes[used])
    distinct = np.bincount(pairs // max(1, len(lines.vocab)), minlength=len(off) - 1)
    n_dup = np.bincount(who, minlength=len(off) - 1) - distinct
    repeat = repeated_words(w)
    return w, lines, n_words, W.sums(letters, off), W.sums(symbols, off), n_dup, repeat


def repeated_words(w, n=WINDOW):
    """Words inside ``n``-word windows that occur twice or more in their text."""
    out = np.zeros(len(w.starts) - 1, np.int64)
    if len(w.codes) < n:
        return out
    grams = W.gram_hashes(W.word_hashes(w.vocab)[w.codes], n)
    whole = W.whole_grams(w.starts, n, len(w.codes))
    who = W.owners(w.starts)[: len(grams)]
    mixed = np.where(whole, grams ^ (who.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), 0)
    order = np.argsort(mixed, kind="stable")
    same = (mixed[order][1:] == mixed[order][:-1]) & whole[order][1:]
    for i in np.unique(who[order[1:][same]]):
        # Equal hashes only choose the texts to look at; the windows themselves are compared here.
        codes = w.codes[w.starts[i] : w.starts[i + 1]].tolist()
        windows = list(zip(*(codes[k:] for k in range(n))))
        often = Counter(windows)
        hit = np.zeros(len(codes) + 1, np.int64)
        for k, g in enumerate(windows):
            if often[g] > 1:
                hit[k] += 1
                hit[k + n if k + n <= len(codes) else len(codes)] -= 1
        out[i] = int((np.cumsum(hit)[:-1] > 0).sum())
    return out


def viterbi(emit, starts, trans):
    """Best label sequence (1 is boilerplate) for each run of lines in ``starts``."""
    labels = np.zeros(len(emit), np.int8)
    (t00, t01), (t10, t11) = trans.tolist()
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if a == b:
            continue
        rows, back = emit[a:b].tolist(), []
        s0, s1 = rows[0]
        for e0, e1 in rows[1:]:
            p0, p1 = s0 + t00 >= s1 + t10, s0 + t01 > s1 + t11
            back.append((0 if p0 else 1, 0 if p1 else 1))
            s0, s1 = (s0 + t00 if p0 else s1 + t10) + e0, (s0 + t01 if p1 else s1 + t11) + e1
        label = 0 if s0 >= s1 else 1
        labels[b - 1] = label
        for k in range(b - a - 2, -1, -1):
            label = back[k][label]
            labels[a + k] = label
    return labels


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit_field(features, labels, starts, steps=80, rate=0.1, decay=1e-3):
    """Emission weights and transitions of a two-label field by gradient ascent on its likelihood."""
    n, longest = len(starts) - 1, int(np.diff(starts).max(initial=1))
    x = np.zeros((n, longest, features.shape[1]))
    y = np.zeros((n, longest), np.int64)
    mask = np.arange(longest) < np.diff(starts)[:, None]
    x[mask], y[mask] = features, labels
    w, t = np.zeros((features.shape[1], 2)), np.zeros((2, 2))
    moments = [np.zeros_like(p) for p in (w, t, w, t)]
    hot = np.eye(2)[y] * mask[..., None]
    pairs = mask[:, 1:, None, None] & True
    seen = np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:] * mask[:, 1:, None])
    for step in range(1, steps + 1):
        emit = x @ w
        fwd, bwd = np.zeros_like(emit), np.zeros_like(emit)
        fwd[:, 0] = emit[:, 0]
        for k in range(1, longest):
            new = _log_sum(fwd[:, k - 1, :, None] + t, 1) + emit[:, k]
            fwd[:, k] = np.where(mask[:, k, None], new, fwd[:, k - 1])
        z = _log_sum(fwd[:, -1], 1)
        for k in range(longest - 2, -1, -1):
            new = _log_sum(t + (emit[:, k + 1] + bwd[:, k + 1])[:, None, :], 2)
            bwd[:, k] = np.where(mask[:, k + 1, None], new, 0)
        prob = np.exp(fwd + bwd - z[:, None, None]) * mask[..., None]
        joint = np.exp(fwd[:, :-1, :, None] + t + (emit + bwd)[:, 1:, None, :] - z[:, None, None, None]) * pairs
        grads = [np.einsum("ntf,ntj->fj", x, hot - prob) / n - decay * w, (seen - joint.sum((0, 1))) / n - decay * t]
        for i, (p, g) in enumerate(zip((w, t), grads)):
            moments[i] = 0.9 * moments[i] + 0.1 * g
            moments[i + 2] = 0.99 * moments[i + 2] + 0.01 * g * g
            p += rate * moments[i] / (1 - 0.9**step) / (np.sqrt(moments[i + 2] / (1 - 0.99**step)) + 1e-8)
    return w, t


def _line_classifier(x, y, steps=30):
    """Logistic regression by Newton steps, both kinds weighted alike."""
    w = np.zeros(x.shape[1])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(x.shape[1])
        w += np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-4 * w)
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def fit_quality(docs: DataFrame, labels: DataFrame, max_docs: int = 1000, max_chars: int = 20_000, max_lines: int = 60):
    """Weights of the field from at most ``max_docs`` labelled documents of up to ``max_chars`` characters.

    The sample is the first labelled ids in the order of their hash, half of either kind at most.
    ``max_lines`` bounds the longest training sequence. These three bounds concern fitting alone.
    """
    one = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    half = [one.filter(F.col("quality") == q).orderBy(*order).limit(max_docs // 2) for q in (0, 1)]
    few = docs.select("doc_id", "text").filter(F.length("text") <= max_chars).join(F.broadcast(half[0].unionAll(half[1])), "doc_id")
    rows = sorted(few.collect(), key=lambda r: (r.doc_id, r.text))
    rows = [r for r in rows if r.text and r.text.count("\n") < max_lines]
    zero = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    if len({r.quality for r in rows}) < 2:
        return zero
    data, off = W.text_bytes(pa.array([r.text for r in rows], pa.string()))
    lines = W.split_lines(data, off)
    x, _ = line_features(data, off, lines)
    y = 1 - np.repeat([r.quality for r in rows], np.diff(lines.starts))
    bad = _line_classifier(x, y)
    # A bad document holds good lines too, a good one may hold boilerplate.
    y = np.where(y == 1, bad > 0.5, bad > 0.95).astype(np.int64)
    return fit_field(x, y, lines.starts)


def judge(weights, trans, min_share=0.5):
    """A column function: text to base counts and verdict."""

    @F.arrow_udf(returnType=RESULT)
    def verdict(text: pa.Array) -> pa.Array:
        parts = []
        for data, off in W.slices(text):
            _, lines, n, chars, symbols, dup, repeat = base_columns(data, off)
            x, per_line = line_features(data, off, lines)
            labels = viterbi(x @ weights, lines.starts, trans)
            content = W.sums(np.where(labels == 0, per_line, 0), lines.starts)
            share = content / np.maximum(n, 1)
            failed = (n < 20) | (100 * repeat > 30 * n)
            parts.append((n, chars, symbols, dup, repeat, failed, ~failed & (share >= min_share), share))
        names = [f.split()[0] for f in RESULT.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
        columns = [pa.array(np.concatenate([p[i] for p in parts]) if parts else [], k) for i, k in enumerate(kinds)]
        return pa.StructArray.from_arrays(columns, names)

    return verdict.asNondeterministic()  # evaluated once, also below a filter


def quality(docs: DataFrame, labels: DataFrame, text: Column = None, name: str = "quality_result", min_share: float = 0.5, **bounds) -> DataFrame:
    """``docs`` with a struct of the counts, ``base_failed``, ``kept`` and ``content_share``."""
    weights, trans = fit_quality(docs, labels, **bounds)
    return docs.withColumn(name, judge(weights, trans, min_share)(text if text is not None else F.col("text")))
