"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words sums over their common subsequences of three letters, each occurrence
weighted by ``DECAY`` to the power of the stretch it spans, so that gapped insults and insults
with inserted letters stay near the plain ones. Words are compared with landmark words; the
Nyström map turns kernel values into coordinates for a linear machine with squared hinge loss.
Labels belong to documents, so training alternates between choosing the witness word of each
toxic document and fitting the machine (multiple-instance learning). A logistic function of the
strongest words of a text, fitted on the training documents, gives the score.

A word's decision value is linear in its subsequences, so scoring looks up one weight per
subsequence; this equals the sum over the landmarks.

Defined cases: null and empty texts have no words and get the score of a text without evidence;
long words are cut into overlapping pieces, so the whole text counts; spaced-out single letters
are joined into one word; without labels of both kinds every score is 0.
"""

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlens.llm import words as W

DECAY = 0.6
SPAN = 6
PIECE = 20
SIZE = 64
MEMORY = 500_000
EDGE = 63
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}
# Single letters with separators between; the two share no sign and neither can give any back, so a scan is linear.
SPACED = re.compile(r"(?<!\S)[^\W_](?:[\s.*_-]++[^\W_](?![^\W_])){2,}+")
NOT_WORD = re.compile(r"[\W_]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
OFFSETS = [(a, b) for a in range(1, SPAN - 1) for b in range(a + 1, SPAN)]


def plain(word: str) -> str:
    """Lower case, digits that stand for letters replaced, all other signs removed."""
    w = word.lower()
    if not w.isalpha():
        w = NOT_WORD.sub("", "".join(LEET.get(c, c) for c in w) if any(c.isalpha() for c in w) else w)
    return w


def tokens(text: str):
    """Set of plain words of a text, spaced-out ones joined."""
    found = set(WORD.findall(text))
    for m in SPACED.finditer(text):
        found.add("".join(m.group().split()))
    return found


def encode(words) -> tuple:
    """(matrix of letter codes, owner of each row); words over ``PIECE`` letters become overlapping rows."""
    rows, owner = [], []
    for i, w in enumerate(words):
        if len(w) <= PIECE:
            rows.append(w)
            owner.append(i)
        else:
            step = PIECE // 2
            cut = [w[k : k + PIECE] for k in range(0, len(w) - step, step)]
            rows += cut
            owner += [i] * len(cut)
    flat = "".join(r.ljust(PIECE, "\0") for r in rows).encode("utf-32-le", "surrogatepass")
    c = np.frombuffer(flat, np.uint32).reshape(len(rows), PIECE).astype(np.int32)
    letters = np.where(c == 0, 0, np.where((c >= 97) & (c <= 122), c - 96, 27 + c % 36))
    edge = np.full((len(rows), 1), EDGE, np.int32)
    return np.concatenate([edge, letters], 1), np.array(owner, np.int64)


def _subsequences(m):
    """(keys, weights) of the three-letter subsequences, 0 for those that leave the word."""
    keys, weights = [], []
    for a, b in OFFSETS:
        x, y, z = m[:, : -b or None], m[:, a : m.shape[1] - b + a], m[:, b:]
        keys.append(np.where(z > 0, (x * SIZE + y) * SIZE + z, 0))
        weights.append(np.full(keys[-1].shape[1], DECAY ** (b + 1), np.float32))
    return np.concatenate(keys, 1), np.concatenate(weights)


def _norms(keys, weights):
    """Length of each word in the space of subsequences, as for one without repeated subsequences."""
    return np.sqrt((keys > 0) @ (weights * weights)) + 1e-9


def _vectors(words):
    """Dense normalised subsequence vectors of a few words (the landmarks)."""
    m, owner = encode([w[:PIECE] for w in words])
    keys, weights = _subsequences(m)
    out = np.zeros((len(words), SIZE**3), np.float32)
    for i, o in enumerate(owner):
        np.add.at(out[o], keys[i], np.where(keys[i] > 0, weights, 0))
    return out / (np.linalg.norm(out, axis=1, keepdims=True) + 1e-9)


def decisions(words, table, bias, chunk=20_000):
    """Decision value of each plain word under the subsequence weights ``table``."""
    out = np.full(len(words), -1.0)
    for s in range(0, len(words), chunk):
        m, owner = encode(words[s : s + chunk])
        if len(m):
            keys, weights = _subsequences(m)
            value = table[keys] @ weights / _norms(keys, weights) + bias
            np.maximum.at(out, owner + s, value)
    return out


def _features(words, landmarks, chunk=20_000):
    """Kernel values of words against landmark vectors."""
    out = np.zeros((len(words), len(landmarks)))
    m, owner = encode([w[:PIECE] for w in words])
    for s in range(0, len(m), chunk):
        keys, weights = _subsequences(m[s : s + chunk])
        norm = _norms(keys, weights)
        for j, v in enumerate(landmarks):
            out[s : s + chunk, j] = v[keys] @ weights / norm
    return out


def _hinge(x, y, weight, ridge=1e-4, steps=40):
    """Squared-hinge machine by Newton steps on the rows inside the margin, halved where they overshoot."""

    def loss(w):
        return (weight * np.maximum(1 - y * (x @ w), 0) ** 2).sum() + ridge * (w @ w)

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(steps):
        live = (1 - y * (x @ w)) > 0
        a = x[live] * weight[live, None]
        step = np.linalg.solve(a.T @ x[live] + ridge * np.eye(x.shape[1]), a.T @ y[live]) - w
        size = 1.0
        while size > 1e-3 and loss(w + size * step) > now:
            size /= 2
        new = loss(w + size * step)
        if now - new < 1e-7:
            break
        w, now = w + size * step, new
    return w


def evidence(values):
    """What the score of a text is a function of: its strongest words and how much of it is suspect."""
    if not len(values):
        return [-1.0, 0.0, 0.0, 0.0, 1.0]
    top = max(values)
    live = [v for v in values if v > 0]
    return [max(top, -1.0), min(sum(live), 5.0), float(np.log1p(len(live))), min(1.0, 10 * len(live) / (10 + len(values))), 1.0]


def _logistic(x, y, steps=50):
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1]), x.T @ (y - p) - 1e-2 * w)
    return w


def fit(rows, n_landmarks=96, rounds=2, per_side=6_000):
    """(table, bias, logistic weights) from (text, toxic) rows, or None without both labels."""
    y = np.array([t for _, t in rows])
    if not len(y) or y.min() == y.max():
        return None
    bags = [sorted({p for p in map(plain, tokens(t)) if p}) for t, _ in rows]
    # First guess: letter runs at the start of words and inside them that toxic documents hold more often.
    seen = {}
    for bag, t in zip(bags, y):
        for g in {g for w in bag for g in _runs(w)}:
            seen.setdefault(g, [0, 0])[t] += 1
    n1, n0 = y.sum(), len(y) - y.sum()
    odds = {g: np.log((b + 0.3) / (n1 + 0.6)) - np.log((a + 0.3) / (n0 + 0.6)) for g, (a, b) in seen.items() if b >= 3}
    guess = {w: max((odds.get(g, -9.0) for g in _runs(w)), default=-9.0) for bag in bags for w in bag}
    clean = {}
    for bag, t in zip(bags, y):
        if not t:
            for w in bag:
                clean[w] = clean.get(w, 0) + 1
    often = sorted(clean, key=lambda w: (-clean[w], w))
    negatives = often[: per_side // 3] + sorted(often[per_side // 3 :], key=lambda w: (-guess[w], w))[: per_side // 3]
    rest = sorted(set(often) - set(negatives))
    negatives += rest[:: max(1, len(rest) // (per_side // 3))]
    value = guess
    for turn in range(rounds):
        # Witnesses: the best word of each toxic bag and all others that speak as clearly.
        sure = 3.5 if turn == 0 else 0.5
        witness = []
        for bag, t in zip(bags, y):
            able = [w for w in bag if clean.get(w, 0) <= 2] if t else []
            best = max(able, key=lambda w: (value[w], w), default=None)
            witness += [w for w in able if w == best or value[w] >= sure and guess[w] >= 2.0]
        common = {}
        for w in witness:
            common[w] = common.get(w, 0) + 1
        chosen = sorted(common, key=lambda w: (-common[w], w))
        # Variants with one inserted letter teach how far an insult may be stretched.
        bent = {w[:k] + "xzq"[k % 3] + w[k:]: common[w] / 4 for w in chosen[:200] if len(w) > 3 for k in (2, len(w) - 1)}
        positives = chosen[:per_side] + [w for w in bent if w not in common]
        pick = chosen[: n_landmarks // 2] + [negatives[i] for i in np.linspace(0, len(negatives) - 1, n_landmarks // 2).astype(int)]
        vectors = _vectors(pick)
        gram = vectors @ vectors.T + 1e-3 * np.eye(len(pick))
        e, u = np.linalg.eigh(gram)
        half = (u / np.sqrt(np.maximum(e, 1e-6))) @ u.T
        k = _features(positives + negatives, vectors) @ half
        x = np.concatenate([k, np.ones((len(k), 1))], 1)
        sign = np.array([1.0] * len(positives) + [-1.0] * len(negatives))
        rare = np.sqrt(np.array([clean[w] for w in negatives], float))
        mass = np.array([common.get(w) or bent[w] for w in positives], float)
        weight = np.concatenate([mass / mass.sum(), 3.0 * rare / rare.sum()])
        w = _hinge(x, sign, weight)
        table, bias = (half @ w[:-1]) @ vectors, w[-1]
        table[0] = 0
        suspects = sorted({w for bag, t in zip(bags, y) if t for w in bag})
        value = dict(zip(suspects, decisions(suspects, table, bias).tolist()))
    every = sorted({w for bag in bags for w in bag})
    value = dict(zip(every, decisions(every, table, bias).tolist()))
    x = np.array([evidence([value[w] for w in bag]) for bag in bags])
    return table.astype(np.float32), float(bias), _logistic(x, y)


def _runs(word):
    w = "^" + word
    return [w[i : i + n] for n in (4, 5, 6) for i in range(len(w) - n + 1)]


def sample(docs: DataFrame, labels: DataFrame, divisor: int, max_docs: int, max_chars: int):
    """At most ``max_docs`` labelled training rows, half of either label, in the order of the id's hash."""
    one = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    one = one.filter(~W.held_out("doc_id", divisor))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    half = [one.filter(F.col("toxic") == t).orderBy(*order).limit(max_docs // 2) for t in (0, 1)]
    few = docs.select("doc_id", "text").filter(F.length("text") <= max_chars).join(F.broadcast(half[0].unionAll(half[1])), "doc_id")
    return [(r.text, r.toxic) for r in sorted(few.collect(), key=lambda r: (r.doc_id, r.text))]


def scorer(model):
    """A column function: text to score."""

    @F.arrow_udf(returnType="double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = {}  # words already judged by this task
        for text in batches:
            if model is None:
                yield pa.array(np.zeros(len(text)))
                continue
            table, bias, w = model
            out = []
            rows = text.to_pylist()
            for s in range(0, len(rows), 500):
                bags = [tokens(t) if t else set() for t in rows[s : s + 500]]
                if len(known) > MEMORY:
                    known = {}
                raw = list(set().union(*bags) - known.keys())
                shape = [plain(r) for r in raw]
                distinct = sorted({p for p in shape if p})
                value = dict(zip(distinct, decisions(distinct, table, bias).tolist()))
                known.update((r, value.get(p, -1.0)) for r, p in zip(raw, shape))
                for bag in bags:
                    z = float(np.dot(evidence([known[r] for r in bag]), w))
                    out.append(1 / (1 + math.exp(-min(max(z, -30.0), 30.0))))
            yield pa.array(out, pa.float64())

    return score.asNondeterministic()


def toxicity(docs: DataFrame, labels: DataFrame, divisor: int = 5, max_docs: int = 2000, max_chars: int = 10_000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; labels of held-out ids are never used."""
    model = fit(sample(docs, labels, divisor, max_docs, max_chars))
    found = docs.select("doc_id", W.held_out("doc_id", divisor).alias("held_out"), scorer(model)("text").alias("score"))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
