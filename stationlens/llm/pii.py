"""Personal data by candidate gradient boosting.

Strict patterns find e-mail addresses, IP addresses, card numbers and telephone numbers; their
spans always stay. Loose generators propose more, overlapping spans (spelled-out or bracketed
addresses, numbers with other separators or without a plus sign). Boosted regression trees judge
the candidates by their format and context, and a threshold per kind, calibrated for precision
on candidates kept from training, selects what is added. Of overlapping spans of a kind the base
span stays, then the candidate of higher probability.

Training data are made from the corpus: strict spans of a bounded sample in their own context,
as they are and rewritten in the loose formats, against numbers, words and broken variants in the
same contexts.

Defined cases: null and empty texts have no spans; without any strict span in the sample no tree
is trained and only base spans are returned. Positions are code points, the end is exclusive.
"""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOOSE = {
    "email": re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{2,63}){1,4}"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?(?:\[\.\]|\(\.\)|\.) ?[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./_-]{0,2}[0-9]{4}){2}[ ./_-]{0,2}[0-9]{1,7}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:00[0-9]{1,3}[ .-]?|[0-9]{1,2}[ .-])?\(?[0-9]{3}\)?[ ./-][0-9]{3}[ ./-][0-9]{4}(?![0-9])"),
}
HINTS = re.compile(r"mail|contact|phone|tel|call|fax|card|visa|pay|addr|host|server|ip\b", re.I)
N_FEATURES = 14


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text):
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = HOST.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> dict:
    """{kind: strict spans}, leftmost and non-overlapping; each pattern runs in linear time."""
    out = {k: [] for k in KINDS}
    out["email"] = _emails(text)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out["ip"].append(m.span())
    for m in CARD.finditer(text):
        d = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(d) <= 19 and luhn(d):
            out["card"].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out["phone"].append(m.span())
    return out


def candidates(text: str):
    """(kind, start, end) from the loose generators; they overlap."""
    for kind in KINDS:
        if kind == "email" and "@" not in text and " at " not in text and "at)" not in text and "at]" not in text:
            continue
        for m in LOOSE[kind].finditer(text):
            yield kind, m.start(), m.end()


def features(text: str, kind: str, start: int, end: int) -> list:
    body, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 8]
    digits = "".join(c for c in body if c.isdigit())
    parts = re.split(r"[^0-9]+", body)
    return [
        KINDS.index(kind), len(body), len(digits), sum(c.isalpha() for c in body), sum(c in " ()[]" for c in body), sum(c in ".-/_" for c in body),
        float("@" in body), float(luhn(digits)) if len(digits) > 11 else 0.5, max([int(p[-4:]) for p in parts if p] or [0]) > 255, len([p for p in parts if p]),
        float(bool(HINTS.search(before))), float(before[-1:].isalnum()), float(after[:1].isalnum()), len(set(digits)),
    ]


class Boosted:
    """Gradient boosting of depth-2 regression trees on logistic loss, cuts at quantiles."""

    def __init__(self, rounds=40, rate=0.3, cuts=16):
        self.rounds, self.rate, self.cuts, self.trees, self.start = rounds, rate, cuts, [], 0.0

    def _split(self, x, g, h, rows):
        best = (1e-9, None, None)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        for f in range(x.shape[1]):
            v = x[rows, f]
            for c in np.unique(np.quantile(v, np.linspace(0.05, 0.95, self.cuts), method="nearest")):
                left = v <= c
                gl, hl = g[rows][left].sum(), h[rows][left].sum()
                gain = gl * gl / (hl + 1) + (total_g - gl) ** 2 / (total_h - hl + 1) - total_g**2 / (total_h + 1)
                if gain > best[0]:
                    best = (gain, f, c)
        return best[1:]

    def fit(self, x, y):
        p = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        z = np.full(len(y), self.start)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-z))
            g, h = y - q, q * (1 - q)
            tree, level = [], [np.arange(len(y))]
            for depth in range(3):
                nxt = []
                for rows in level:
                    f, c = self._split(x, g, h, rows) if depth < 2 and len(rows) > 4 else (None, None)
                    if f is None:
                        tree.append((None, None, self.rate * g[rows].sum() / (h[rows].sum() + 1)))
                        nxt += [rows, rows] if depth < 2 else []
                    else:
                        tree.append((f, c, 0.0))
                        nxt += [rows[x[rows, f] <= c], rows[x[rows, f] > c]]
                level = nxt
            self.trees.append(tree)
            z += self._tree(tree, x)
        return self

    @staticmethod
    def _tree(tree, x):
        node, out, done = np.zeros(len(x), int), np.zeros(len(x)), np.zeros(len(x), bool)
        for _ in range(3):
            for n in np.unique(node[~done]):
                rows = (node == n) & ~done
                f, c, value = tree[n]
                if f is None:
                    out[rows] = value
                    done |= rows
                else:
                    node[rows] = 2 * n + 1 + (x[rows, f] > c)
        return out

    def probability(self, x):
        z = np.full(len(x), self.start)
        for t in self.trees:
            z += self._tree(t, x)
        return 1 / (1 + np.exp(-z))


def _rewritten(kind, value, r):
    """The same datum in other formats."""
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "email":
        user, _, host = value.partition("@")
        return [f"{user} at {host.replace('.', ' dot ')}", f"{user} (at) {host}", f"{user}[at]{host.replace('.', '[dot]')}", f"{user} @ {host}"]
    if kind == "ip":
        return [value.replace(".", "[.]"), value.replace(".", " . ")]
    if kind == "card":
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [".".join(groups), "/".join(groups), "_".join(groups)]
    if len(digits) < 10:
        return []
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}"]


def _broken(kind, value, r):
    """Strings of like form that are no such datum."""
    digits = [str(r.randrange(10)) for _ in range(16)]
    n = "".join(digits)
    if kind == "email":
        return [f"look at {r.choice('abc')}that. {r.choice('xyz')}ere", f"was at home. then"]
    if kind == "ip":
        return [".".join(str(r.randrange(300, 999)) for _ in range(4)), f"1.{n[0]}.{n[1]}. {n[2]}"]
    if kind == "card":
        bad = n if not luhn(n) else n[:-1] + str((int(n[-1]) + 1) % 10)
        return [bad, "/".join(bad[i : i + 4] for i in range(0, 16, 4)), ".".join(bad[i : i + 4] for i in range(0, 16, 4))]
    return [f"{n[:3]}/{n[3:6]}/{n[6:10]}", f"{n[0]} {n[1:4]} {n[4:7]} {n[7:11]} ", f"{n[:3]}.{n[3:6]}.{n[6:10]}{n[10]}"]


def training_rows(texts, seed=5, most=400):
    """(features, label) of candidates in the sample and of rewritten and broken ones in the same contexts."""
    r, x, y = random.Random(seed), [], []
    for text in texts:
        strict = base_spans(text)
        for kind in KINDS:
            for a, b in strict[kind][:3]:
                for label, values in ((1, [text[a:b], *_rewritten(kind, text[a:b], r)]), (0, _broken(kind, text[a:b], r))):
                    for v in values:
                        made = text[max(0, a - 60) : a] + v + text[b : b + 60]
                        at = min(a, 60)
                        for k, s, e in candidates(made):
                            if s < at + len(v) and e > at:
                                x.append(features(made, k, s, e))
                                y.append(label if k == kind and s >= at - 1 and e <= at + len(v) + 1 else 0)
        if len(y) > 12 * most:
            break
    return np.array(x, float).reshape(len(x), N_FEATURES), np.array(y, float)


def fit(texts, precision=0.98):
    """(trees, {kind: threshold}) or None; a kind whose precision is never reached gets a threshold over 1."""
    x, y = training_rows(texts)
    if len(y) < 40 or y.min() == y.max():
        return None
    held = np.arange(len(y)) % 4 == 0
    model = Boosted().fit(x[~held], y[~held])
    p, limits = model.probability(x[held]), {}
    for i, kind in enumerate(KINDS):
        own, truth = p[x[held][:, 0] == i], y[held][x[held][:, 0] == i]
        limits[kind] = 1.1
        for t in sorted(set(np.round(own, 3)), reverse=True):
            chosen = own >= t
            if t < 0.5 or truth[chosen].mean() < precision:
                break
            limits[kind] = float(t)
    return model, limits


def find(text: str, model):
    """({kind: base spans}, all spans as (kind index, start, end))."""
    strict = base_spans(text)
    spans = [(i, a, b) for i, k in enumerate(KINDS) for a, b in strict[k]]
    if model is not None:
        trees, limits = model
        proposed = [(k, a, b) for k, a, b in candidates(text) if not any(a < d and b > c for c, d in _near(strict[k], a, b))]
        if proposed:
            p = trees.probability(np.array([features(text, *c) for c in proposed], float))
            taken = {k: [] for k in KINDS}
            for q, (k, a, b) in sorted(zip(p.tolist(), proposed), key=lambda c: (-c[0], c[1][1], c[1][2])):
                if q >= limits[k] and not any(a < d and b > c for c, d in taken[k]):
                    taken[k].append((a, b))
                    spans.append((KINDS.index(k), a, b))
    return strict, sorted(spans)


def _near(spans, a, b):
    """The sorted ``spans`` that can touch [a, b)."""
    lo, hi = 0, len(spans)
    while lo < hi:
        mid = (lo + hi) // 2
        if spans[mid][1] <= a:
            lo = mid + 1
        else:
            hi = mid
    return spans[lo : lo + 1]


def sample(docs: DataFrame, max_docs: int = 1500, max_chars: int = 10_000):
    """Texts with an at sign, a plus sign or a long number, the first by the id's hash."""
    rows = docs.select("doc_id", "text").filter((F.length("text") <= max_chars) & F.col("text").rlike(r"@|\+[0-9]|[0-9]{4}"))
    return [r.text for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(max_docs).collect()]


def detector(model):
    """A column function: text to counts of base spans, their digest and all spans."""

    @F.arrow_udf(returnType="n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def detect(text: pa.Array) -> pa.Array:
        counts, digests, spans = [[] for _ in KINDS], [], []
        for t in text.to_pylist():
            strict, every = find(t or "", model)
            for c, k in zip(counts, KINDS):
                c.append(len(strict[k]))
            base = ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in strict[k])
            digests.append(hashlib.sha256(base.encode()).hexdigest())
            spans.append(",".join(f"{KINDS[i]}:{a}:{b}" for i, a, b in every))
        columns = [pa.array(c, pa.int64()) for c in counts] + [pa.array(digests, pa.string()), pa.array(spans, pa.string())]
        return pa.StructArray.from_arrays(columns, ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return detect.asNondeterministic()


def personal_data(docs: DataFrame, **bounds) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row."""
    model = fit(sample(docs, **bounds))
    return docs.select("doc_id", detector(model)("text").alias("r")).select("doc_id", "r.*")


def redact(text: str, model) -> str:
    """``text`` with every span replaced by its kind."""
    out, last = [], 0
    for i, a, b in sorted(find(text, model)[1], key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[last:a], f"[{KINDS[i]}]"]
            last = b
        last = max(last, b)
    return "".join(out) + text[last:]
