"""Language identification by rank-order profiles.

A profile is a language's most frequent letter n-grams (1 to 3 letters with word borders) in
order of frequency, counted over all training texts. A text gets the language whose profile is
the least out of place: the summed distance between the ranks of the text's most frequent
n-grams and their ranks in the profile, n-grams outside the profile counting in full.

Defined cases: a null text and a text without letters are ``und`` with score 0; without any
training row every text is ``und``; equal distances go to the first language by name; n-grams of
equal count share their mean rank. Rows with a null language or id are never learned from.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlens.llm import words as W

PROFILE = 400
SALTS = 16
BORDER = 1
_CODES = []


def _letter_codes():
    """Small code of each character: 2 and up for letters, 0 for all others."""
    if not _CODES:
        table = np.zeros(0x110000, np.int64)
        points = np.array([c for c in range(0x110000) if chr(c).isalpha()])
        table[points] = np.where(points < 1022, points, 2 + points % 1021) + 0
        _CODES.append(np.minimum(np.maximum(table, 2 * (table > 0)), 1023))
    return _CODES[0]


def grams(text: str) -> np.ndarray:
    """Packed n-grams of a text's words; 10 bits a letter, the border sign at both ends of a word."""
    codes = _letter_codes()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    solid = codes > 0
    if not solid.any():
        return np.zeros(0, np.int64)
    # Runs of other characters collapse to one border.
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    row = np.concatenate([[BORDER], np.where(solid, codes, BORDER)[keep], [BORDER]])
    one = row[row > BORDER]
    a, b = row[:-1], row[1:]
    two = (a << 10 | b)[(a > BORDER) | (b > BORDER)]
    a, b, c = row[:-2], row[1:-1], row[2:]
    three = (a << 20 | b << 10 | c)[b > BORDER]
    return np.concatenate([one, two, three])


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n) over all rows, summed inside each task before the shuffle."""

    def tally(batches):
        kept = {}
        for batch in batches:
            for t, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = kept.setdefault(k, [[], 0])
                g = grams(t).astype(np.int32)
                own[0].append(g)
                own[1] += len(g)
                if own[1] > 2_000_000:
                    yield _tallied(k, own[0])
                    kept[k] = [[], 0]
        for k, (parts, n) in kept.items():
            if n:
                yield _tallied(k, parts)

    rows = docs.select(F.col(text).alias("t"), F.col(lang).alias("k")).filter("t is not null and k is not null")
    return rows.mapInArrow(tally, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _tallied(lang, parts):
    gram, n = np.unique(np.concatenate(parts), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram, pa.int32()), pa.array(n, pa.int64())], ["lang", "gram", "n"])


def profiles(docs: DataFrame, size: int = PROFILE, **columns) -> dict:
    """{language: its ``size`` most frequent n-grams in order}; that many values per language reach the driver."""
    counts = count_grams(docs, **columns).withColumn("salt", F.pmod("gram", F.lit(SALTS)))
    order = [F.desc("n"), F.col("gram")]
    near = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("r") <= size)
    best = near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("r") <= size)
    out = {}
    for row in sorted(best.select("lang", "r", "gram").collect()):
        out.setdefault(row.lang, []).append(row.gram)
    return {k: np.array(v, np.int64) for k, v in out.items()}


def detector(known: dict, size: int = PROFILE):
    """A column function: text to (lang_pred, score)."""
    names = sorted(known)
    sorters = [np.argsort(known[k]) for k in names]
    keys = [known[k][s] for k, s in zip(names, sorters)]

    def one(text):
        g = grams(text) if text else np.zeros(0, np.int64)
        if not len(g) or not names:
            return "und", 0.0
        gram, n = np.unique(g.astype(np.int32), return_counts=True)
        order = np.argsort(-n, kind="stable")[:size]
        gram, n = gram[order], n[order]
        # Mean rank of each run of equal counts.
        edge = np.flatnonzero(np.concatenate([[True], n[1:] != n[:-1], [True]]))
        rank = np.repeat((edge[:-1] + edge[1:] - 1) / 2, np.diff(edge))
        far = []
        for key, sorter in zip(keys, sorters):
            at = np.minimum(np.searchsorted(key, gram), len(key) - 1)
            there = key[at] == gram
            far.append(np.where(there, np.minimum(np.abs(rank - sorter[at]), size), size).sum())
        best = int(np.argmin(far))
        return names[best], float(1 - far[best] / (size * len(gram)))

    @F.arrow_udf(returnType="lang_pred string, score double")
    def detect(text: pa.Array) -> pa.Array:
        found = [one(t) for t in text.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang_pred", "score"])

    return detect.asNondeterministic()


def identify(docs: DataFrame, divisor: int = 5, size: int = PROFILE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, learned from the rows that are not held out."""
    known = profiles(docs.filter(~W.held_out("doc_id", divisor)), size)
    found = docs.select("doc_id", W.held_out("doc_id", divisor).alias("held_out"), detector(known, size)("text").alias("r"))
    return found.select("doc_id", "held_out", "r.lang_pred", "r.score")
