"""Words and lines of Arrow text columns, as NumPy arrays.

A word is a run of characters other than space and U+0009 to U+000D. All helpers take whole
texts, count null as the empty text and work on slices of bounded size, so that a task's memory
follows its longest text and not its batch.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = b" \t\n\x0b\x0c\r"
IS_BLANK = np.isin(np.arange(256), list(BLANKS))
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
SLICE_BYTES = 4 << 20


class Words(NamedTuple):
    """``codes`` of all words in order, ``vocab`` by code, and each text's first word in ``starts``."""

    codes: np.ndarray
    vocab: pa.Array
    starts: np.ndarray


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor


def held_out(doc_id: str, divisor: int) -> Column:
    """True where the remainder is 0; a row without an id is held out, so nothing is learned from it."""
    return F.coalesce(remainder(doc_id, divisor) == 0, F.lit(True))


def text_bytes(column: pa.Array):
    """(UTF-8 bytes, n + 1 offsets) of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(flat):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = flat.buffers()
    off = np.frombuffer(offsets, np.int64)[flat.offset : flat.offset + len(flat) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(bytes, offsets) of consecutive groups of texts, each up to ``limit`` bytes or one text."""
    data, off = text_bytes(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def split_words(data: np.ndarray, off: np.ndarray, lower: bool = True) -> Words:
    """Words, with A-Z lowered unless ``lower`` is false."""
    solid = ~IS_BLANK[data]
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    first = off[:-1][off[:-1] < off[1:]]
    start[first] = solid[first]
    at = np.flatnonzero(start)
    kept = LOWER[data[solid]] if lower else data[solid]
    index = np.cumsum(solid, dtype=np.int32 if solid.size < 1 << 31 else np.int64)
    return _encoded(kept, np.append(index[at] - 1, kept.size), np.searchsorted(at, off))


def split_lines(data: np.ndarray, off: np.ndarray) -> Words:
    """Lines between newlines, unchanged; the empty text has one empty line."""
    newline = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([off[:-1], newline + 1]), kind="stable")
    # A newline that ends a text opens an empty last line there, which sorts before the next text's first.
    starts = np.append(np.searchsorted(newline, off[:-1]) + np.arange(len(off) - 1), len(begin))
    body = data[data != 10]
    lost = np.searchsorted(newline, begin)
    return _encoded(body, np.append(begin - lost, body.size), starts)


def _encoded(body, offsets, starts):
    n = len(offsets) - 1
    flat = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(body))])
    coded = flat.dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, starts)


def hashes_of(words: list) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def word_hashes(vocab: pa.Array) -> np.ndarray:
    return hashes_of(vocab.to_pylist())


def owners(starts: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` values from each position on, for all but the last n - 1 positions."""
    m = max(0, len(hashes) - n + 1)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = (out ^ hashes[i : i + m]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def whole_grams(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """True where the ``n`` words from a position on lie in one text."""
    m = max(0, size - n + 1)
    ok = np.ones(m, bool)
    for s in starts[1:-1]:
        ok[max(0, s - n + 1) : s] = False
    return ok


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``values`` per text."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]
