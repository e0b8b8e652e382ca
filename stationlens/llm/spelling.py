"""Spelling variants: words one edit apart, found by edits that a Bloom filter lets through.

The vocabulary (words counted over all texts) sets the bits of blocked Bloom filters, one shard
per word length. A shard is a table of blocks of 512 bits; a word hashes to one block and eight
bits, one in each 64-bit lane of the block. Blocks are made by a bitwise OR aggregated in Spark.
Tasks then generate, for each word, all deletions and all replacements by a later letter of the
vocabulary's alphabet and probe the shard of the edit's length. Positives alone are shuffled to an
exact join with the vocabulary, which removes the false ones. Insertions and replacements by
earlier letters are the same pairs seen from the other word.

Broadcast size: a filter has ``BITS`` bits a word. Shards are broadcast in rounds of at most
``ROUND_BYTES``; a length whose shard is larger is split into parts by block number, and the
edits of each round meet only the blocks of that round. So the broadcast is bounded whatever the
vocabulary, at one more pass over the vocabulary per round.

Edits are hashed without being spelled out: a word's hash is a sum of per-position products, so a
replacement changes one term and a deletion joins a prefix sum with a shifted suffix sum. Only
positives become strings. An edit whose hash equals that of another word passes the filter and
fails the join.

Defined cases: null and empty texts have no words; among near words of equal count the smallest in
code-point order is the form; repeated rows count twice; a null id takes part with the empty text
in its key; an empty table has no rows. Words are at most as long as their text; a word's edits
are taken in steps of bounded size.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlens.scratch import Scratch

LETTERS = "A-Za-zÀ-ÿ"
MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10
BITS = 16
LANES = 8
ROUND_BYTES = 64 << 20
STEP = 1 << 20
A = np.uint64(0x9E3779B97F4A7C15)
M = np.uint64(0xBF58476D1CE4E5B9)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * M
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n):
    out = np.ones(n, np.uint64)
    out[1:] = A
    return np.multiply.accumulate(out)


def _by_length(words: pa.Array):
    """(places, code points as a matrix) of the words of each length."""
    flat = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(w) for w in words.to_pylist()], np.int64)
    starts = np.cumsum(sizes) - sizes
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        yield int(n), at, flat[starts[at][:, None] + np.arange(n)]


def _terms(letters):
    """Per-letter factors; of letters alone, so that equal words hash alike everywhere."""
    return _mixed(letters.astype(np.uint64) + np.uint64(1)) | np.uint64(1)


def word_hash(letters):
    """Hash of each row of a matrix of code points."""
    return (_terms(letters) * _powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


def _place(h, blocks):
    """(block, bit of each lane) of hashes in a shard of ``blocks`` blocks."""
    h = _mixed(h)
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    bits = _mixed(h ^ A)
    return block.astype(np.int64), bits


def _lane(bits, k):
    return np.uint64(1) << ((bits >> np.uint64(6 * k)) & np.uint64(63))


def shard_blocks(vocabulary: DataFrame, bits: int = BITS) -> dict:
    """Number of blocks of each length's shard; one row per length comes to the driver."""
    rows = vocabulary.groupBy(F.char_length("word").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["size"]: max(1, -(-r["n"] * bits // (64 * LANES))) for r in rows}


def shard_rows(vocabulary: DataFrame, blocks: dict) -> DataFrame:
    """(size, block, l0..l7): the filled blocks of all shards."""
    names = [f"l{k}" for k in range(LANES)]

    def place(batches):
        for b in batches:
            for size, _, letters in _by_length(b.column("word")):
                block, bits = _place(word_hash(letters), blocks[size])
                lanes = [pa.array(_lane(bits, k).view(np.int64)) for k in range(LANES)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(block), size)), pa.array(block), *lanes], ["size", "block", *names])

    rows = vocabulary.select("word").mapInArrow(place, "size long, block long, " + ", ".join(f"{n} long" for n in names))
    return rows.groupBy("size", "block").agg(*[F.bit_or(n).alias(n) for n in names])


def rounds(blocks: dict, round_bytes: int = ROUND_BYTES) -> list:
    """Block ranges (size, from, to) grouped so that no group is larger than ``round_bytes``."""
    most = max(1, round_bytes // (8 * LANES))
    out, room = [[]], most
    for size, n in sorted(blocks.items()):
        a = 0
        while a < n:
            if not room:
                out.append([])
                room = most
            b = min(n, a + room)
            out[-1].append((size, a, b))
            room -= b - a
            a = b
    return out


def _filters(shards: DataFrame, group: list) -> dict:
    """The group's blocks as arrays, by length: (first block, lanes)."""
    wanted = F.lit(False)
    for size, a, b in group:
        wanted = wanted | ((F.col("size") == size) & F.col("block").between(a, b - 1))
    t = shards.filter(wanted).toArrow()
    size, block = t.column("size").to_numpy(), t.column("block").to_numpy()
    lanes = np.stack([t.column(f"l{k}").to_numpy() for k in range(LANES)], axis=1).view(np.uint64) if len(size) else np.zeros((0, LANES), np.uint64)
    out = {}
    for n, a, b in group:
        table = np.zeros((b - a, LANES), np.uint64)
        mine = size == n
        table[block[mine] - a] = lanes[mine]
        out[n] = (a, table)
    return out


def _probe(h, size, blocks, filters):
    """Places of ``h`` that the shard of words of ``size`` letters lets through."""
    a, table = filters[size]
    block, bits = _place(h, blocks[size])
    at = np.flatnonzero((block >= a) & (block < a + len(table)))
    block, bits = block[at] - a, bits[at]
    for k in range(LANES):
        lane = _lane(bits, k)
        hit = table[block, k] & lane != 0
        at, block, bits = at[hit], block[hit], bits[hit]
    return at


def _spelled(letters):
    """Strings of the rows of a matrix of code points."""
    n = letters.shape[1]
    text = letters.astype("<u4").tobytes().decode("utf-32-le")
    return [text[i : i + n] for i in range(0, len(text), n)] if n else [""] * len(letters)


def _positives(blocks, filters, alphabet):
    """Rows (word, n, near): the word and each edit of it that passes."""
    alphabet = np.array(alphabet, np.uint32)

    def probe(batches):
        for b in batches:
            words = b.column("word")
            for size, at, every in _by_length(words):
                width = max(size, 1) * max(len(alphabet), 1)
                for lo in range(0, len(at), max(1, STEP // width)):
                    letters = every[lo : lo + max(1, STEP // width)]
                    place = at[lo : lo + len(letters)]
                    power, terms = _powers(size), _terms(letters)
                    parts = terms * power
                    if size in filters:
                        total = parts.sum(axis=1, dtype=np.uint64)
                        for i in range(size):  # one position at a time; replacements by later letters alone
                            row, col = np.nonzero(letters[:, i][:, None] < alphabet[None, :])
                            h = (total - parts[:, i])[row] + (_terms(alphabet) * power[i])[col]
                            hit = _probe(h, size, blocks, filters)
                            if len(hit):
                                edited = letters[row[hit]]
                                edited[:, i] = alphabet[col[hit]]
                                yield _rows(b, place[row[hit]], edited)
                    if size - 1 in filters:
                        after = np.cumsum((terms * power)[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
                        before = np.cumsum(parts, axis=1, dtype=np.uint64)
                        # Letters behind the deleted one move a place to the front: their sum is divided by A.
                        inverse = np.uint64(pow(int(A), -1, 1 << 64))
                        for i in range(size):
                            h = (before[:, i - 1] if i else np.uint64(0)) + (after[:, i + 1] * inverse if i + 1 < size else np.uint64(0))
                            first = letters[:, i] != letters[:, i - 1] if i else np.ones(len(letters), bool)  # one of equal neighbours
                            row = np.flatnonzero(first)
                            hit = _probe(np.broadcast_to(h, (len(letters),))[row], size - 1, blocks, filters)
                            if len(hit):
                                yield _rows(b, place[row[hit]], np.delete(letters[row[hit]], i, axis=1))

    return probe


def _rows(b, place, edited):
    taken = b.take(pa.array(place))
    return pa.RecordBatch.from_arrays([taken.column("word"), taken.column("n"), pa.array(_spelled(edited), pa.string())], ["word", "n", "near"])


def near_pairs(vocabulary: DataFrame, scratch: Scratch, round_bytes: int = ROUND_BYTES, bits: int = BITS) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words of ``vocabulary`` (word, n) that are one edit apart."""
    spark = vocabulary.sparkSession
    blocks = shard_blocks(vocabulary, bits)
    shards = scratch.put("shards", shard_rows(vocabulary, blocks))
    letters = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct()
    alphabet = sorted(ord(r["c"]) for r in letters.collect() if r["c"])  # distinct letters: at most the pattern's classes
    passed = None
    for group in rounds(blocks, round_bytes):
        filters = spark.sparkContext.broadcast(_filters(shards, group))
        found = scratch.put("passed", vocabulary.select("word", "n").mapInArrow(_lazily(blocks, filters, alphabet), "word string, n long, near string"))
        filters.destroy()  # one round's filters are in memory at a time
        passed = found if passed is None else passed.unionAll(found)
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = scratch.put("pairs", passed.join(known, "near").select("word", "n", "near", "near_n"))
    return pairs.unionAll(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def _lazily(blocks, filters, alphabet):
    def run(batches):
        return _positives(blocks, filters.value, alphabet)(batches)

    return run


def edited_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS, one_in: int = 31) -> DataFrame:
    """One row ``word`` per run of letters, A-Z lowered; of one in ``one_in``, by hash of id and run, a letter is deleted."""
    runs = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"), F.explode(F.expr(f"regexp_extract_all(`{text}`, '[{LETTERS}]{{{min_letters},}}', 0)")).alias("w"))
    runs = runs.select("k", F.translate("w", UPPER, LOWER).alias("w"))
    runs = runs.select("w", F.crc32(F.concat_ws(":", "k", "w").cast("binary")).alias("h"))
    cut = F.expr("concat(substring(w, 1, cast(h % char_length(w) as int)), substring(w, cast(h % char_length(w) as int) + 2))")
    return runs.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("w")).alias("word")).filter(F.char_length("word") >= min_letters)


def vocabulary_of(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``min_count`` occurrences."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) for (word, form): the end of each chain of forms, by doubling the steps taken."""
    state = scratch.put("steps", forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = state.drop("moved").join(ahead, "root", "left")
        previous, state = state, scratch.put("steps", steps.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        scratch.drop(previous)
        if state.filter("moved").isEmpty():
            return state.drop("moved")


def spelling_groups(vocabulary: DataFrame, ratio: int = RATIO, round_bytes: int = ROUND_BYTES, bits: int = BITS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``vocabulary`` (word, n)."""
    scratch = Scratch(vocabulary.sparkSession, "spelling")
    vocabulary = scratch.put("vocabulary", vocabulary.select("word", "n"))
    pairs = near_pairs(vocabulary, scratch, round_bytes, bits)
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))
    per = pairs.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("b"))
    per = scratch.put("near", per.select("word", "n_near", F.when(-F.col("b.m") >= ratio * F.col("n"), F.struct(F.col("b.near").alias("form"), (-F.col("b.m")).alias("form_n"))).alias("f")))
    ends = roots(per.filter("f is not null").select("word", "f.form"), scratch)
    out = vocabulary.join(per, "word", "left").join(ends, "word", "left")
    return out.select("word", F.col("f.form").alias("form"), F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("f.form_n").alias("form_n"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Spelling groups of all words of at least seven letters and two occurrences in ``docs``."""
    return spelling_groups(vocabulary_of(edited_runs(docs)))
