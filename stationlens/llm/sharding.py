"""Sharding by jump consistent hashing.

A key walks through jumps b -> floor((b + 1) / r) with r from a generator seeded by the key, and
its shard is the last jump below the number of shards. No ring table is needed, and one more
shard takes rows only into itself. The generator here is xxhash64 of the key and the step, so a
row's shard follows from its key and the shard count alone.

Defined cases: keys are taken as text; a null key is the empty text; repeated rows get the same shard and different
slots; a null text has size 1.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TWO_31 = 1 << 31
BUCKETS = 1024


def jump_shards(key: Column, shards: int, room: int = None) -> Column:
    """Struct (shard, grown): the shard of ``key`` among ``shards`` and among one more, from one walk.

    A walk makes about ln(shards) jumps. It gets ``room`` for several times as many; the few keys
    that need more go on in a second fold that is long enough for all, and that no other key pays for.
    """
    text = F.coalesce(key.cast("string"), F.lit(""))  # ids of any integer type are alike; null is an empty key

    def step(state, i):
        r = F.shiftrightunsigned(F.xxhash64(text, i), 33) + F.lit(1)
        ahead = ((state["j"] + 1) * F.lit(TWO_31) / r).cast("long")
        return F.struct(
            F.when(state["j"] < shards, state["j"]).otherwise(state["b"]).alias("b"),
            F.when(state["j"] <= shards, state["j"]).otherwise(state["g"]).alias("g"),
            F.when(state["j"] <= shards, ahead).otherwise(state["j"]).alias("j"),
        )

    room = min(shards + 1, room or 8 + 4 * shards.bit_length())
    start = F.struct(*[F.lit(v).cast("long").alias(n) for n, v in (("b", -1), ("g", -1), ("j", 0))])
    walk = F.aggregate(F.sequence(F.lit(0), F.lit(room - 1)), start, step)
    if room <= shards:
        rest = F.aggregate(F.sequence(F.lit(room), F.lit(shards)), walk, step)
        walk = F.when(walk["j"] <= shards, rest).otherwise(walk)
    return F.struct(walk["b"].cast("int").alias("shard"), walk["g"].cast("int").alias("grown"))


def jump_shard(key: Column, shards: int) -> Column:
    return jump_shards(key, shards)["shard"]


def with_slots(rows: DataFrame, shard: str, spread: list, slot: str = "slot", buckets: int = BUCKETS) -> DataFrame:
    """Gapless numbers from 0 inside each shard, without ordering a whole shard in one task.

    Rows fall into hash buckets of the columns ``spread``; buckets are counted, numbered by
    running totals over at most ``buckets`` rows a shard, and only ordered inside.
    """
    keyed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*spread), F.lit(buckets)))
    counts = keyed.groupBy(shard, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(shard, "_bucket", before.alias("_before"))
    place = F.row_number().over(Window.partitionBy(shard, "_bucket").orderBy(*spread)) - 1
    numbered = keyed.withColumn("_place", place)
    return numbered.join(offsets, [shard, "_bucket"]).withColumn(slot, (F.col("_before") + F.col("_place")).cast("long")).drop("_bucket", "_before", "_place")


def with_shards(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all columns and two more, ``shard`` and ``slot`` (lengthened where a column has that name)."""
    names = [n + "_" * max(0, max([len(c) - len(n) for c in docs.columns if c.lower().rstrip("_") == n], default=-1) + 1) for n in ("shard", "slot")]
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    size = F.coalesce(F.octet_length(text), F.lit(0)).alias("_size")
    rows = docs.select(whole, F.col(key).alias("_key"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_crc"), size, jump_shard(F.col(key), shards).alias("_shard"))
    numbered = with_slots(rows, "_shard", ["_key", "_crc", "_size"], "_slot")
    return numbered.select(*[F.col("_row")[c].alias(c) for c in docs.columns], F.col("_shard").alias(names[0]), F.col("_slot").alias(names[1]))


def shard_documents(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    k = F.col(key)
    walk = jump_shards(k, shards)
    rows = docs.select(
        k.alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        walk["shard"].alias("shard"),
        walk["grown"].alias("grown_shard"),
    )
    return with_slots(rows, "shard", ["doc_id", "text_crc32", "size"]).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
