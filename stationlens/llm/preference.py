"""Chat formatting of preference pairs.

Chosen and rejected conversations are compared turn by turn; their longest common prefix is
rendered once as the prompt, and what follows becomes two completions. The loss mask is 1 on the
assistant's turns of a completion and 0 on all else. The output has one row per rendered turn, so
no conversation is ever gathered into one row or task; ``assemble`` joins the turns of
conversations known to fit a row.

Pairs are rows (pair_id, side, turn, role, text). ``exchanged`` makes them from one table of
conversations: a conversation is chosen, and rejected where its last assistant turn has the text of
its neighbour's; ``paired`` takes two whole conversations.

Defined cases: turns are in the order of ``turn``; rows that repeat (conv_id, turn) count once,
the smallest (role, text) of them; rows with a null conv_id or turn belong to no conversation; a
null role is ``user`` and a null text is empty; equal conversations have a prompt and no
completion; a conversation without a partner, or where one of the two has no assistant turn, is no
pair; an exchanged conversation ends with the exchanged turn. Texts of any length pass whole.
Marks inside a text are broken up, so that a text cannot open or close a turn.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def clean_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), one row per turn."""
    said = F.min(F.struct(F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("s")
    return turns.filter("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(said).select("conv_id", "turn", "s.role", "s.text")


def render(role: Column, text: Column) -> Column:
    safe = F.replace(F.replace(text, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))
    return F.concat(F.lit("<|"), F.replace(F.replace(role, F.lit("<|"), F.lit("")), F.lit("|>"), F.lit("")), F.lit("|>\n"), safe, F.lit("\n<|end|>\n"))


def pair_up(turns: DataFrame, shared_turns: bool = False) -> DataFrame:
    """(pair_id, chosen, rejected) of conversations, each used once.

    By default neighbours by id, 2k (chosen) and 2k + 1, where both exist. ``shared_turns`` pairs
    conversations with the same first turn instead, in the order of their ids inside salted
    parts of a group and then among the parts' odd ones, so that a first turn with many
    conversations is spread over tasks; the smaller id is chosen.
    """
    if not shared_turns:
        ids = turns.select("conv_id").distinct()
        slots = ids.groupBy(F.shiftright("conv_id", 1).alias("pair_id")).agg(F.min("conv_id").alias("chosen"), F.max("conv_id").alias("rejected"))
        return slots.filter("chosen <> rejected")
    first = turns.groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text")).alias("f"))
    keyed = first.select("conv_id", F.sha2(F.concat_ws("|", "f.role", "f.text"), 256).alias("k"), F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).alias("salt"))
    inner = _neighbours(keyed, ["k", "salt"])
    odd = keyed.join(inner.select(F.explode(F.array("chosen", "rejected")).alias("conv_id")), "conv_id", "left_anti")
    both = inner.unionByName(_neighbours(odd, ["k"]))
    return both.select(F.col("chosen").alias("pair_id"), "chosen", "rejected")


def _neighbours(rows, keys):
    w = Window.partitionBy(*keys).orderBy("conv_id")
    n = rows.withColumn("_i", F.row_number().over(w) - 1).withColumn("_next", F.lead("conv_id").over(w))
    return n.filter("_i % 2 = 0 and _next is not null").select(F.col("conv_id").alias("chosen"), F.col("_next").alias("rejected"))


def paired(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """The turns of both sides of ``pairs`` (pair_id, chosen, rejected)."""
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("conv_id")) for s in ("chosen", "rejected")])
    both = pairs.select("pair_id", F.explode(sides).alias("s")).select("pair_id", "s.*")
    return both.join(turns, "conv_id").select("pair_id", "side", "turn", "role", "text")


def exchanged(turns: DataFrame) -> DataFrame:
    """Both sides of each conversation against itself with its last assistant turn exchanged.

    The text comes from the last assistant turn of the neighbour by id (2k and 2k + 1), the
    pair_id is the conversation's id. Only that one turn moves between conversations.
    """
    last = turns.filter("role = 'assistant'").groupBy("conv_id").agg(F.max("turn").alias("_last"))
    answers = turns.join(last.select("conv_id", F.col("_last").alias("turn")), ["conv_id", "turn"])
    other = answers.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("text").alias("_other"))
    swap = last.join(other, "conv_id")
    told = turns.join(swap, "conv_id").filter("turn <= _last")
    text = F.when((F.col("side") == "rejected") & (F.col("turn") == F.col("_last")), F.col("_other")).otherwise(F.col("text"))
    sides = F.explode(F.array(F.lit("chosen"), F.lit("rejected")))
    return told.withColumn("side", sides).select(F.col("conv_id").alias("pair_id"), "side", "turn", "role", text.alias("text"))


def format_preferences(said: DataFrame) -> DataFrame:
    """(pair_id, part, turn, role, segment, mask) of the turns of both sides; part is prompt, chosen or rejected."""
    mark = F.struct("role", "text")
    by_turn = said.groupBy("pair_id", "turn").agg(F.count(F.lit(1)).alias("_n"), F.min(F.md5(F.to_json(mark))).alias("_a"), F.max(F.md5(F.to_json(mark))).alias("_b"))
    cut = by_turn.groupBy("pair_id").agg(F.min(F.when((F.col("_n") < 2) | (F.col("_a") != F.col("_b")), F.col("turn"))).alias("_cut"))
    parts = said.join(cut, "pair_id")
    shared = F.col("_cut").isNull() | (F.col("turn") < F.col("_cut"))
    parts = parts.filter(~shared | (F.col("side") == "chosen"))
    part = F.when(shared, "prompt").otherwise(F.col("side"))
    mask = F.when(~shared & (F.col("role") == "assistant"), 1).otherwise(0)
    return parts.select("pair_id", part.alias("part"), "turn", "role", render(F.col("role"), F.col("text")).alias("segment"), mask.alias("mask"))


def assemble(segments: DataFrame) -> DataFrame:
    """(pair_id, prompt, chosen, rejected) as texts, for conversations known to fit a row."""
    text = segments.groupBy("pair_id", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "segment"))), lambda s: s["segment"]), "").alias("t"))
    return text.groupBy("pair_id").agg(*[F.coalesce(F.max(F.when(F.col("part") == p, F.col("t"))), F.lit("")).alias(p) for p in ("prompt", "chosen", "rejected")])


def preference_sql() -> str:
    """The segments of the exchanged pairs in DuckDB's SQL."""
    return """WITH t AS (SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY coalesce(role, 'user'), coalesce(text, '')) = 1),
a AS (SELECT conv_id, turn, text FROM t WHERE role = 'assistant' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1),
p AS (SELECT a.conv_id AS pair_id, a.turn AS last, b.text AS other FROM a JOIN a b ON b.conv_id = xor(a.conv_id, 1)),
c AS (SELECT pair_id, turn, role, text FROM p JOIN t ON conv_id = pair_id AND turn <= last),
r AS (SELECT pair_id, turn, role, CASE WHEN turn = last THEN other ELSE text END AS text FROM p JOIN t ON conv_id = pair_id AND turn <= last),
cut AS (SELECT pair_id, min(turn) AS cut FROM c JOIN r USING (pair_id, turn) WHERE c.role <> r.role OR c.text <> r.text GROUP BY 1),
s AS (SELECT c.*, CASE WHEN cut IS NULL OR turn < cut THEN 'prompt' ELSE 'chosen' END AS part FROM c LEFT JOIN cut USING (pair_id)
  UNION ALL SELECT r.*, 'rejected' FROM r JOIN cut USING (pair_id) WHERE turn >= cut)
SELECT pair_id, part, turn, role, CAST(CASE WHEN part <> 'prompt' AND role = 'assistant' THEN 1 ELSE 0 END AS INTEGER) AS mask,
  '<|' || replace(replace(role, '<|', ''), '|>', '') || '|>' || chr(10) || replace(replace(text, '<|', '< |'), '|>', '| >') || chr(10) || '<|end|>' || chr(10) AS segment FROM s"""
