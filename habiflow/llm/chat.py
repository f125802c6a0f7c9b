"""Operator 3: chat formatting after collapsing cumulative snapshots.

A log often holds one conversation many times, each time a few turns longer.
Rolling hashes identify every turn prefix: two independent 64-bit hashes of
(position, role, text) are xor-ed along the turns, so the value at turn k
identifies the first k turns.  A conversation whose last value is another
one's value at an inner turn is a snapshot of it; of conversations with the
same turns the smallest conv_id stays.  Both sides of the anti-join hold one
row per distinct hash, so an opening turn or a conversation that a third of
the log shares is one row there.  DataFrame functions only.

Defined cases: null role or text counts as empty; a null conv_id is one
conversation; rows that repeat (conv_id, turn, role, text) count once; turns
go by turn (nulls first), ties by role, then text; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habiflow.llm.common import stored

# fixed values: marks around a rendered turn
TURN_OPEN, TURN_CLOSE = "<|im_start|>", "<|im_end|>\n"


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id``, position ``k`` from 1, ``n_turns`` and (``h1``, ``h2``) of the first k turns."""
    t = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                             F.coalesce("text", F.lit("")).alias("text"))
    t = t.select("conv_id", "turn", "role", F.xxhash64("role", "text", F.lit("a")).alias("d1"),
                 F.xxhash64(F.lit("b"), "text", "role").alias("d2"), F.substring(F.sha2("text", 256), 1, 16).alias("tie"))
    t = t.distinct()
    conv = Window.partitionBy("conv_id")
    order = conv.orderBy(F.col("turn").asc_nulls_first(), "role", "tie", "d1", "d2")
    t = t.withColumn("k", F.row_number().over(order)).withColumn("n_turns", F.count("*").over(conv))
    grown = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return t.select("conv_id", "k", "n_turns",
                    F.expr("bit_xor(xxhash64(d1, k))").over(grown).alias("h1"),
                    F.expr("bit_xor(xxhash64(k, d2))").over(grown).alias("h2"))


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``n_same`` (conversations with exactly these turns) of those that no other extends."""
    p = stored(prefix_hashes(conversations), "prefixes")
    whole = (p.filter(F.col("k") == F.col("n_turns")).groupBy("k", "h1", "h2")
             .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_same")))
    inner = p.filter(F.col("k") < F.col("n_turns")).select("k", "h1", "h2").distinct()
    return whole.join(inner, ["k", "h1", "h2"], "left_anti").select("conv_id", "n_same")


def rendered(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_turns`` and ``chat``, its turns between marks."""
    t = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                             F.coalesce("text", F.lit("")).alias("text")).distinct()
    turn = F.struct(F.col("turn").alias("turn"), F.col("role").alias("role"),
                    F.substring(F.sha2("text", 256), 1, 16).alias("tie"), F.col("text").alias("text"))
    t = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("_a"))
    line: Column = F.transform("_a", lambda x: F.concat(F.lit(TURN_OPEN), x["role"], F.lit("\n"), x["text"], F.lit(TURN_CLOSE)))
    return t.select("conv_id", F.size("_a").cast("long").alias("n_turns"), F.array_join(line, "").alias("chat"))


def chat_format(conversations: DataFrame) -> DataFrame:
    """The maximal conversations, rendered: ``conv_id, n_turns, n_same, chat``."""
    kept = maximal_conversations(conversations)
    c = conversations.select("conv_id", "turn", "role", "text")
    kept = kept.withColumnRenamed("conv_id", "_id")
    chosen = c.join(kept.select("_id"), c["conv_id"].eqNullSafe(kept["_id"]), "left_semi")
    out = rendered(chosen)
    return (out.join(kept, out["conv_id"].eqNullSafe(kept["_id"]))
            .select("conv_id", "n_turns", F.col("n_same").cast("long").alias("n_same"), "chat"))


def op3_chat_formatting(conversations: DataFrame) -> DataFrame:
    return chat_format(conversations)


# Every proper turn prefix as a list of turns, joined to whole conversations.
OP3_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
turns AS (
  SELECT conv_id, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         list(role || chr(10) || text) OVER w AS prefix
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substr(sha256(text), 1, 16))),
hashed AS (SELECT conv_id, k, n_turns, prefix FROM turns),
whole AS (SELECT prefix, min(conv_id) AS conv_id, count(*) AS n_same, any_value(n_turns) AS n_turns
          FROM hashed WHERE k = n_turns GROUP BY prefix),
kept AS (SELECT w.* FROM whole w ANTI JOIN (SELECT DISTINCT prefix FROM hashed WHERE k < n_turns) i ON w.prefix = i.prefix)
SELECT conv_id, n_turns, n_same,
       array_to_string(list_transform(prefix, lambda x: '<|im_start|>' || x || '<|im_end|>' || chr(10)), '') AS chat
FROM kept
"""
