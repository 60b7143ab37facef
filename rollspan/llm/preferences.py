"""Preference formatting, in DataFrame functions only.

Chosen and rejected conversations of a pair share their first turns. The longest common prefix is
found by joining the two turn by turn and taking the first place where they differ. Its turns are rendered
once, as the prompt; the rest of each conversation is rendered as its completion. A row is one rendered
turn, so no conversation is gathered in one place however many turns it has. The mask is the range of
characters to learn from: the text of assistant turns in completions.

Cases: null roles and texts are empty; null turns come first; turns of one number are ordered by role and
text; a null pair id is a pair of its own; if one conversation ends where they agree, its completion is empty; if they
are equal, all turns are prompt; a pair known on one side only is all completion; a marker in a
text is broken by a blank; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: Stands for a null id or turn inside joins.
NONE = -(1 << 62)
AT = ["pair_id", "turn", "nth"]


def turns_of(df: DataFrame, pair: str, turn: str, role: str, text: str) -> DataFrame:
    """``pair_id``, ``turn``, ``nth`` (among turns of one number), ``role``, ``text``."""
    rows = df.select(F.coalesce(F.col(pair).cast("long"), F.lit(NONE)).alias("pair_id"), F.coalesce(F.col(turn).cast("long"), F.lit(NONE)).alias("turn"),
                     F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy("pair_id", "turn").orderBy("role", "text")))


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Rejected conversations: the last assistant turn says what the paired conversation's last one says.

    Conversations 2i and 2i + 1 are paired; without a reply there, the conversation stays as it is.
    """
    last = turns.where("role = 'assistant'").groupBy("pair_id").agg(F.max(F.struct("turn", "nth")).alias("_l")).select("pair_id", "_l.turn", "_l.nth")
    replies = turns.join(last, AT, "left_semi").select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("text").alias("_other"))
    swap = last.join(replies, "pair_id")
    return turns.join(swap, AT, "left").select(*AT, "role", F.coalesce("_other", "text").alias("text"))


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per rendered turn: ``pair_id``, ``part``, ``turn``, ``nth``, ``role``, ``rendered``, ``learn_from``, ``learn_to``.

    ``part`` is prompt, chosen or rejected; a turn is learned where ``learn_from`` < ``learn_to``.
    """
    a = chosen.select(*AT, F.struct("role", "text").alias("_a"))
    b = rejected.select(*AT, F.struct("role", "text").alias("_b"))
    differ = (a.join(b, AT, "full").where(~F.col("_a").eqNullSafe(F.col("_b")))
               .groupBy("pair_id").agg(F.min(F.struct("turn", "nth")).alias("_first")))
    sides = chosen.withColumn("_side", F.lit("chosen")).unionByName(rejected.withColumn("_side", F.lit("rejected")))
    rows = sides.join(differ, "pair_id", "left").withColumn(
        "part", F.when(F.coalesce(F.struct("turn", "nth") < F.col("_first"), F.lit(True)), F.lit("prompt")).otherwise(F.col("_side")))
    rows = rows.where((F.col("part") != "prompt") | (F.col("_side") == "chosen"))
    head = F.concat(F.lit("<|"), F.regexp_replace("role", r"[^A-Za-z0-9_-]", ""), F.lit("|>\n"))
    body = F.replace("text", F.lit("<|"), F.lit("< |"))
    learned = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    begin = F.char_length(head)
    return rows.select(F.when(F.col("pair_id") != NONE, F.col("pair_id")).alias("pair_id"), "part", F.when(F.col("turn") != NONE, F.col("turn")).alias("turn"),
                       "nth", "role", F.concat(head, body, F.lit("<|end|>\n")).alias("rendered"),
                       F.when(learned, begin).otherwise(0).alias("learn_from"), F.when(learned, begin + F.char_length(body)).otherwise(0).alias("learn_to"))
