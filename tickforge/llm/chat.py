"""Chat formatting: collapse logged snapshots of one conversation, then render what is left.

A conversation that was logged after every turn appears as many rows of prefixes. A rolling
hash over its turns identifies each prefix; a conversation whose whole hash is a proper
prefix of another, or equal to that of a smaller id, goes by anti-joins. The hash is a
running exclusive-or of the hashes of (turn, role, text), so it can be added up in parts: a
conversation of any length is cut into blocks of turns, and no task needs all of it.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, pick

#: Turn numbers in one block, which is also one rendered part.
BLOCK = 256


def turns_of(df: DataFrame) -> DataFrame:
    """One row for each (conv_id, turn): exact repeats dropped, several texts kept in order."""
    rows = pick(df, conv_id="conv_id", turn="turn", role="role", text="text")
    rows = rows.where("conv_id is not null and turn is not null").distinct()
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # Hashes pass over nulls, so a null is marked to stand in its place.
    role, text = (F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in ("role", "text"))
    rows = rows.select(
        "conv_id", "turn", said.alias("said"),
        F.xxhash64(F.lit(1), "turn", role, text).alias("h1"),
        F.xxhash64(F.lit(2), text, role, "turn").alias("h2"),
    )
    return rows.withColumn("block", F.floor(F.col("turn") / BLOCK).cast("long"))


def prefixes(turns: DataFrame, scratch) -> DataFrame:
    """(conv_id, turn, p1, p2): the rolling hash after every turn."""
    by_turn = scratch.keep(
        turns.groupBy("conv_id", "block", "turn").agg(
            F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
        )
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = by_turn.groupBy("conv_id", "block").agg(
        F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
    )
    carried = scratch.keep(
        blocks.select(
            "conv_id", "block", F.coalesce(F.bit_xor("h1").over(before), F.lit(0)).alias("c1"),
            F.coalesce(F.bit_xor("h2").over(before), F.lit(0)).alias("c2"),
        )
    )
    within = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(
        Window.unboundedPreceding, 0
    )
    inside = by_turn.select(
        "conv_id", "block", "turn",
        F.bit_xor("h1").over(within).alias("h1"), F.bit_xor("h2").over(within).alias("h2"),
    )
    return inside.join(carried, ["conv_id", "block"]).select(
        "conv_id", "turn", F.expr("h1 ^ c1").alias("p1"), F.expr("h2 ^ c2").alias("p2")
    )


def maximal(turns: DataFrame, scratch) -> DataFrame:
    """Ids of the conversations that are no snapshot of another: (conv_id)."""
    rolled = scratch.keep(prefixes(turns, scratch))
    last = rolled.groupBy("conv_id").agg(F.max("turn").alias("turn"))
    whole = scratch.keep(rolled.join(last, ["conv_id", "turn"]))
    proper = rolled.join(last, ["conv_id", "turn"], "left_anti").select("p1", "p2").distinct()
    alone = whole.groupBy("p1", "p2").agg(F.min("conv_id").alias("conv_id"))
    return alone.join(scratch.keep(proper), ["p1", "p2"], "left_anti").select("conv_id")


def chats(df: DataFrame) -> DataFrame:
    """Rendered maximal conversations: conv_id, part, turns, rendered.

    ``rendered`` holds each turn as ``<|im_start|>role``, the text and ``<|im_end|>`` on lines
    of their own. ``part`` counts blocks of 256 turn numbers; the parts of a conversation in
    order are its whole text, and only a conversation with turn numbers beyond the first
    block has several.

    Rows without conv_id or turn are left out, exact repeats count once, several texts of one
    turn stand in the order of role and text. A null role or text is rendered empty, but
    differs from an empty one when snapshots are compared. Of equal conversations the
    smallest id stays. Other columns are left out.
    """
    with Scratch(df.sparkSession, "chat") as scratch:
        turns = scratch.keep(turns_of(df))
        ids = scratch.keep(maximal(turns, scratch))
        line = F.concat(
            F.lit("<|im_start|>"), F.col("said.role"), F.lit("\n"), F.col("said.text"),
            F.lit("<|im_end|>\n"),
        )
        rows = turns.select("conv_id", "block", "turn", "said", line.alias("line"))
        parts = (
            rows.join(ids, "conv_id", "left_semi")
            .groupBy("conv_id", F.col("block").alias("part"))
            .agg(
                F.countDistinct("turn").alias("turns"),
                F.sort_array(F.collect_list(F.struct("turn", "said", "line"))).alias("lines"),
            )
        )
        rendered = F.array_join(F.col("lines.line"), "").alias("rendered")
        return scratch.keep(parts.select("conv_id", "part", "turns", rendered), last=True)
