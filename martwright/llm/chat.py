"""Chat formatting (method: cumulative-snapshot collapse). Runs in the JVM only.

Logs often hold a conversation several times, each time with a few more turns. The hash of the first
k turns of a conversation is rolled along its turns; a conversation whose last hash is a rolling hash
of a longer one is a beginning of that one. Anti-joins keep what is neither that nor a later copy,
and only then turns are rendered.

The rolling hash is the exclusive or of one 128-bit hash a turn, taken of role, text and place. So a
conversation's hash is a plain aggregate, and conversations of any length are hashed in two levels,
over stretches of their turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.ordered import Ordered
from martwright.session import cut

STRETCH = 256  # turns that a rendered part holds at most, and numbers of turns that are ordered by one window
ONE_WINDOW = 1 << 16  # rows that one window orders; more of them, as turns without or with one number may be, are sorted over many tasks
NO_NUMBER = -1 << 62  # stands for the stretch of turns without a number; it comes first
OPENING, BETWEEN, CLOSING = "<|im_start|>", "\n", "<|im_end|>\n"


def _word(column: Column, which: int) -> Column:
    return F.conv(F.substring(column, 1 + 15 * which, 15), 16, 10).cast("long")


def placed(turns: DataFrame) -> DataFrame:
    """Turns as conv_id, turn, role, text with their place (from 0) in the conversation and its stretch.

    Turns without conv_id belong to no conversation and are left out. Null roles and texts count as
    empty. Turns are ordered by turn (nulls first), then role and text; repeated rows all count.
    """
    group = ["conv_id", "_part"]
    known = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # Numbers within a stretch of turn numbers first, then the sizes of the stretches before it.
    part = known.withColumn("_part", F.coalesce(F.floor(F.col("turn") / STRETCH).cast("long"), F.lit(NO_NUMBER)))
    sizes = cut(part.groupBy(*group).agg(F.count("*").alias("_size")))
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    inside = Window.partitionBy(*group).orderBy("turn", "role", "text")
    large = sizes.filter(F.col("_size") > ONE_WINDOW).select(*group)
    if large.isEmpty():
        numbered = part.withColumn("_row", F.row_number().over(inside) - 1)
    else:
        numbered = part.join(large, group, "left_anti").withColumn("_row", F.row_number().over(inside) - 1).unionByName(
            _numbered(cut(part.join(large, group, "left_semi")), group))
    joined = numbered.join(before, group)
    place = F.col("_row") + F.col("_before")
    return joined.select("conv_id", "turn", "role", "text", place.cast("long").alias("place"), F.floor(place / STRETCH).cast("long").alias("part"))


def _numbered(part: DataFrame, group: list[str]) -> DataFrame:
    """Rows of a written table with their place in their group, `_row`, whatever share of the rows one group has."""
    rows = part.withColumns({"_id": F.monotonically_increasing_id(), "_one": F.lit(1)})  # the id tells repeated rows apart
    ordered = Ordered.of(rows, [*group, "turn", "role", "text", "_id"], by=group).running_sum("_one", "_row")
    return ordered.plain().withColumn("_row", F.col("_row") - 1).drop("_id", "_one")


def rolled(turns: DataFrame) -> DataFrame:
    """Placed turns with `a` and `b`, the two halves of the hash of all turns up to each."""
    digest = F.sha2(F.concat_ws("\n", F.col("place"), F.length("role"), "role", "text"), 256)
    hashed = turns.select("conv_id", "place", "part", _word(digest, 0).alias("a"), _word(digest, 1).alias("b"))
    parts = hashed.groupBy("conv_id", "part").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("conv_id", "part", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in "ab"])
    inside = Window.partitionBy("conv_id", "part").orderBy("place")
    running = hashed.select("conv_id", "part", "place", *[F.bit_xor(c).over(inside).alias(c) for c in "ab"])
    return running.join(before, ["conv_id", "part"]).select("conv_id", "place", *[F.col(c).bitwiseXOR(F.col(f"_{c}")).alias(c) for c in "ab"])


def maximal(turns: DataFrame) -> DataFrame:
    """One row for each conversation to keep: conv_id, n_turns, n_copies.

    Of equal conversations the smallest conv_id stays; one that is a beginning of another goes.
    """
    rolling = cut(rolled(turns))
    length = rolling.groupBy("conv_id").agg(F.max("place").alias("place"))
    whole = rolling.join(length, ["conv_id", "place"])
    distinct = whole.groupBy("place", "a", "b").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    inner = rolling.join(length.withColumnRenamed("place", "_last"), "conv_id").filter(F.col("place") < F.col("_last"))
    beginnings = inner.select("place", "a", "b").distinct()
    kept = distinct.join(beginnings, ["place", "a", "b"], "left_anti")
    return kept.select("conv_id", (F.col("place") + 1).alias("n_turns"), "n_copies")


def render(turns: DataFrame) -> DataFrame:
    """Placed turns as text: conv_id, part, text. The parts of a conversation, in order, are its text."""
    line = F.concat(F.lit(OPENING), F.col("role"), F.lit(BETWEEN), F.col("text"), F.lit(CLOSING))
    lines = F.sort_array(F.collect_list(F.struct("place", line.alias("line"))))
    return turns.groupBy("conv_id", "part").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "").alias("text"))


def format_chats(turns: DataFrame) -> DataFrame:
    """The maximal conversations, rendered: conv_id, part, n_turns (of the whole), n_copies, text.

    A conversation of more than `STRETCH` turns has several parts, numbered from 0, so that no value
    grows with a conversation.
    """
    turns = placed(turns)
    kept = maximal(turns)
    return render(turns.join(kept.select("conv_id"), "conv_id", "left_semi")).join(kept, "conv_id").select("conv_id", "part", "n_turns", "n_copies", "text")
