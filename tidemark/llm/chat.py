"""Chat formatting: collapse of cumulative snapshots, then rendering.

Chat logs often store a conversation again after every turn. A conversation
that equals a prefix of a longer one is dropped, and of equal ones the smallest
id stays. Turns are identified by position (1, 2, ... by turn, ties by content
hash), role and text. The rolling hash of a prefix is the exclusive-or of the
position-keyed hashes of its turns, 2 x 64 bits, so it can be computed in parts
and combined. A conversation is dropped by an anti-join of its whole hash with
the proper-prefix hashes of all.

All in DataFrame functions. Work on a conversation is split into cells: ranges of ``part``
turn numbers, and where very many turns share a range (they repeat a number, or have
none), its single numbers and ranges of the content hash. So a conversation with very
many turns is spread over many tasks. It is rendered as several rows of ``part`` turns by
their positions (part 0, 1, ...), whose texts in order are the whole; ordinary
conversations have one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

PART = 1024
_FIRST = -(1 << 62)           # the place of turns without a number: first


CROWDED = 4                   # a range of turn numbers is split if it has so many times ``part`` turns


def _hashed(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, t1, t2), with empty texts for nulls."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                F.xxhash64(role, text).alias("t1"), F.xxhash64(text, role).alias("t2"))


def _turns(conversations: DataFrame, part: int) -> DataFrame:
    """(conv_id, cell, turn, role, text, t1, t2); cells of a conversation are in the order of its turns."""
    rows = _hashed(conversations.where(F.col("conv_id").isNotNull())).withColumn(
        "range", F.coalesce(F.floor(F.col("turn") / part), F.lit(_FIRST)))
    crowded = (rows.groupBy("conv_id", "range").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED * part)
               .select("conv_id", "range", F.lit(True).alias("crowded")))
    split = F.coalesce(F.col("crowded"), F.lit(False))
    number = F.when(split, F.coalesce(F.col("turn").cast("bigint"), F.lit(_FIRST))).otherwise(0)
    cell = F.struct("range", number.alias("number"), F.when(split, F.shiftright("t1", 58)).otherwise(0).alias("hash"))
    return rows.join(crowded, ["conv_id", "range"], "left").select("conv_id", cell.alias("cell"), "turn", "role", "text", "t1", "t2")


def _positions(turns: DataFrame) -> DataFrame:
    """Add pos, the place of each turn in its conversation (1, 2, ...)."""
    earlier = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("conv_id", "cell").orderBy(F.col("turn").asc_nulls_first(), "t1", "t2")
    sizes = turns.groupBy("conv_id", "cell").agg(F.count("*").alias("n"))
    before = sizes.select("conv_id", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = turns.join(before, ["conv_id", "cell"]).withColumn("pos", F.col("before") + F.row_number().over(within))
    return placed.drop("before")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, h1, h2, p1, p2): hash of each turn and of the prefix that it ends."""
    narrow = turns.select("conv_id", "cell", "turn", "t1", "t2")
    earlier = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("conv_id", "cell").orderBy("pos")
    placed = _positions(narrow).select("conv_id", "cell", "pos", F.xxhash64("pos", "t1", "t2").alias("h1"),
                                       F.xxhash64("t2", "t1", "pos").alias("h2"))
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marks = stored(placed.select("conv_id", "cell", "pos", "h1", "h2",
                                 F.expr("bit_xor(h1)").over(running).alias("l1"),
                                 F.expr("bit_xor(h2)").over(running).alias("l2")))
    parts = marks.groupBy("conv_id", "cell").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    carried = parts.select("conv_id", "cell",
                           F.coalesce(F.expr("bit_xor(x1)").over(earlier), F.lit(0).cast("bigint")).alias("c1"),
                           F.coalesce(F.expr("bit_xor(x2)").over(earlier), F.lit(0).cast("bigint")).alias("c2"))
    return marks.join(carried, ["conv_id", "cell"]).select(
        "conv_id", "pos", "h1", "h2",
        F.col("l1").bitwiseXOR(F.col("c1")).alias("p1"),
        F.col("l2").bitwiseXOR(F.col("c2")).alias("p2"))


def maximal_conversations(conversations: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, n_turns) of conversations that are no proper prefix of another, one of each equal set."""
    marks = prefix_hashes(_turns(conversations, part))
    whole = marks.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.bit_xor("h1").alias("f1"),
                                         F.bit_xor("h2").alias("f2"))
    first = whole.groupBy("n_turns", "f1", "f2").agg(F.min("conv_id").alias("conv_id"))
    # A prefix is proper if the conversation goes on: it has a turn at pos + 1.
    proper = (marks.join(whole.select("conv_id", "n_turns"), "conv_id").where(F.col("pos") < F.col("n_turns"))
              .select(F.col("pos").alias("n_turns"), F.col("p1").alias("f1"), F.col("p2").alias("f2")).distinct())
    return first.join(proper, ["n_turns", "f1", "f2"], "left_anti").select("conv_id", "n_turns")


def format_chats(conversations: DataFrame, part: int = PART, before: str = "<|", after: str = "|>\n",
                 end: str = "<|end|>\n") -> DataFrame:
    """(conv_id, part, n_turns, text): the maximal conversations as training text.

    Each turn renders as ``before`` + role + ``after`` + text + ``end``; a row holds
    ``part`` turns by position, the last one of a conversation fewer, and n_turns counts
    them. Null roles and texts are empty ones; null
    turns come first; turns that repeat a number are ordered by content hash,
    so repeated rows are turns like any other. Rows without a conv_id belong to no
    conversation and are left out. An empty table gives an empty result; columns
    besides the four are not read.
    """
    kept = maximal_conversations(conversations, part).withColumnRenamed("n_turns", "all_turns")
    rows = conversations.select("conv_id", "turn", "role", "text").join(kept, "conv_id")

    def rendered(turns: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        listed = turns.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, "role", "text"))).alias("turns"))
        return listed.select(*keys, F.size("turns").cast("bigint").alias("n_turns"),
                             F.array_join(F.transform("turns", lambda t: F.concat(
                                 F.lit(before), t["role"], F.lit(after), t["text"], F.lit(end))), "").alias("text"))

    # Ordinary conversations are one row; of longer ones the turns are numbered first. Both read one exchange.
    one = rendered(_hashed(rows.where(F.col("all_turns") <= part)), ["conv_id"], ["turn", "t1", "t2"])
    long = _positions(_turns(rows.where(F.col("all_turns") > part), part)).withColumn("part", F.floor((F.col("pos") - 1) / part))
    several = rendered(long, ["conv_id", "part"], ["pos"])
    return one.select("conv_id", F.lit(0).cast("bigint").alias("part"), "n_turns", "text").unionByName(several)
