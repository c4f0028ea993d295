"""Dialogues from the perspective of each participant.

For every participant of a dialogue the whole dialogue is rendered with that speaker as assistant and
the others as named users, together with the character spans that the speaker is trained on: its own
turns and their end marks. A dialogue is rendered in parts of a bounded number of turns, so a dialogue
of any length is never gathered into one row or task; the parts of a dialogue, in their order, are the
whole text. All work is DataFrame functions.

Rows and edge cases: turns are ordered by number (NULL last), then by role and text; repeated rows are
turns of their own; a NULL text is an empty turn; a NULL role speaks as an unnamed user and has no
perspective of its own; turns of a narrator (`system`) are rendered as such for everyone and have no
perspective either, so a dialogue of narrators only gives no rows; turns without a dialogue id form one
dialogue; an empty table gives an empty result. Marks inside a text are left as they are: spans, not
marks, say what is trained on. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockpulse.llm.scratch import Scratch

#: Turns of a part, at most; roles that are rendered as narrators.
PART_TURNS, NARRATORS = 64, ("system",)
#: The marks around a turn, and the name of a speaker without one.
OPEN, CLOSE, UNNAMED = "<|im_start|>", "<|im_end|>", "unnamed"


def numbered_turns(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, place, role, text): turns with their place in the dialogue, from 0.

    Turns are range partitioned by dialogue and order, numbered inside each range, and moved by what
    the dialogue has in earlier ranges; a dialogue with very many turns spreads over many ranges. The
    ranges are written, so that both passes see the same ones.
    """
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("tie")]
    keyed = turns.withColumn("tie", F.md5("text"))
    ranged = keyed.repartitionByRange(F.col("conv"), *order, F.monotonically_increasing_id()).withColumn("range", F.spark_partition_id())
    ranged = scratch.write(ranged, "ranges", merged=False)
    sizes = ranged.groupBy("conv", "range").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.struct("conv", "range").alias("key"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv", "range").orderBy(*order))
    placed = ranged.withColumn("inside", inside).withColumn("key", F.struct("conv", "range")).join(before, "key")
    return placed.select("conv", (F.col("before") + F.col("inside") - 1).alias("place"), "role", "text")


def _header(role: Column, speaker: Column, narrators: tuple[str, ...]) -> Column:
    name = F.concat(F.lit("user name="), F.coalesce(role, F.lit(UNNAMED)))
    kind = F.when(role == speaker, "assistant").when(role.isin(*narrators), role).otherwise(name)
    return F.concat(F.lit(OPEN), kind, F.lit("\n"))


def rotate(
    conversations: DataFrame,
    part_turns: int = PART_TURNS,
    narrators: tuple[str, ...] = NARRATORS,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, speaker, part, n_turns, n_own, text, spans): one row per perspective and part.

    `spans` is an array of (start, end), the end exclusive, in characters of the part's text.
    """
    scratch = Scratch(conversations.sparkSession, "perspectives")
    turns = conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    placed = numbered_turns(turns, scratch)
    part = F.floor(F.col("place") / part_turns).cast("int").alias("part")
    parts = placed.groupBy("conv", part).agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    speakers = turns.where(F.col("role").isNotNull() & ~F.col("role").isin(*narrators)).select(F.struct("conv").alias("key"), F.col("role").alias("speaker")).distinct()
    seen = parts.withColumn("key", F.struct("conv")).join(speakers, "key")

    speaker = F.col("speaker")
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.coalesce(t["role"] == speaker, F.lit(False)).alias("own"), _header(t["role"], speaker, narrators).alias("header"), F.concat(t["text"], F.lit(CLOSE)).alias("body")
        ),
    )
    shown = seen.withColumn("pieces", pieces)
    none = F.array().cast("array<struct<start: int, end: int>>")

    def add(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["header"])
        end = start + F.length(piece["body"])
        spans = F.when(piece["own"], F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(state["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    spans = F.aggregate("pieces", F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda s: s["spans"])
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["header"], p["body"], F.lit("\n"))), "")
    return shown.select(
        "conv", "speaker", "part", F.size("pieces").alias("n_turns"), F.size(F.filter("pieces", lambda p: p["own"])).alias("n_own"), text.alias("text"), spans.alias("spans")
    )
