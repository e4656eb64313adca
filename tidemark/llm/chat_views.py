"""Multi-party dialogues from every speaker's point of view.

For each participant of a conversation the dialogue is rendered with that
participant's turns as the assistant's and all others' as a named user's. The
mask marks what the participant says, with the mark that ends the turn.

A conversation is rendered in segments of ``SEGMENT`` turn numbers. Rows are counted
by (conversation, segment) first. A segment of more than ``MOST`` rows, where turn
numbers repeat or are missing, is cut in order into parts of ``MOST``: its rows are
sorted in ranges over all tasks and numbered by one count per range. So no group
has more than ``MOST`` rows, however many a conversation has. Turns are brought
together once, by (conversation, segment, part); what meets by conversation alone
are names. Only DataFrame functions are used.

Defined results: turns are ordered by number, then name, then text; turns without
number follow in a segment of their own; the parts of a segment, put together by
number, are the segment's dialogue; a null text is
empty; a null name is ``unknown``; a null conversation id is a conversation of its
own; repeated rows are rendered as often as they stand; turns of ``system`` are
rendered as the system's, who is no participant, and a conversation of those only
gives one view without a participant (null); an empty table gives none; other
columns, whatever their names, are not read. Control marks within texts are
broken up by a space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

SEGMENT = 64
MOST = 1024  # rows of a part
SYSTEM = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
UNNUMBERED = 2**62  # the segment of turns without number


def shown_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[\x00-\x20<>|]+", "_")


def in_parts(turns: DataFrame) -> DataFrame:
    """The turns with the number of their part, from 0 in the order of what is said."""
    place = ["conv_key", "segment"]
    large = turns.groupBy(*place).agg(F.count("*").alias("rows")).where(F.col("rows") > MOST)
    large = stage(large.select(*place), "large-segments")  # at most one of MOST rows each
    small = turns.join(large, place, "left_anti").withColumn("part", F.lit(0))
    order = [*place, "said.turn", "said.name", "said.text", "row"]
    # Equal rows are told apart by a number, so that a range can end between them.
    rows = stage(turns.join(large, place, "left_semi").withColumn("row", F.monotonically_increasing_id()), "large-turns")
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    # Staged, since a range's number and a row's place in it hold for this run only.
    placed = stage(sorted_rows.withColumns({"range": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "placed-turns")
    ranges = placed.groupBy(*place, "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(*place).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    part = F.floor((F.col("at") - F.col("first") + F.col("before")) / MOST).cast("int")
    return small.unionByName(placed.join(ranges, [*place, "range"]).withColumn("part", part).select(*small.columns))


def views(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", name_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation, participant and segment.

    Columns: the conversation's id, participant, segment (first turn number over
    SEGMENT; null without number), part, n_turns, n_own, text, and mask: the
    masked code points of the text as start:end, ends exclusive, comma-joined.
    """
    name = F.coalesce(F.col(name_col), F.lit("unknown"))
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"<\|", "< |")
    turns = conversations.select(
        F.col(conv_col).alias("conv"),
        F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("")).alias("conv_key"),
        F.coalesce(F.floor(F.col(turn_col) / SEGMENT).cast("long"), F.lit(UNNUMBERED)).alias("segment"),
        F.struct(F.col(turn_col).alias("turn"), name.alias("name"), text.alias("text")).alias("said"),
    )
    turns = in_parts(turns)
    keys = ["conv_key", "segment", "part"]
    segments = turns.groupBy(*keys).agg(F.first("conv").alias("conv"), F.sort_array(F.collect_list("said")).alias("said"))
    speakers = turns.where(F.col("said.name") != SYSTEM).select("conv_key", F.col("said.name").alias("participant")).distinct()
    places = turns.select(*keys).distinct().join(speakers, "conv_key", "left")
    joined = segments.join(places, keys)

    def rendered(turn: Column) -> Column:
        own = turn["name"] == F.col("participant")
        head = F.when(own, F.lit("assistant\n")).when(turn["name"] == SYSTEM, F.lit("system\n"))
        head = head.otherwise(F.concat(F.lit("user name="), shown_name(turn["name"]), F.lit("\n")))
        head = F.concat(F.lit(OPEN), F.coalesce(head, F.lit("")))
        body = F.concat(turn["text"], F.lit(CLOSE))
        return F.struct(head.alias("head"), body.alias("body"), F.coalesce(own, F.lit(False)).alias("own"))

    pieces = joined.withColumn("pieces", F.transform("said", rendered))
    length = lambda p: F.length(p["head"]) + F.length(p["body"])
    starts = F.aggregate(
        "pieces", F.array(F.lit(0)), lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + length(p)))
    )
    placed = pieces.withColumn("starts", starts)
    spans = F.transform(
        "pieces",
        lambda p, i: F.when(
            p["own"],
            F.concat_ws(":", F.get("starts", i) + F.length(p["head"]), F.get("starts", i) + length(p)),
        ),
    )
    whole = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "")
    return placed.select(
        F.col("conv").alias(conv_col),
        "participant",
        F.when(F.col("segment") != UNNUMBERED, F.col("segment")).alias("segment"),
        "part",
        F.size("pieces").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["own"])).cast("long").alias("n_own"),
        whole.alias("text"),
        F.array_join(spans, ",").alias("mask"),
    )
