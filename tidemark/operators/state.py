"""Latest row per key, in one pass or merged from partial results.

All forms use ``row_number() = 1``. Spark limits each group to one row before
the shuffle as well as after it, so a key that holds a third of the rows still
sends one row per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row of the highest version per key.

    Rows that tie on ``version`` are ordered by their remaining columns, nulls
    lowest, so the choice never depends on arrival order.
    """
    rest = [c for c in df.columns if c not in keys and c not in version]
    order = [F.desc_nulls_last(c) for c in [*version, *rest]]
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_pos", F.row_number().over(window)).filter("_pos = 1").drop("_pos")


def first_by(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """The earliest row per key, ties broken by the remaining columns."""
    rest = [c for c in df.columns if c not in keys and c not in arrival]
    window = W.partitionBy(*keys).orderBy(*[F.asc_nulls_first(c) for c in [*arrival, *rest]])
    return df.withColumn("_pos", F.row_number().over(window)).filter("_pos = 1").drop("_pos")


STATE_KEYS = ("assetId",)
STATE_VERSION = ("lsn", "eventTimeMs")


def partial_state(
    events: DataFrame,
    payload: Sequence[str],
    keys: Sequence[str] = STATE_KEYS,
    version: Sequence[str] = STATE_VERSION,
) -> DataFrame:
    """Key, version and payload of the newest event per key, deletes included.

    The result has the shape of its input, so partial states of any split of
    the events can be united and reduced again.
    """
    return latest_by(events.select(*keys, *version, *payload), keys, version)


def state_merge(
    *states: DataFrame, keys: Sequence[str] = STATE_KEYS, version: Sequence[str] = STATE_VERSION
) -> DataFrame:
    """Merge partial states; order, grouping and repeats do not matter."""
    return latest_by(reduce(DataFrame.unionByName, states), keys, version)


def live(state: DataFrame) -> DataFrame:
    """Hide keys whose newest event is a delete."""
    return state.filter(F.col("op") != "d")


def replacing_dedup(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Keep the row of the highest version per key."""
    return latest_by(df, keys, [version])


def latest_nonnull_by_time(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order: Sequence[str],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Per key, each value's own last non-null by ``order``, and any ``extra`` aggregates.

    Pass a single order column where it is unique within the key, as the event
    time of deduplicated facts is: the aggregate then stays hash based.
    """
    rank: Column = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return df.groupBy(*keys).agg(
        *[F.max_by(F.col(v), F.when(F.col(v).isNotNull(), rank)).alias(v) for v in values], *extra
    )
