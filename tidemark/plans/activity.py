"""Rates, sizes and lag of the running pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import as_instant, local_date
from tidemark.operators.series import whole

# Fixed value: the consumer groups that count, whose names the streaming job's queries share.
GROUP_PATTERN = "(flink-)?bronze-.*"


def bronze_insert_rate(
    tables: dict[str, DataFrame], as_of: Column | datetime | None = None, hours: int | None = 1
) -> DataFrame:
    """Rows per event minute and table over the last hours.

    A row is ingested after its event, so days before the first hour are not read
    of a table laid out by ingestion day.
    """
    since = F.unix_seconds(as_instant(as_of)) - (hours or 0) * 3600
    first_day = local_date(F.timestamp_seconds(since))
    second = F.floor(F.col("eventTimeMs") / 1000)
    parts = []
    for name, rows in tables.items():
        recent = rows if hours is None else rows.filter(F.col("eventTimeMs") >= since * 1000)
        if hours is not None and "ingestion_date" in rows.columns:
            recent = recent.filter(F.col("ingestion_date") >= first_day)
        minute = F.timestamp_seconds(F.floor(second / 60) * 60).alias("t")
        parts.append(recent.groupBy(minute).agg(F.count("*").alias("rows")).withColumn("src", F.lit(name)))
    return reduce(DataFrame.unionByName, parts).select("t", "rows", "src")


def row_counts(tables: dict[str, tuple[DataFrame, Sequence[str]] | DataFrame]) -> DataFrame:
    """Rows per table. A table given with key columns is counted by distinct key,
    which is its row count once versions are replaced. One given by the entries of
    its log is not read: their counts are added up."""
    parts = []
    for name, table in tables.items():
        if isinstance(table, DataFrame):
            total = table.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
        else:
            rows, key = table
            total = (rows.select(*key).distinct() if key else rows).agg(F.count("*").alias("rows"))
        parts.append(total.select(F.lit(name).alias("table_name"), "rows"))
    return reduce(DataFrame.unionByName, parts)


def consumer_lag(offsets: DataFrame, group_pattern: str = GROUP_PATTERN) -> DataFrame:
    """Messages behind at each sample time, over the matching consumer groups."""
    behind = F.col("end_offset") - F.col("committed_offset")
    return (
        offsets.filter(F.col("consumergroup").rlike(whole(group_pattern)))
        .groupBy("ts")
        .agg(F.sum(behind).alias("lag"))
    )


def checkpoint_duration(checkpoints: DataFrame) -> DataFrame:
    """Last and longest checkpoint time per job."""
    return checkpoints.groupBy("job_name").agg(
        F.max_by("duration_ms", F.col("ts")).alias("last_ms"), F.max("duration_ms").alias("max_ms")
    )


def checkpoint_duration_max(checkpoints: DataFrame) -> DataFrame:
    """The longest of the jobs' last checkpoint times."""
    return checkpoint_duration(checkpoints).agg(F.max("last_ms").alias("max_last_ms"))
