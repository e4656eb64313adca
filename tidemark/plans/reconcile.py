"""Do two copies of a table hold the same rows?

Asked of the rows themselves, or of the two tables' logs, whose file summaries add up
to the same counts, ranges and checksums without opening either copy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import as_instant
from tidemark.functions.digest import row_hash
from tidemark.schemas import Feed
from tidemark.sources.landing import CHECK_DAYS, trailing_days

MEASURES = ("count", "min_lsn", "max_lsn", "checksum")
PARTITION = ("ingestion_date", "ingestion_hour")


def checksum(columns: Sequence[str], row: Callable[[Sequence[str]], Column] = row_hash) -> Column:
    """Sum of row hashes: order does not matter, repeats and changes do.

    Summed as a decimal, which cannot overflow at any row count.
    """
    return F.sum(row(columns).cast("decimal(19,0)"))


def table_checksum(
    rows: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    row: Callable[[Sequence[str]], Column] = row_hash,
) -> DataFrame:
    """Row count and checksum, whole or by group. Adds up map-side."""
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), checksum(columns, row).alias("checksum"))


def side_summary(rows: DataFrame, feed: Feed, side: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, version range and checksum of one copy."""
    return rows.groupBy(*by).agg(
        F.count("*").alias(f"{side}_count"),
        F.min("lsn").alias(f"{side}_min_lsn"),
        F.max("lsn").alias(f"{side}_max_lsn"),
        checksum(feed.checksum_columns).alias(f"{side}_checksum"),
    )


def logged_summary(entries: DataFrame, feed: Feed, side: str, by: Sequence[str] = ()) -> DataFrame:
    """The same from the entries of a table's log: summaries of its files, added up."""
    return entries.groupBy(*by).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias(f"{side}_count"),
        F.min("min_lsn").alias(f"{side}_min_lsn"),
        F.max("max_lsn").alias(f"{side}_max_lsn"),
        F.sum("checksum").cast("decimal(29,0)").alias(f"{side}_checksum"),
    )


Summary = Callable[..., DataFrame]


def _report(pairs: DataFrame, feed: Feed, as_of: Column | datetime | None, by: Sequence[str], status: Column) -> DataFrame:
    columns: list[Column] = [as_instant(as_of).alias("checked_at"), *[F.col(c) for c in by], F.lit(feed.name).alias("table_name")]
    for measure in MEASURES:
        left, right = F.col(f"bronze_{measure}"), F.col(f"lz_{measure}")
        match = "row_count_match" if measure == "count" else f"{measure}_match"
        columns += [left, right, left.eqNullSafe(right).alias(match)]
    return pairs.select(*columns, status.alias("validation_status"))


def _all_match() -> Column:
    same = F.lit(True)
    for measure in MEASURES:
        same = same & F.col(f"bronze_{measure}").eqNullSafe(F.col(f"lz_{measure}"))
    return same


def sink_validation(
    bronze: DataFrame,
    landing: DataFrame,
    feed: Feed,
    as_of: Column | datetime | None = None,
    days: int | None = CHECK_DAYS,
    summary: Summary = side_summary,
) -> DataFrame:
    """One row comparing the trailing days of both copies.

    Each copy is scanned for its checksum columns only and shrinks to one row
    before they meet. Two empty copies agree. With ``logged_summary`` the copies
    are the entries of their logs.
    """
    left = summary(trailing_days(bronze, as_of, days), feed, "bronze")
    right = summary(trailing_days(landing, as_of, days), feed, "lz")
    status = F.when(_all_match(), "HEALTHY").otherwise("MISMATCH")
    return _report(left.crossJoin(F.broadcast(right)), feed, as_of, (), status)


def sink_validation_partition(
    bronze: DataFrame,
    landing: DataFrame,
    feed: Feed,
    as_of: Column | datetime | None = None,
    days: int | None = CHECK_DAYS,
    by: Sequence[str] = PARTITION,
    summary: Summary = side_summary,
) -> DataFrame:
    """The same comparison per day and hour; a partition may be on one side only."""
    left = summary(trailing_days(bronze, as_of, days), feed, "bronze", by)
    right = summary(trailing_days(landing, as_of, days), feed, "lz", by)
    status = (
        F.when(F.col("bronze_count").isNull() | F.col("lz_count").isNull(), "MISSING_PARTITION")
        .when(_all_match(), "HEALTHY")
        .otherwise("MISMATCH")
    )
    return _report(left.join(right, list(by), "full"), feed, as_of, by, status)


def validation_failures(validation: DataFrame) -> DataFrame:
    return validation.agg(F.count_if(F.col("validation_status") != "HEALTHY").alias("failures"))


def validation_panel(validation: DataFrame) -> DataFrame:
    return validation.select(
        "table_name", "bronze_count", "lz_count", "row_count_match", "checksum_match", "validation_status"
    )
