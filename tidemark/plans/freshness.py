"""How far the fact tables are behind."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import as_instant, local_date, minutes_between

# Minutes behind, and the status names below.
HEALTHY_MINUTES = 10
DELAYED_MINUTES = 30


def lag_status(latest: Column, lag: Column) -> Column:
    unset = latest.isNull() | (local_date(latest) == F.lit("1970-01-01").cast("date"))
    return (
        F.when(unset, "empty")
        .when(lag <= HEALTHY_MINUTES, "healthy")
        .when(lag <= DELAYED_MINUTES, "delayed")
        .otherwise("stale")
    )


def pipeline_health(tables: dict[str, DataFrame], as_of: Column | datetime | None = None) -> DataFrame:
    """Newest event, minutes behind and status per table.

    Only the greatest event time matters, so the tables may still hold replaced
    versions: pass fact rows before deduplication and save its shuffle.
    """
    newest = reduce(
        DataFrame.unionByName,
        [
            rows.agg(F.max("event_time_ms").alias("_ms")).select(
                F.lit(name).alias("table_name"),
                F.timestamp_seconds(F.floor(F.col("_ms") / 1000)).alias("latest_event_time"),
            )
            for name, rows in tables.items()
        ],
    )
    now, latest = as_instant(as_of), F.col("latest_event_time")
    lag = minutes_between(latest, now)
    return newest.select(
        now.alias("checked_at"),
        "table_name",
        "latest_event_time",
        lag.alias("minutes_lag"),
        lag_status(latest, lag).alias("pipeline_status"),
    )


def pipeline_status(health: DataFrame) -> DataFrame:
    """The worst status over all tables."""
    some = lambda status: F.count_if(F.col("pipeline_status") == status) > 0
    worst = (
        F.when(some("stale"), "STALE")
        .when(some("empty"), "EMPTY")
        .when(some("delayed"), "DELAYED")
        .otherwise("HEALTHY")
    )
    return health.agg(worst.alias("status"))


def pipeline_lag_max(health: DataFrame) -> DataFrame:
    return health.agg(F.max("minutes_lag").alias("minutes_lag"))
