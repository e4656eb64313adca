"""Time helpers. None of them depends on the session time zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import LOCAL_ZONE

HOUR_MICROS = 3_600_000_000
DAY_MICROS = 24 * HOUR_MICROS


def as_instant(as_of: Column | datetime | None) -> Column:
    """The moment a report is for: a column, a datetime (naive means UTC), or now."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    micros = int(as_of.timestamp()) * 1_000_000 + as_of.microsecond
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def epoch_to_local_time(millis: Column) -> Column:
    """Epoch milliseconds to an instant cut to whole seconds."""
    return F.timestamp_seconds(F.call_function("div", millis, F.lit(1000).cast("bigint")))


def local_clock(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    """Wall clock of ``zone`` at that instant, without a zone."""
    return F.convert_timezone(None, F.lit(zone), instant)


def local_date(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    return local_clock(instant, zone).cast("date")


def local_event_date(millis: Column, zone: str = LOCAL_ZONE) -> Column:
    return local_date(epoch_to_local_time(millis), zone)


def event_month(millis: Column, zone: str = LOCAL_ZONE) -> Column:
    """Month partition, as yyyyMM text."""
    return F.date_format(local_clock(epoch_to_local_time(millis), zone), "yyyyMM")


def ingest_stamp(instant: Column | None = None, zone: str = LOCAL_ZONE) -> list[Column]:
    """``ingestion_date`` and two-digit ``ingestion_hour`` from one clock.

    On a stream the default, the current time, is the micro-batch's own time: it
    is kept with the batch's offsets, so a replayed batch gets the same stamp.
    """
    # The wall clock as microseconds: taken apart by arithmetic, and the zone is looked up once, not for every row.
    moment = F.current_timestamp() if instant is None else instant
    local = F.unix_micros(F.from_utc_timestamp(moment, zone))
    within = F.pmod(local, F.lit(DAY_MICROS))
    day = F.call_function("div", local - within, F.lit(DAY_MICROS))
    hour = F.call_function("div", within, F.lit(HOUR_MICROS))
    return [
        F.date_from_unix_date(day.cast("int")).alias("ingestion_date"),
        F.lpad(hour.cast("string"), 2, "0").alias("ingestion_hour"),
    ]


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from start to end."""
    sixty = F.lit(60).cast("bigint")
    floor = lambda moment: F.floor(F.unix_seconds(moment) / sixty).cast("bigint")
    return floor(end) - floor(start)
