"""Change events to bronze rows: parse, validate, split, stamp.

A feed DataFrame has one struct column ``envelope`` (op, before, after, source)
and, where the source kept it, the message as text in ``raw``. Everything here
is a projection or a filter, so a feed goes to bronze without a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import ingest_stamp
from tidemark.functions.payload import (
    decimal_parts,
    judge_decimal,
    long_or_null,
    long_unfit,
    text_or_null,
    ts_to_millis,
)
from tidemark.schemas import Feed

INTAKE = "intake"
# The reason given for an unusable envelope, and the delete code.
UNSUPPORTED = "null or unsupported record"
DELETE = "d"

SOURCE_TEXT = (("db", "sourceDb"), ("schema", "sourceSchema"), ("table", "sourceTable"))
# what a delete must still carry when the row image holds key columns only
DELETE_KEYS = ("assetId", "currency", "eventTimeMs")


def cdc_route(changes: DataFrame, schema: str, tables: Iterable[str]) -> dict[str, DataFrame]:
    """One feed per listed table; events of other tables go nowhere."""
    source = F.col("envelope.source")
    return {
        table: changes.filter((source["schema"] == schema) & (source["table"] == table))
        for table in tables
    }


def _payload(envelope: Column) -> Column:
    op = text_or_null(envelope["op"])
    return F.when(op == DELETE, envelope["before"]).otherwise(envelope["after"])


def cdc_validate(changes: DataFrame, feed: Feed) -> DataFrame:
    """Typed bronze columns plus ``reject_reason`` (null = accepted) and ``record``.

    The reason is the first rule that fails: an unusable envelope, then each
    column in bronze order. Text amounts that are not numbers read as null;
    numbers that decimal(38,18) cannot hold exactly reject the row.

    Rows in and rejected are observed on the way. The observation also keeps a
    later filter on the reason above the parse, so that no field is read twice.
    """
    fields = changes.schema["envelope"].dataType
    payload_types = {f.name: f.dataType for f in fields["after"].dataType}
    source_types = {f.name: f.dataType for f in fields["source"].dataType}
    has_raw = "raw" in changes.columns

    envelope = F.col("envelope")
    unusable = text_or_null(envelope["op"]).isNull() | F.col("payload").isNull() | envelope["source"].isNull()
    source, payload, op = envelope["source"], F.col("payload"), text_or_null(envelope["op"])

    values: dict[str, Column] = {}
    faults: list[tuple[Column, str]] = [(unusable, UNSUPPORTED)]

    for field, column in feed.text:
        values[column] = text_or_null(payload[field])
    for _, column in feed.amounts:
        values[column] = F.col(f"_{column}.number")
        faults.append((F.col(f"_{column}.unfit"), f"{column} does not fit decimal(38,18)"))
    for field, column in feed.tail_text:
        values[column] = text_or_null(payload[field])

    envelope_clock = long_or_null(source["ts_ms"], source_types["ts_ms"])
    fallback = F.when(op == DELETE, envelope_clock)
    values["eventTimeMs"] = ts_to_millis(payload["event_time"], payload_types["event_time"])
    if feed.source_clock == "payload":
        own_clock = ts_to_millis(payload["source_ts"], payload_types["source_ts"])
        values["sourceTsMs"] = F.coalesce(own_clock, fallback)
    else:
        values["sourceTsMs"] = envelope_clock
    created = ts_to_millis(payload["created_at"], payload_types["created_at"])
    values["createdAtMs"] = F.coalesce(created, fallback)
    values["updatedAtMs"] = F.lit(None).cast("bigint")
    values["op"] = op
    values["lsn"] = F.coalesce(long_or_null(source["lsn"], source_types["lsn"]), F.lit(0).cast("bigint"))
    for field, column in SOURCE_TEXT:
        values[column] = text_or_null(source[field])

    faults.append((long_unfit(source["lsn"], source_types["lsn"]), "lsn is not a 64-bit integer"))
    parts = {f"_{column}": decimal_parts(payload[field]) for field, column in feed.amounts}
    readings = {f"_{column}": judge_decimal(F.col(f"_{column}")) for _, column in feed.amounts}
    typed = changes.withColumn("payload", _payload(envelope)).withColumns(parts).withColumns(readings).select(
        "envelope",
        *(["raw"] if has_raw else []),
        *(value.alias(column) for column, value in values.items()),
        F.coalesce(*(F.when(broken, F.lit(reason)) for broken, reason in faults)).alias("unreadable"),
    )

    deleted = F.col("op") == DELETE
    missing = []
    for column in [*feed.text_columns, "eventTimeMs", "sourceTsMs", "createdAtMs", *dict(SOURCE_TEXT).values()]:
        absent = F.col(column).isNull()
        if column in feed.text_columns and column not in DELETE_KEYS:
            absent = absent & ~deleted
        missing.append(F.when(absent, F.lit(f"{column} is missing")))
    reason = F.coalesce(F.col("unreadable"), *missing)

    # a null record, or one whose fields are all null, is kept as empty text
    fields_of = F.struct(*(envelope[f.name].alias(f.name) for f in fields))
    blank = reduce(and_, (envelope[f.name].isNull() for f in fields))
    as_text = F.when(~blank, F.to_json(fields_of, {"ignoreNullFields": "false"}))
    record = F.coalesce(F.col("raw").cast("string"), as_text) if has_raw else as_text
    checked = typed.withColumn("reject_reason", reason)
    result = checked.select(
        *values,
        "reject_reason",
        F.when(F.col("reject_reason").isNotNull(), record).alias("record"),
    )
    return result.observe(
        f"{INTAKE}_{feed.name}_{uuid.uuid4().hex}",
        F.count(F.lit(1)).alias("rows_in"),
        F.count("reject_reason").alias("rejected"),
    )


def dlq_split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted bronze rows, and ``(reason, record)`` rejects.

    Both come from the same input; persist it first when writing both.
    """
    accepted = checked.filter(F.col("reject_reason").isNull()).drop("reject_reason", "record")
    rejected = checked.filter(F.col("reject_reason").isNotNull()).select(
        F.col("reject_reason").alias("reason"), F.coalesce("record", F.lit("")).alias("record")
    )
    return accepted, rejected


def dlq_format(rejected: DataFrame) -> DataFrame:
    """One JSON text per reject in ``value``; a null record is empty text."""
    body = F.struct(
        F.coalesce("reason", F.lit("")).alias("reason"), F.coalesce("record", F.lit("")).alias("record")
    )
    return rejected.select(F.to_json(body).alias("value"))


def cdc_parse(changes: DataFrame, feed: Feed) -> DataFrame:
    """Accepted bronze rows of a feed, not yet stamped."""
    return dlq_split(cdc_validate(changes, feed))[0]


def stamp(bronze: DataFrame, at: Column | None = None) -> DataFrame:
    """Add ``ingestion_date`` and ``ingestion_hour``, both from one clock."""
    return bronze.select("*", *ingest_stamp(at))


def bronze(changes: DataFrame, feed: Feed, at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The whole row path: stamped bronze rows and rejects."""
    accepted, rejected = dlq_split(cdc_validate(changes, feed))
    return stamp(accepted, at), rejected


def row_to_json(rows: DataFrame) -> DataFrame:
    """Each row as one JSON object in ``value``; null fields are kept."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def not_deleted(rows: DataFrame, op: str = "op") -> DataFrame:
    """Drop delete events. Before a dedup this keeps history; after, live rows."""
    return rows.filter(F.col(op) != DELETE)


def star_except(rows: DataFrame, *columns: str) -> DataFrame:
    """All columns but the named ones."""
    return rows.drop(*columns)
