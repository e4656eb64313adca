"""Replay-safe batch writers for use inside ``foreachBatch``.

Batches are named by the stream and their number. Landing and bronze are tables with
a log of their files: a batch counts once it is committed there, and running it again
changes nothing. Other targets write directories of the batch's name and replace only
those. The stream's id is kept in its checkpoint: a new checkpoint starts new names,
leaves what is there alone and reads its source anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.wire import frame
from tidemark.operators.cdc import dlq_format, row_to_json
from tidemark.schemas import Feed
from tidemark.sources.landing import landing_path
from tidemark.tables import add_batch


# Fixed value: where Spark keeps the id of the stream whose batch this thread runs.
STREAM_ID = "sql.streaming.queryId"


def batch_name(rows: DataFrame, batch_id: int | str) -> str:
    """The directory name of a batch: the stream's id, if one runs, and the batch's number."""
    stream = rows.sparkSession.sparkContext.getLocalProperty(STREAM_ID)
    return f"{stream}-{batch_id}" if stream else str(batch_id)


def write_batch(rows: DataFrame, path: str, batch_id: int | str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    (
        rows.withColumn("batch_id", F.lit(batch_name(rows, batch_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, "batch_id")
        .format(fmt)
        .save(path)
    )


def lz_sink(rows: DataFrame, base: str, feed: Feed, batch_id: int | str) -> None:
    """Landing files right under ``ingestion_date=yyyy-MM-dd/hour=HH``, for any reader of that layout."""
    landed = rows.withColumnRenamed("ingestion_hour", "hour")
    add_batch(landed, landing_path(base, feed), batch_name(rows, batch_id), feed, ["ingestion_date", "hour"])


def bronze_sink(rows: DataFrame, path: str, feed: Feed, batch_id: int | str) -> None:
    """Bronze table by day, sorted by (asset, version) within each file."""
    ordered = rows.sortWithinPartitions("ingestion_date", "assetId", "lsn")
    add_batch(ordered, path, batch_name(rows, batch_id), feed, ["ingestion_date"])


def message_sink(messages: DataFrame, target: dict[str, str], batch_id: int | str) -> None:
    """Messages in ``value`` to a topic, or to text files by batch.

    A topic target holds ``kafka.bootstrap.servers`` and ``topic``; delivery is
    at least once. A file target holds ``path``.
    """
    if "path" in target:
        write_batch(messages, target["path"], batch_id, fmt="text")
    else:
        messages.write.format("kafka").options(**target).save()


def kafka_sink(
    rows: DataFrame, target: dict[str, str], batch_id: int | str, avro_schema: str | None = None, schema_id: int | None = None
) -> None:
    """Bronze rows as messages: JSON, or Avro where a schema is given.

    With the id that the registry gave the schema, Avro values carry its header.
    """
    if avro_schema:
        from pyspark.sql.avro.functions import to_avro

        body = to_avro(F.struct("*"), avro_schema)
        messages = rows.select((body if schema_id is None else frame(body, schema_id)).alias("value"))
    else:
        messages = row_to_json(rows)
    message_sink(messages, target, batch_id)


def dead_letter_sink(rejected: DataFrame, target: dict[str, str], batch_id: int | str) -> None:
    message_sink(dlq_format(rejected), target, batch_id)
