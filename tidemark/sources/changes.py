"""Change feeds: unbounded or bounded reads that give ``envelope`` and ``raw``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import as_instant
from tidemark.functions.wire import confluent_header
from tidemark.schemas import Feed, envelope_schema, json_envelope_schema


def envelope_from_json(lines: DataFrame, feed: Feed, value: str = "value") -> DataFrame:
    """JSON text to envelopes. Text that is not JSON gives an empty envelope."""
    text = F.col(value).cast("string")
    return lines.select(text.alias("raw"), F.from_json(text, json_envelope_schema(feed)).alias("envelope"))


def avro_decoder(body: Column, writer_schema: str, reader_schema: str) -> Column:
    """One body written with one schema and read as another; null where it can't be decoded."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(body, writer_schema, {"mode": "PERMISSIVE", "avroSchema": reader_schema})


def envelope_from_avro(
    messages: DataFrame,
    writer_schemas: dict[int, str],
    reader_schema: str,
    value: str = "value",
    decode: Callable[[Column, str, str], Column] = avro_decoder,
) -> DataFrame:
    """Registry-framed Avro to envelopes (needs the spark-avro package).

    Each message is decoded with the schema its header names. A wrong magic byte,
    an unknown id or an undecodable body gives a null envelope, and ``raw`` then
    holds the message's bytes in base64, for the dead letter.
    """
    _, schema_id, body = confluent_header(F.col(value))
    framed = messages.select(F.col(value).alias("bytes"), schema_id, body)
    known = [F.when(F.col("schema_id") == n, decode(F.col("body"), s, reader_schema)) for n, s in writer_schemas.items()]
    decoded = framed.select("bytes", F.coalesce(*known).alias("envelope"))
    return decoded.select(F.when(F.col("envelope").isNull(), F.base64("bytes")).alias("raw"), "envelope")


def cdc_stream(
    spark: SparkSession,
    feed: Feed,
    location: str,
    fmt: str = "json",
    topic: str | None = None,
    reader_schema: str | None = None,
    writer_schemas: dict[int, str] | None = None,
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """Change events of a feed, message value only.

    ``fmt="kafka"`` reads ``topic`` from the brokers at ``location``: from the
    earliest offset on the first start, from the checkpoint afterwards. Values
    are Avro when a ``reader_schema`` is given, with the registry's ``writer_schemas``
    by id, else JSON. ``fmt="json"`` reads
    text files of one event per line, ``fmt="parquet"`` files of envelopes.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.options(**options)
    if fmt == "kafka":
        messages = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", location)
            .option("subscribe", topic or feed.name)
            .option("startingOffsets", "earliest")
            .load()
        )
        if reader_schema:
            return envelope_from_avro(messages, writer_schemas or {}, reader_schema)
        return envelope_from_json(messages, feed)
    if fmt == "json":
        return envelope_from_json(reader.format("text").load(location), feed)
    if fmt == "parquet":
        rows = reader.schema(envelope_schema(feed)).format("parquet").load(location)
        return rows.select(F.struct(*envelope_schema(feed).names).alias("envelope"))
    raise ValueError(f"unknown change feed format: {fmt}")


def snapshot_envelopes(
    table: DataFrame,
    feed: Feed,
    lsn: Column,
    taken_at: Column | datetime | None = None,
    db: str = "market",
    schema: str = "public",
) -> DataFrame:
    """Rows of a source table as ``op='r'`` events of the feed.

    Amounts become text and times ISO text, the form live changes arrive in.
    """
    kinds = dict(table.dtypes)
    names = envelope_schema(feed)["after"].dataType.names
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    image = F.struct(
        *[
            (F.date_format(n, iso) if kinds.get(n) == "timestamp" else F.col(n).cast("string")).alias(n)
            if n in kinds
            else F.lit(None).cast("string").alias(n)
            for n in names
        ]
    )
    envelope = F.struct(
        F.lit("r").alias("op"),
        F.lit(None).cast(envelope_schema(feed)["before"].dataType).alias("before"),
        image.alias("after"),
        F.struct(
            F.lit(db).alias("db"),
            F.lit(schema).alias("schema"),
            F.lit(feed.name).alias("table"),
            lsn.cast("bigint").alias("lsn"),
            F.unix_millis(as_instant(taken_at)).alias("ts_ms"),
        ).alias("source"),
    )
    return table.select(envelope.alias("envelope"))
