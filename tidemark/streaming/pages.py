"""Pages of the remote API into the two source tables, as a job.

Each batch of pages becomes price and cap rows. Keys that a table holds already are left
alone, rows that its constraints refuse and pages or assets that cannot be read go to a
folder of rejects with the reason. A batch that runs again replaces what it wrote.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.clock import as_instant
from tidemark.operators.ingest import CAP_RULES, PRICE_RULES, TableRules, api_page_explode, page_inserts
from tidemark.schemas import CAPS, MONEY, PRICES
from tidemark.session import Files, stage
from tidemark.streaming.sinks import batch_name, write_batch

RULES = {PRICES.name: PRICE_RULES, CAPS.name: CAP_RULES}
IDENTITY = ("asset_id", "symbol", "coin_name", "currency")
COLUMNS = {
    PRICES.name: (*IDENTITY, "price", "market_cap", "volume_24h", "coin_image", "event_time", "source_ts", "created_at"),
    CAPS.name: (*IDENTITY, "market_cap", "circulating_supply", "total_supply", "max_supply", "event_time", "source_ts", "created_at"),
}
TIMES = ("event_time", "source_ts", "created_at")
REJECTS = "batch_id string, page string, table_name string, reason string, body string"


def table_schema(name: str) -> T.StructType:
    amounts = {c for c, _, _ in RULES[name].numeric}
    kind = lambda c: MONEY if c in amounts else T.TimestampType() if c in TIMES else T.StringType()
    return T.StructType([T.StructField(c, kind(c)) for c in COLUMNS[name]])


def source_table(spark: SparkSession, root: str, name: str, but_batch: str | None = None) -> DataFrame:
    """A source table as its page batches have filled it. None yet is no rows."""
    shape = table_schema(name)
    path = f"{root}/{name}"
    if not Files(spark).exists(path):
        return spark.createDataFrame([], shape)
    rows = spark.read.schema(T.StructType([*shape.fields, T.StructField("event_day", T.DateType()), T.StructField("batch_id", T.StringType())])).parquet(path)
    kept = rows if but_batch is None else rows.where(F.col("batch_id") != but_batch)
    return kept.select(*shape.names)


def _add(rows: DataFrame, root: str, name: str, rules: TableRules, taken_at: datetime, batch_id: int | str) -> DataFrame:
    """Add a batch's rows to a source table; returns those it refused."""
    spark = rows.sparkSession
    held = source_table(spark, root, name, batch_name(rows, batch_id))
    added, refused = page_inserts(rows, held, rules, as_instant(taken_at), within="event_time")
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema(name)]
    # its own earlier try may have reached days that this one does not
    for folder in Files(spark).glob(f"{root}/{name}/event_day=*/batch_id={batch_name(rows, batch_id)}"):
        Files(spark).delete(folder)
    write_batch(added.select(*columns, F.to_date("event_time").alias("event_day")), f"{root}/{name}", batch_id, ["event_day"])
    body = F.to_json(F.struct(*[c for c in refused.columns if c != "violation"]))
    return refused.select(F.lit(None).cast("string").alias("page"), F.lit(name).alias("table_name"), F.col("violation").alias("reason"), body.alias("body"))


def take_pages(pages: DataFrame, root: str, taken_at: datetime, batch_id: int | str) -> None:
    """Bring a batch of ``page`` and ``body`` into the tables under ``root``."""
    staged = stage(pages.select(F.col("page").cast("string").alias("page"), "body"), "pages")
    prices, caps, unread = api_page_explode(staged, loaded_at=as_instant(taken_at))
    rejects = unread.select("page", F.lit(None).cast("string").alias("table_name"), "reason", "body")
    for name, rows in ((PRICES.name, prices), (CAPS.name, caps)):
        rejects = rejects.unionByName(_add(stage(rows, "page-rows"), root, name, RULES[name], taken_at, batch_id))
    write_batch(rejects, f"{root}/rejects", batch_id)


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """What pages were refused, and why."""
    path = f"{root}/rejects"
    return spark.read.schema(REJECTS).parquet(path) if Files(spark).exists(path) else spark.createDataFrame([], REJECTS)


def page_files(spark: SparkSession, location: str, per_batch: int | None = None) -> DataFrame:
    """A folder of page files as a stream: the file's name is the page, its whole text the body."""
    reader = spark.readStream.format("text").option("wholetext", "true")
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", str(per_batch))
    return reader.load(location).select(F.col("_metadata.file_path").alias("page"), F.col("value").alias("body"))


def page_stream(pages: DataFrame, root: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Follow a stream of pages. A batch's rows carry its own time, which a repetition keeps."""

    def step(batch: DataFrame, batch_id: int) -> None:
        first = batch.select("taken_at").first()
        if first:
            take_pages(batch, root, first.taken_at, batch_id)

    stamped = pages.withColumn("taken_at", F.current_timestamp())
    writer = stamped.writeStream.queryName("pages").option("checkpointLocation", checkpoint).foreachBatch(step)
    return writer.trigger(**({"availableNow": True} if available_now else {"processingTime": "60 seconds"})).start()
