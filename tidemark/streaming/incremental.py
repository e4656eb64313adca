"""Silver state and gold facts kept up to date batch by batch.

A batch adds its own partial result under its batch id; readers merge. The
merge gives the same answer for any split of the events, so nothing is updated
in place, and compaction only bounds how much there is to merge.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ingest import value_ranges, within_ranges
from tidemark.operators.state import STATE_KEYS, STATE_VERSION, partial_state, replacing_dedup, state_merge
from tidemark.plans import gold, silver
from tidemark.schemas import PRICES, Feed, bronze_schema
from tidemark.session import Files, delete_folder, list_folders
from tidemark.streaming import newest
from tidemark.streaming.sinks import batch_name, write_batch


def append_parts(
    events: DataFrame,
    part: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    available_now: bool = False,
    after: Callable[[SparkSession, str], None] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append what each micro-batch contributes to a table, under its batch id.

    ``after`` is called with the name of each batch that has been written.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        write_batch(part(batch), path, batch_id, partition_by)
        if after:
            after(batch.sparkSession, batch_name(batch, batch_id))

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if available_now else {"processingTime": "30 seconds"}
    return writer.trigger(**trigger).start()


@dataclass(frozen=True)
class Model:
    """What each batch of bronze contributes to a table, and what is done once that is written."""

    feed: Feed
    part: Callable[[DataFrame], DataFrame]
    partition_by: tuple[str, ...] = ()
    after: Callable[[SparkSession, str], None] | None = None

    def stream(self, bronze: DataFrame, path: str, checkpoint: str, available_now: bool = False, name: str | None = None) -> StreamingQuery:
        return append_parts(bronze, self.part, path, checkpoint, self.partition_by, available_now, self.after, name)

    def begin(self, bronze: DataFrame, path: str) -> None:
        """Bring in what a stream over bronze's own folder will not find there: rows rewritten beside it."""
        write_batch(self.part(bronze), path, BEGINNING, self.partition_by)
        if self.after:
            self.after(bronze.sparkSession, BEGINNING)


BEGINNING = "beginning"


def latest_state_stream(
    events: DataFrame,
    payload: Sequence[str],
    path: str,
    checkpoint: str,
    keys: Sequence[str] = STATE_KEYS,
    version: Sequence[str] = STATE_VERSION,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep each micro-batch's newest event per key as partial state."""
    part = lambda batch: partial_state(batch, payload, keys, version)
    return append_parts(events, part, path, checkpoint, available_now=available_now)


def state_model(feed: Feed) -> Model:
    """Each batch's newest event per asset."""
    payload = silver.state_payload(feed)
    return Model(feed, lambda batch: partial_state(batch, payload, STATE_KEYS, STATE_VERSION))


def fact_model(feed: Feed, path: str) -> Model:
    """Each batch's facts, by event month, their newest event and how many keys they add."""

    def part(batch: DataFrame) -> DataFrame:
        facts = replacing_dedup(gold.fact_rows(batch, feed), gold.FACT_KEY, "lsn")
        return facts.withColumn("event_month", gold.event_month(F.col("event_time_ms")))

    def note(spark: SparkSession, batch: str) -> None:
        own = list_folders(spark, f"{path}/event_month=*/batch_id={batch}")
        newest.note(spark, path, batch, own, new_keys(spark, path, feed, own))

    return Model(feed, part, ("event_month",), note)


def dim_asset_model() -> Model:
    """Each batch's newest attributes per asset."""
    return Model(PRICES, lambda batch: replacing_dedup(gold.dim_asset_rows(batch), gold.DIM_KEY, "last_lsn"))


def fact_stream(bronze: DataFrame, feed: Feed, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    return fact_model(feed, path).stream(bronze, path, checkpoint, available_now)


def dim_asset_stream(prices: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    return dim_asset_model().stream(prices, path, checkpoint, available_now)


def new_keys(spark: SparkSession, path: str, feed: Feed, own: Sequence[str]) -> int:
    """How many keys the facts of a batch, under its own folders, add to those of all others.

    Of the others only the key columns are read, in the batch's months and where their
    times are near the batch's: one late fact does not widen that to all between.
    """
    if not own:
        return 0
    shape = fact_shape(spark, feed)
    rows = lambda folders: spark.read.schema(shape).option("basePath", path).parquet(*folders).select("event_month", *gold.FACT_KEY)
    batch, mine = rows(own), set(own)
    others = [f for month in {o.rsplit("/", 1)[0] for o in own} for f in list_folders(spark, f"{month}/batch_id=*") if f not in mine]
    if not others:
        return batch.count()
    known = within_ranges(rows(others), "event_time_ms", value_ranges(batch, "event_time_ms"))
    return batch.join(known, list(gold.FACT_KEY), "left_anti").count()


def _parts(spark: SparkSession, path: str, shape: T.StructType) -> DataFrame:
    """Partial results of all batches. None yet is no rows."""
    if not Files(spark).exists(path):
        return spark.createDataFrame([], shape)
    return spark.read.schema(shape).parquet(path).select(*shape.names)


def read_facts(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """The fact table: the highest version over all batches."""
    shape = gold.fact_rows(spark.createDataFrame([], bronze_schema(feed)), feed).schema
    return gold.fact_table(_parts(spark, path, shape))


def read_dim_asset(spark: SparkSession, path: str) -> DataFrame:
    shape = gold.dim_asset_rows(spark.createDataFrame([], bronze_schema(PRICES))).schema
    return replacing_dedup(_parts(spark, path, shape), gold.DIM_KEY, "last_lsn")


def read_state(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str] = STATE_KEYS,
    version: Sequence[str] = STATE_VERSION,
) -> DataFrame:
    """The merged state, one row per key, deletes included."""
    return state_merge(_parts(spark, path, schema), keys=keys, version=version)


def compact_state(
    spark: SparkSession,
    path: str,
    target: str,
    schema: T.StructType,
    keys: Sequence[str] = STATE_KEYS,
    version: Sequence[str] = STATE_VERSION,
) -> None:
    """Write the merged state to ``target`` as one partial result.

    The old folder is left alone: point readers at the new one, then drop it.
    """
    merged = read_state(spark, path, schema, keys, version)
    merged.withColumn("batch_id", F.lit("merged")).write.mode("overwrite").partitionBy("batch_id").parquet(target)


def _replaced(path: str) -> str:
    """Where a table keeps the lists of folders that a merged one stands for."""
    return f"{path}.replaced"


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete the folders that earlier compactions have merged, and return how many."""
    try:
        lists = spark.read.schema("value string").text(_replaced(path))
        folders = [r.value for r in lists.collect()]  # one name per batch since the last compaction
    except AnalysisException:
        return 0
    for folder in folders:
        delete_folder(spark, folder)
    delete_folder(spark, _replaced(path))
    return len(folders)


# Size up to which a part is of the first tier; each further tier holds parts up to ``fanout`` times as large.
SMALL_PART = 1 << 20


def tier(size: int, fanout: int) -> int:
    """The tier of a part by its bytes."""
    level, most = 0, SMALL_PART
    while size > most:
        level, most = level + 1, most * fanout
    return level


def merges(parts: dict[str, int], fanout: int, most_bytes: int | None = None) -> list[str]:
    """Which of a partition's parts, given with their bytes, to merge into one.

    The lowest tier with at least ``fanout`` parts, and what is smaller than it. So a byte
    is rewritten about once a tier, and a part of the greatest tier only when as many of
    its size have come together. ``most_bytes`` leaves greater merges for another time.
    """
    by_tier: dict[int, list[str]] = {}
    for name in sorted(parts):
        by_tier.setdefault(tier(parts[name], fanout), []).append(name)
    for level in sorted(by_tier):
        if len(by_tier[level]) >= fanout:
            chosen = [n for low in sorted(by_tier) if low <= level for n in by_tier[low]]
            within = most_bytes is None or sum(parts[n] for n in chosen) <= most_bytes
            return chosen if within else []
    return []


def compact(
    spark: SparkSession,
    path: str,
    shape: T.StructType,
    merge: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
    fanout: int = 2,
    most_bytes: int | None = None,
) -> int:
    """Merge a table's partial results in place, while batches go on arriving.

    The merged rows are one more partial result, so readers get the same answer
    at every moment. Folders they stand for are deleted by the next call, when
    readers that listed them are done. In each partition the parts of one tier of
    size are merged, if there are ``fanout`` of them: what a table of any size
    rewrites per batch grows with the logarithm of its size, and a reader merges
    fewer than ``fanout`` parts per tier. Returns the number of folders merged.
    """
    drop_replaced(spark, path)
    files = Files(spark)
    held: dict[str, dict[str, int]] = {}
    for folder in files.glob("/".join([path, *(f"{c}=*" for c in partition_by), "batch_id=*"])):
        held.setdefault(folder.rsplit("/", 1)[0], {})[folder] = files.size(folder)
    chosen = [folder for parts in held.values() for folder in merges(parts, fanout, most_bytes)]
    if not chosen:
        return 0
    parts = spark.read.schema(shape).option("basePath", path).parquet(*chosen).select(*shape.names)
    name = f"merged-{uuid.uuid4().hex}"
    merge(parts).withColumn("batch_id", F.lit(name)).write.mode("append").partitionBy(*partition_by, "batch_id").parquet(path)
    spark.createDataFrame([(f,) for f in chosen], "value string").write.mode("append").text(_replaced(path))
    return len(chosen)


def fact_shape(spark: SparkSession, feed: Feed) -> T.StructType:
    rows = gold.fact_rows(spark.createDataFrame([], bronze_schema(feed)), feed)
    return rows.withColumn("event_month", gold.event_month(F.col("event_time_ms"))).schema


def compact_facts(spark: SparkSession, path: str, feed: Feed, **limits: int) -> int:
    merge = lambda parts: replacing_dedup(parts, gold.FACT_KEY, "lsn")
    return compact(spark, path, fact_shape(spark, feed), merge, ["event_month"], **limits)


def compact_dim_asset(spark: SparkSession, path: str, **limits: int) -> int:
    shape = gold.dim_asset_rows(spark.createDataFrame([], bronze_schema(PRICES))).schema
    return compact(spark, path, shape, lambda parts: replacing_dedup(parts, gold.DIM_KEY, "last_lsn"), **limits)


def compact_silver(spark: SparkSession, path: str, feed: Feed, **limits: int) -> int:
    shape = state_shape(spark, feed)
    return compact(spark, path, shape, lambda parts: state_merge(parts, keys=STATE_KEYS, version=STATE_VERSION), **limits)


def state_shape(spark: SparkSession, feed: Feed) -> T.StructType:
    """The columns of a feed's state."""
    empty = spark.createDataFrame([], bronze_schema(feed))
    return empty.select(*STATE_KEYS, *STATE_VERSION, *silver.state_payload(feed)).schema
