"""One change feed to all of its targets."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.util import inheritable_thread_target

from tidemark.functions.clock import as_instant
from tidemark.operators.cdc import cdc_validate, dlq_split, stamp
from tidemark.schemas import Feed
from tidemark.session import Files, drop_staged, stage
from tidemark.streaming.sinks import bronze_sink, dead_letter_sink, kafka_sink, lz_sink

# Fixed value: time between checkpoints.
CHECKPOINT_EVERY = "30 seconds"
SNAPSHOT = "snapshot"


@dataclass(frozen=True)
class Targets:
    """Where a feed's rows go. A target left out is not written."""

    landing: str | None = None
    bronze: str | None = None
    topic: dict[str, str] = field(default_factory=dict)
    dead_letters: dict[str, str] = field(default_factory=dict)
    avro_schema: str | None = None
    schema_id: int | None = None


def checked_rows(changes: DataFrame, feed: Feed, at: Column | None = None) -> DataFrame:
    """Validated, stamped rows of a stream.

    The stamp is taken in the stream's own plan, where the current time is the
    micro-batch time kept in the checkpoint, so a replay stamps alike.
    """
    return stamp(cdc_validate(changes, feed), at)


def fan_out(checked: DataFrame, batch_id: int | str, feed: Feed, targets: Targets) -> None:
    """Write one checked batch to every target; safe to run again.

    The batch is parsed once into the shared folder, which every target reads; it
    is deleted when all are written. A rate limit on the source bounds its size.
    The targets are written side by side; all end before the first failure is raised.
    """
    staged = stage(checked, "batch")
    accepted, rejected = dlq_split(staged)
    accepted = accepted.select(*feed.bronze_columns)
    writes = []
    if targets.landing:
        writes.append(lambda: lz_sink(accepted, targets.landing, feed, batch_id))
    if targets.bronze:
        writes.append(lambda: bronze_sink(accepted, targets.bronze, feed, batch_id))
    if targets.topic:
        writes.append(lambda: kafka_sink(accepted, targets.topic, batch_id, targets.avro_schema, targets.schema_id))
    if targets.dead_letters:
        writes.append(lambda: dead_letter_sink(rejected, targets.dead_letters, batch_id))
    try:
        with ThreadPoolExecutor(max(1, len(writes))) as pool:
            # threads take over the stream's id and job group
            ended = [pool.submit(inheritable_thread_target(checked.sparkSession)(write)) for write in writes]
        for write in ended:
            write.result()
    finally:
        drop_staged(staged)


def start_bronze(
    changes: DataFrame,
    feed: Feed,
    targets: Targets,
    checkpoint: str,
    available_now: bool = False,
    at: Column | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Run a change stream into its targets until stopped, or until caught up."""
    writer = (
        checked_rows(changes, feed, at)
        .writeStream.queryName(name or f"bronze-{feed.name}")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: fan_out(batch, batch_id, feed, targets))
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=CHECKPOINT_EVERY).start()


def _done(spark: SparkSession, marker: str) -> bool:
    """Whether the marker table was written to its end."""
    try:
        return spark.read.schema("id bigint").parquet(marker).count() > 0
    except AnalysisException:
        return False


def _kept_id(spark: SparkSession, path: str) -> str:
    """An id that is made once and kept under ``path``."""
    try:
        return spark.read.schema("id string").parquet(path).first().id
    except (AnalysisException, AttributeError):
        spark.createDataFrame([(uuid.uuid4().hex,)], "id string").write.mode("overwrite").parquet(path)
        return spark.read.schema("id string").parquet(path).first().id


def snapshot_then_stream(
    snapshot: DataFrame,
    changes: DataFrame,
    feed: Feed,
    targets: Targets,
    checkpoint: str,
    taken_at: datetime,
    available_now: bool = False,
    at: Column | None = None,
) -> StreamingQuery:
    """Load the snapshot events once, then follow the live changes.

    Both pass through the same transform and writers. The snapshot is stamped with
    its own time and named by an id kept beside the checkpoint, so a restart before
    its marker exists repeats it without harm and a later one skips it.
    """
    spark = snapshot.sparkSession
    marker = f"{checkpoint}/snapshot"
    if not _done(spark, marker):
        stamped = checked_rows(snapshot, feed, at if at is not None else as_instant(taken_at))
        fan_out(stamped, f"{SNAPSHOT}-{_kept_id(spark, f'{checkpoint}/snapshot-id')}", feed, targets)
        spark.range(1).write.mode("overwrite").parquet(marker)
    return start_bronze(changes, feed, targets, f"{checkpoint}/live", available_now, at)


def _chunk_bounds(table: DataFrame, order: str, chunks: int) -> list:
    """Values that cut a table into ranges of about as many rows; a value is in one range only."""
    cuts = table.agg(F.percentile_approx(order, [n / chunks for n in range(1, chunks)], chunks * 100)).first()[0] if chunks > 1 else []
    return sorted(set(cuts or []))


def snapshot_in_chunks(
    spark: SparkSession,
    table: Callable[[], DataFrame],
    envelopes: Callable[[DataFrame, int], DataFrame],
    changes: DataFrame,
    feed: Feed,
    targets: Targets,
    checkpoint: str,
    order: str,
    position: Callable[[], int],
    chunks: int = 64,
    available_now: bool = False,
    at: Column | None = None,
    follow_between: bool = True,
) -> StreamingQuery:
    """Load a table range by range while its live changes go on, then follow them.

    ``table`` gives the source's rows as they are when it is called, once for each range.
    The ranges of ``order``, a column that the source can filter by, are settled once and
    kept beside the checkpoint. Each range is a batch of its own: ``envelopes`` makes its
    events, stamped with the source's position before it is read (the low mark), and the
    position after it is kept as the high mark. A change between the marks has a higher
    version than the range's row, whichever arrives first, so the newest state is the
    same as with a snapshot taken at one moment. Between ranges the live changes so far
    are followed, so they don't wait for the snapshot's end.

    A run that stopped goes on after its last whole range. A range is stored as read before
    any target gets it, so one that died halfway reaches all targets with the same rows. Rows
    whose order is null are a range of their own. ``order`` is a number, a date or a time.
    """
    files, folder = Files(spark), f"{checkpoint}/chunks"
    plan_file, kind = f"{folder}/plan.json", table().schema[order].dataType
    if not files.exists(plan_file):
        bounds = _chunk_bounds(table(), order, chunks)
        # as text of the column's own type, so that a restart cuts alike
        held = spark.createDataFrame([(b,) for b in bounds], T.StructType([T.StructField("b", kind)]))
        texts = [r[0] for r in held.select(F.col("b").cast("string")).collect()]
        files.write(plan_file, json.dumps({"id": uuid.uuid4().hex, "bounds": texts}))
    plan = json.loads(files.read(plan_file))
    edges = [None, *[F.lit(b).cast(kind) for b in plan["bounds"]], None]
    value = F.col(order)
    ranges = [value.isNull()]
    for low, high in zip(edges, edges[1:]):
        inside = value.isNotNull()
        inside = inside & (value > low) if low is not None else inside
        ranges.append(inside & (value <= high) if high is not None else inside)

    for number, chosen in enumerate(ranges):
        done, read, marks = (f"{folder}/{number:06d}.{part}" for part in ("done", "rows", "marks"))
        if files.exists(done):
            continue
        if not files.exists(marks):
            low = position()
            checked_rows(envelopes(table().where(chosen), low), feed, at).write.mode("overwrite").parquet(read)
            files.write(marks, json.dumps({"low": low, "high": position()}))
        fan_out(spark.read.parquet(read), f"{SNAPSHOT}-{plan['id']}-{number:06d}", feed, targets)
        files.move(marks, done)
        files.delete(read)
        if follow_between:
            start_bronze(changes, feed, targets, f"{checkpoint}/live", True, at).awaitTermination()
    return start_bronze(changes, feed, targets, f"{checkpoint}/live", available_now, at)
