"""Alert states kept up to date, a few minutes of evaluations at a time.

Each step is numbered, by the micro-batch or the minute it is for, and numbers only grow.
A step reads what the step before it holds of each rule, settles the new evaluations and
writes their states and what it holds itself. One that runs again reads the same and
replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.series import HELD, continue_hold, hold_so_far
from tidemark.session import Files
from tidemark.streaming.incremental import compact

STATES = "ts timestamp, rule_uid string, value double, threshold double, hold_minutes int, since timestamp, state string"
# Steps whose holdings are kept, so that the last ones can run again.
KEPT_STEPS = 5


def _held_folder(path: str, number: int) -> str:
    return f"{path}.held/{number:012d}"


def held(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """What the last step, or the last one before that number, holds of each rule."""
    steps = [f for f in Files(spark).glob(f"{path}.held/*") if before is None or int(f.rsplit("/", 1)[1]) < before]
    shape = f"rule_uid string, {HELD}"
    return spark.read.schema(shape).parquet(steps[-1]) if steps else spark.createDataFrame([], shape)


def advance(evaluations: DataFrame, path: str, number: int, every_minutes: int = 1) -> None:
    """Settle new evaluations as step ``number``."""
    spark, files = evaluations.sparkSession, Files(evaluations.sparkSession)
    earlier = held(spark, path, number)
    wanted = evaluations.select("ts", "rule_uid", "value", "threshold", "hold_minutes")
    states = continue_hold(wanted, earlier, every_minutes=every_minutes).withColumn("day", F.to_date("ts"))
    target = states.select(*[f.split()[0] for f in STATES.split(", ")], "day").withColumn("batch_id", F.lit(str(number)))
    # a step that is run again may settle fewer days
    for folder in files.glob(f"{path}/day=*/batch_id={number}"):
        files.delete(folder)
    target.write.mode("append").partitionBy("day", "batch_id").parquet(path)
    written = files.glob(f"{path}/day=*/batch_id={number}")
    settled = spark.read.schema(STATES).parquet(*written) if written else spark.createDataFrame([], STATES)
    hold_so_far(settled, earlier).coalesce(1).write.mode("overwrite").parquet(_held_folder(path, number))
    for old in files.glob(f"{path}.held/*")[:-KEPT_STEPS]:
        files.delete(old)


def alert_stream(evaluations: DataFrame, path: str, checkpoint: str, available_now: bool = False, every_minutes: int = 1) -> StreamingQuery:
    """Follow a stream of evaluations that arrive in order of time."""

    def step(batch: DataFrame, batch_id: int) -> None:
        advance(batch, path, batch_id, every_minutes)

    writer = evaluations.writeStream.option("checkpointLocation", checkpoint).queryName("alerts").foreachBatch(step)
    return writer.trigger(**({"availableNow": True} if available_now else {"processingTime": "1 minute"})).start()


def states(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Settled states, of all days or from one on. None yet is no rows."""
    if not Files(spark).exists(path):
        return spark.createDataFrame([], STATES)
    rows = spark.read.schema(f"{STATES}, day date").parquet(path)
    chosen = rows if since is None else rows.where(F.col("day") >= F.lit(since).cast("date"))
    # merged steps stand beside their parts until the next merge
    return chosen.drop("day").dropDuplicates(["rule_uid", "ts"])


def merge_days(spark: SparkSession, path: str) -> int:
    """Merge the steps' files day by day; run it now and then."""
    shape = spark.createDataFrame([], f"{STATES}, day date").schema
    return compact(spark, path, shape, lambda parts: parts.dropDuplicates(["rule_uid", "ts"]), ["day"])
