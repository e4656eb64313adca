"""Streaming progress, kept by day, as metric rows for the lag and checkpoint reports.

A running query remembers its last hundred batches only. The listener here keeps
every progress report as a small JSON file under its day, named by run and batch and
written by Hadoop's file system, so no job runs for it and a repeated report replaces
itself. Days that are over are rolled into one table each and dropped in time, so a
report of the last hour opens the files of one or two days.
"""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.operators.cdc import INTAKE
from tidemark.operators.series import chunked, running_total
from tidemark.session import Files

REPORT = """
    name string, id string, runId string, batchId bigint, timestamp string, durationMs map<string,bigint>,
    observedMetrics map<string,struct<rows_in:bigint,rejected:bigint>>,
    sources array<struct<startOffset:string,endOffset:string,latestOffset:string>>
"""
OFFSETS = "map<string,map<string,bigint>>"

# Fixed value: days that reports are kept.
KEEP_DAYS = 15


class ProgressLog(StreamingQueryListener):
    """Writes each progress report of the session's queries under a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.files, self.path = Files(spark), path.rstrip("/")

    def keep(self, run: str, batch: int, report: str) -> None:
        day = json.loads(report)["timestamp"][:10]
        self.files.write(f"{self.path}/day={day}/{run}-{batch}.json", " ".join(report.split()))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.keep(str(progress.runId), progress.batchId, progress.json)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _days(files: Files, path: str) -> dict[str, str]:
    """Folder of each day that has reports: the rolled one, where there is one."""
    found = {f.rsplit("day=", 1)[1]: f for f in files.glob(f"{path}/day=*")}
    rolled = {f.rsplit("/", 2)[1].removeprefix("day="): f.rsplit("/", 1)[0] for f in files.glob(f"{path}.rolled/day=*/_SUCCESS")}
    return found | rolled


def reports(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """Kept reports as lines of JSON in ``value``, of all days or from one on. None yet is no rows."""
    chosen = {day: f for day, f in _days(Files(spark), path).items() if since is None or day >= since.isoformat()}
    rolled = [f for f in chosen.values() if ".rolled/" in f]
    fresh = [f for f in chosen.values() if ".rolled/" not in f]
    lines = spark.createDataFrame([], "value string")
    if fresh:
        lines = lines.unionByName(spark.read.schema("value string").option("pathGlobFilter", "*.json").text(fresh))
    if rolled:
        lines = lines.unionByName(spark.read.schema("value string").parquet(*rolled))
    return lines


def roll_reports(spark: SparkSession, path: str, today: date) -> list[str]:
    """Roll the days before yesterday into a table each, and drop those past their time; returns the days rolled.

    The small files of a day go when it is found rolled by the next call.
    """
    files, rolled = Files(spark), []
    for day, folder in _days(files, path).items():
        if day < (today - timedelta(days=KEEP_DAYS)).isoformat():
            files.delete(f"{path}/day={day}")
            files.delete(f"{path}.rolled/day={day}")
        elif ".rolled/" in folder:
            files.delete(f"{path}/day={day}")
        elif day < (today - timedelta(days=1)).isoformat():
            lines = spark.read.schema("value string").option("pathGlobFilter", "*.json").text(folder)
            lines.coalesce(1).write.mode("overwrite").parquet(f"{path}.rolled/day={day}")
            rolled.append(day)
    return rolled


def _parsed(lines: DataFrame) -> DataFrame:
    report = lines.select(F.from_json("value", REPORT).alias("p")).select("p.*")
    return report.withColumn("ts", F.col("timestamp").cast("timestamp"))


def offset_rows(lines: DataFrame) -> DataFrame:
    """Latest and read offsets per topic partition of queries that read a broker.

    The query's name stands for the consumer group. Other sources report offsets
    of another shape and are left out. A partition that has not been read yet counts
    from the first offset that any report starts it at, or from 0 if none does.
    """
    offsets = lambda text: F.from_json(text, OFFSETS, {"mode": "PERMISSIVE"})
    source = _parsed(lines).select("ts", "name", F.explode("sources").alias("s"))
    begun = source.select("name", F.explode(offsets(F.col("s.startOffset"))).alias("topic", "starts"))
    begun = begun.select("name", "topic", F.explode("starts").alias("partition", "start"))
    first = begun.groupBy("name", "topic", "partition").agg(F.min("start").alias("first_offset"))
    both = source.select("ts", "name", offsets(F.col("s.endOffset")).alias("read"), offsets(F.col("s.latestOffset")).alias("latest"))
    topics = both.select("ts", "name", "read", F.explode("latest").alias("topic", "ends"))
    parts = topics.select("ts", "name", "topic", F.col("read")[F.col("topic")].alias("known"), F.explode("ends").alias("partition", "end_offset"))
    return parts.join(first, ["name", "topic", "partition"], "left").select(
        "ts",
        F.col("name").alias("consumergroup"),
        "topic",
        F.col("partition").cast("int").alias("partition"),
        "end_offset",
        F.coalesce(F.col("known")[F.col("partition")], "first_offset", F.lit(0)).cast("bigint").alias("committed_offset"),
    ).where("end_offset is not null")


def progress_rows(lines: DataFrame) -> DataFrame:
    """One metric row per reported micro-batch."""
    intake = F.map_values(F.map_filter("observedMetrics", lambda name, _: F.startswith(name, F.lit(INTAKE))))
    return _parsed(lines).select(
        "ts",
        F.col("name").alias("job_name"),
        F.col("batchId").alias("batch_id"),
        F.coalesce(F.col("durationMs")["triggerExecution"], F.lit(0)).cast("bigint").alias("duration_ms"),
        F.get(intake, 0)["rows_in"].alias("rows_in"),
        F.get(intake, 0)["rejected"].alias("rejected"),
    )


def dead_letter_offsets(lines: DataFrame) -> DataFrame:
    """Rejected rows so far as offsets of ``bronze.<feed>.dlq``, one sample per batch.

    The same counter a dead-letter topic's offsets would show, for jobs whose
    dead letters go to files.
    """
    feed = F.regexp_extract("job_name", r"bronze-(.*)\z", 1)
    batches = progress_rows(lines).where("rejected is not null")
    timed = batches.select(F.concat(F.lit("bronze."), feed, F.lit(".dlq")).alias("topic"), "ts", "rejected")
    per_time = timed.groupBy("topic", "ts").agg(F.sum("rejected").alias("rejected"))
    total = running_total(chunked(per_time, "ts", 86400), ["topic"], "ts", {"current_offset": F.col("rejected")})
    return total.select("topic", F.lit(0).alias("partition"), "ts", "current_offset")


def dead_letter_increase(lines: DataFrame, window_minutes: int = 10) -> DataFrame:
    """Rejected rows of the trailing window at each minute up to the last with a batch, as ``ts`` and ``increase``.

    What ``counter_increase`` says of the counter, but for its first sample, which here counts:
    so the reports of the window's own minutes are enough.
    """
    minute = F.ceil(F.unix_seconds("ts") / F.lit(60)).cast("bigint")
    counted = progress_rows(lines).where("rejected is not null").groupBy(minute.alias("minute")).agg(F.sum("rejected").alias("n"))
    last = counted.agg(F.max("minute").alias("last"))
    evaluated = F.explode(F.sequence(F.col("minute"), F.col("minute") + F.lit(window_minutes - 1))).alias("at")
    spread = counted.select("n", evaluated).crossJoin(F.broadcast(last)).where("at <= last")  # one row
    return spread.groupBy(F.timestamp_seconds(F.col("at") * 60).alias("ts")).agg(F.sum("n").alias("increase"))
