"""Folders of Parquet files with a log of the files that count, and a summary of each.

A batch is written beside the table, moved into its day (and hour) folders under names
made from the batch, and then committed: one small file under ``<path>.log`` lists its
files, each with row count, bytes, version range, newest event and checksum per day and
hour. A commit may also list files that no longer count. Files are added once and removed
once, under names that never come again, so the live files are those added less those
removed, in whatever order commits are read, and a commit takes effect as a whole.

* A batch that runs again does nothing if it was committed; if it was prepared and died
  while its files were moved, the same files are moved on.
* :func:`compact_days` rewrites days into few sorted files and swaps them in by one
  commit. They lie under ``<path>.sorted``, where streams that follow the table's folder
  don't look, so neither these nor readers of the log see a row twice.
* :func:`roll` folds the commits into one base table, so that a reader opens few files.
  :func:`vacuum` deletes files that were removed before the last roll and that the
  streams named to it have read.

Summaries add up, so counts and checksums of a table come from its log. They are taken
from the files as written, by reading back the compared columns of the batch alone;
:func:`audit` takes them again from all files and reports every file that differs.

One job at a time may compact, roll and vacuum a table, beside any number of writers and
readers. The driver handles names: a batch's files, or those of the days read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import as_instant
from tidemark.functions.digest import row_hash
from tidemark.operators.layout import expired, sorted_days
from tidemark.schemas import Feed, bronze_schema
from tidemark.session import Files

DAY, HOUR = "ingestion_date", "ingestion_hour"
# Sums of 64-bit hashes as decimals can't overflow at any row count.
CHECKSUM = "decimal(29,0)"
ENTRY = f"""
    commit string, action string, file string, rewritten boolean, {DAY} date, {HOUR} string, rows bigint,
    min_lsn bigint, max_lsn bigint, newest_ms bigint, checksum {CHECKSUM}
"""
ADD, REMOVE = "add", "remove"
# Sorted rows are sorted again with new ones up to so many times their number.
AGAIN = 4
SORTED = ".sorted"


class Log:
    """Names and small files of a table's log."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)
        self.folder = f"{self.path}.log"

    def exists(self) -> bool:
        return self.files.exists(self.folder)

    def commit_file(self, name: str) -> str:
        return f"{self.folder}/commits/{name}.json"

    def pending_file(self, name: str) -> str:
        return f"{self.folder}/pending/{name}.json"

    def base(self) -> dict:
        """The newest base: its folder, the commits folded into it and the last folded batch per stream."""
        found = self.files.glob(f"{self.folder}/base-*.json")
        if not found:
            return {"number": 0, "folder": None, "folded": [], "named": [], "marks": {}}
        return json.loads(self.files.read(found[-1]))

    def committed(self, name: str) -> bool:
        if self.files.exists(self.commit_file(name)):
            return True
        base = self.base()
        stream, _, batch = name.rpartition("-")
        return name in base["named"] or (batch.isdigit() and int(batch) <= base["marks"].get(stream, -1))

    def lines(self, entries: Iterable[dict]) -> str:
        return "".join(json.dumps(e, default=str) + "\n" for e in entries)

    def finish(self, name: str) -> None:
        """Move a prepared commit's files to their places and let them count."""
        prepared = [json.loads(line) for line in self.files.read(self.pending_file(name)).splitlines()]
        self.files.move_all(sorted({(e["source"], e["target"]) for e in prepared if e["action"] == ADD}))
        self.files.move_all([(self.pending_file(name), self.commit_file(name))])

    def prepare(self, name: str, entries: list[dict]) -> None:
        self.files.write(self.pending_file(name), self.lines(entries))


def summary_columns(feed: Feed) -> list[Column]:
    """What a log keeps of a set of rows."""
    return [
        F.count("*").alias("rows"),
        F.min("lsn").alias("min_lsn"),
        F.max("lsn").alias("max_lsn"),
        F.max("eventTimeMs").alias("newest_ms"),
        F.sum(row_hash(feed.checksum_columns).cast("decimal(19,0)")).cast(CHECKSUM).alias("checksum"),
    ]


def _summaries(rows: DataFrame, feed: Feed) -> DataFrame:
    """Summary per file, day and hour."""
    return rows.groupBy(F.col("_metadata.file_path").alias("written"), DAY, HOUR).agg(*summary_columns(feed))


def _as_bronze(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("hour", HOUR) if "hour" in rows.columns else rows


def _prepared(staged: DataFrame, staging: str, target: str, feed: Feed, name: str, rewritten: bool) -> list[dict]:
    """Entries for the files of a staging folder, with where each is to go."""
    entries, names = [], {}
    mark = "/" + "/".join(staging.rsplit("/", 2)[1:]) + "/"
    for row in _summaries(staged, feed).collect():  # one row per file, day and hour of the batch
        inner = unquote(row["written"]).split(mark, 1)[1]
        folder = inner.rsplit("/", 1)[0]
        file = names.setdefault(inner, f"{folder}/{name}-{len(names):05d}.parquet")
        entry = {k: row[k] for k in (DAY, HOUR, "rows", "min_lsn", "max_lsn", "newest_ms", "checksum")}
        places = {"source": f"{staging}/{inner}", "target": f"{target}/{file}"}
        entries.append({"commit": name, "action": ADD, "file": file, "rewritten": rewritten, **entry, **places})
    return entries


def add_batch(rows: DataFrame, path: str, name: str, feed: Feed, partition_by: Sequence[str]) -> bool:
    """Write a batch into the table and commit it; False if that was done before."""
    spark = rows.sparkSession
    log = Log(spark, path)
    if log.committed(name):
        return False
    staging = f"{log.path}.staging/{name}"
    if not log.files.exists(log.pending_file(name)):
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(staging)
        staged = _as_bronze(spark.read.schema(rows.schema).parquet(staging))
        log.prepare(name, _prepared(staged, staging, log.path, feed, name, False))
    log.finish(name)
    log.files.delete(staging)
    return True


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The live entries of a table: one row per file, day and hour, with its summary."""
    log = Log(spark, path)
    base = log.base()
    commits = spark.createDataFrame([], ENTRY)
    if log.files.exists(f"{log.folder}/commits"):
        folded = F.col("commit").isin(base["folded"]) if base["folded"] else F.lit(False)
        commits = spark.read.schema(ENTRY).json(f"{log.folder}/commits").where(~folded)
    whole = commits
    if base["folder"]:
        whole = spark.read.schema(ENTRY).parquet(base["folder"]).unionByName(commits)
    gone = whole.where(F.col("action") == REMOVE).select("file", "rewritten").distinct()
    return whole.where(F.col("action") == ADD).join(gone, ["file", "rewritten"], "left_anti")


def _places(log: Log, files: DataFrame) -> dict[str, list[str]]:
    """Full names of files by the root they lie under."""
    found: dict[str, list[str]] = {}
    for file, rewritten in files.select("file", "rewritten").distinct().collect():
        root = log.path + (SORTED if rewritten else "")
        found.setdefault(root, []).append(f"{root}/{file}")
    return found


def read(spark: SparkSession, path: str, feed: Feed, schema, keep: Callable[[DataFrame], DataFrame] = lambda e: e) -> DataFrame:
    """The rows of the live files, in bronze columns; ``keep`` chooses among the entries, so other days are not opened."""
    log = Log(spark, path)
    parts = [
        _as_bronze(spark.read.schema(bronze_schema(feed) if root.endswith(SORTED) else schema).option("basePath", root).parquet(*sorted(files)))
        for root, files in sorted(_places(log, keep(entries(spark, path))).items())
    ]
    if not parts:
        return spark.createDataFrame([], bronze_schema(feed))
    whole = parts[0].select(*feed.bronze_columns)
    for part in parts[1:]:
        whole = whole.unionByName(part.select(*feed.bronze_columns))
    return whole


def _removals(chosen: DataFrame, name: str) -> list[dict]:
    files = chosen.select("file", "rewritten", DAY).distinct().collect()
    return [{"commit": name, "action": REMOVE, "file": f, "rewritten": r, DAY: d} for f, r, d in files]


def compact_days(
    spark: SparkSession, path: str, feed: Feed, schema, most_files: int = 1, chosen: Callable[[DataFrame], DataFrame] = lambda e: e
) -> int:
    """Rewrite days with more than ``most_files`` files of batches, sorted by (asset, version).

    What a day has sorted before is taken in again only if it holds no more than ``AGAIN``
    times the rows that came since, so a row is rewritten a number of times that grows with
    the logarithm of its day. ``chosen`` may limit the entries further. Returns the number of
    files replaced. Files that arrive meanwhile are left for the next call.
    """
    log = Log(spark, path)
    live = chosen(entries(spark, path))
    fresh = ~F.col("rewritten")
    days = live.groupBy(DAY).agg(
        F.countDistinct(F.when(fresh, F.col("file"))).alias("files"),
        F.sum(F.when(fresh, F.col("rows")).otherwise(0)).alias("new_rows"),
        F.sum(F.when(fresh, 0).otherwise(F.col("rows"))).alias("sorted_rows"),
    )
    due = days.where(F.col("files") > most_files).select(DAY, (F.col("sorted_rows") <= AGAIN * F.col("new_rows")).alias("again"))
    taken = live.join(F.broadcast(due), DAY).where(fresh | F.col("again")).drop("again")  # a row a day
    if taken.isEmpty():
        return 0
    name = f"sorted-{uuid.uuid4().hex}"
    removals = _removals(taken, name)
    listed = spark.createDataFrame([(r["file"], r["rewritten"]) for r in removals], "file string, rewritten boolean")
    rows = read(spark, path, feed, schema, lambda _: listed)
    staging = f"{log.path}{SORTED}.staging/{name}"
    sorted_days(rows, DAY).write.partitionBy(DAY).parquet(staging)
    staged = spark.read.schema(bronze_schema(feed)).parquet(staging)
    log.prepare(name, _prepared(staged, staging, log.path + SORTED, feed, name, True) + removals)
    log.finish(name)
    log.files.delete(staging)
    return len(removals)


def recover(spark: SparkSession, path: str) -> list[str]:
    """Finish what a rewrite that died had prepared; batches of streams finish their own."""
    log = Log(spark, path)
    names = [f.rsplit("/", 1)[1].removesuffix(".json") for f in log.files.glob(f"{log.folder}/pending/sorted-*.json")]
    for name in names:
        log.finish(name)
    return names


def drop_days(spark: SparkSession, path: str, as_of: Column | datetime | None, months: int) -> int:
    """Take the files of days past their time out of the table; returns how many."""
    log = Log(spark, path)
    name = f"expired-{uuid.uuid4().hex}"
    removals = _removals(entries(spark, path).where(expired(F.col(DAY), as_of, months)), name)
    if removals:
        log.prepare(name, removals)
        log.finish(name)
    return len(removals)


def roll(spark: SparkSession, path: str) -> int:
    """Fold the commits so far into a new base; returns how many.

    Commits folded by the roll before are deleted: no reader that began since then needs
    them. Of each stream the last folded batch is kept, so that a batch which comes
    again later is still known.
    """
    log = Log(spark, path)
    base = log.base()
    known = [f.rsplit("/", 1)[1].removesuffix(".json") for f in log.files.glob(f"{log.folder}/commits/*.json")]
    fresh = [name for name in known if name not in set(base["folded"])]
    if not fresh:
        return 0
    whole = spark.read.schema(ENTRY).json([log.commit_file(n) for n in fresh])
    if base["folder"]:
        whole = spark.read.schema(ENTRY).parquet(base["folder"]).unionByName(whole)
    gone = whole.where(F.col("action") == REMOVE).select("file", "rewritten").distinct()
    added = whole.where(F.col("action") == ADD)
    # removals stay until vacuum has deleted their files
    kept = [
        (f, r) for f, r in gone.collect() if log.files.exists(f"{log.path}{SORTED if r else ''}/{f}")
    ]
    still = spark.createDataFrame(kept, "file string, rewritten boolean").withColumn("action", F.lit(REMOVE)).withColumn("commit", F.lit("base"))
    number = base["number"] + 1
    folder = f"{log.folder}/base-{number:08d}-{uuid.uuid4().hex}"
    new = added.join(gone, ["file", "rewritten"], "left_anti").unionByName(still, allowMissingColumns=True)
    new.select(*spark.createDataFrame([], ENTRY).columns).write.parquet(folder)
    marks, named = dict(base["marks"]), list(base["named"])
    for name in fresh:
        stream, _, batch = name.rpartition("-")
        if stream and batch.isdigit():
            marks[stream] = max(int(batch), marks.get(stream, -1))
        else:
            named.append(name)
    pointer = {"number": number, "folder": folder, "folded": known, "named": named, "marks": marks}
    old = log.files.glob(f"{log.folder}/base-*.json")
    log.files.write(f"{log.folder}/base-{number:08d}.json", json.dumps(pointer))
    for name in base["folded"]:
        log.files.delete(log.commit_file(name))
    for file in old[:-1]:
        earlier = json.loads(log.files.read(file))
        log.files.delete(earlier["folder"])
        log.files.delete(file)
    return len(fresh)


def seen_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Files that a stream over a folder has taken in, by its checkpoint."""
    lines = spark.read.schema("value string").text(f"{checkpoint}/sources/0")
    return lines.select(F.get_json_object("value", "$.path").alias("path")).where("path is not null").distinct()


def vacuum(spark: SparkSession, path: str, followers: Sequence[str] = ()) -> int:
    """Delete files that were removed before the last roll and that every follower has read.

    ``followers`` are the checkpoints of streams over the table's folder. One that has
    read nothing yet keeps every file. Files under ``.sorted`` are followed by none.
    """
    log = Log(spark, path)
    base = log.base()
    if not base["folder"]:
        return 0
    gone = spark.read.schema(ENTRY).parquet(base["folder"]).where(F.col("action") == REMOVE).select("file", "rewritten").distinct()
    for checkpoint in followers:
        read_by = []
        if log.files.exists(f"{checkpoint}/sources/0"):
            read_by = [seen_files(spark, checkpoint).select(F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("file")).withColumn("rewritten", F.lit(False))]
        followed = gone.where("not rewritten")
        followed = followed.join(read_by[0], ["file", "rewritten"], "left_semi") if read_by else followed.limit(0)
        gone = gone.where("rewritten").unionByName(followed)
    names = [f"{log.path}{SORTED if r else ''}/{f}" for f, r in gone.collect()]
    return sum(log.files.delete(name) for name in names)


def audit(
    spark: SparkSession, path: str, feed: Feed, schema, as_of: Column | datetime | None = None, days: int | None = None
) -> DataFrame:
    """Files of which the log and the table disagree: ``lost``, ``changed`` or ``unlogged``. Reads all rows of the days."""
    log = Log(spark, path)
    since = F.date_sub(F.to_date(as_instant(as_of)), days) if days is not None else None
    recent = lambda e: e if since is None else e.where(F.col(DAY) >= since)
    measures = ["rows", "min_lsn", "max_lsn", "newest_ms", "checksum"]
    live = recent(entries(spark, path)).select("file", "rewritten", DAY, HOUR, F.struct(*measures).alias("logged"))
    parts = []
    for root, rewritten in ((log.path, False), (log.path + SORTED, True)):
        if log.files.exists(root):
            rows = recent(_as_bronze(spark.read.schema(bronze_schema(feed) if rewritten else schema).parquet(root)))
            inner = F.regexp_extract("written", rf"((?:{DAY}=[^/]*/)(?:hour=[^/]*/)?[^/]+)$", 1)
            found = _summaries(rows, feed).select(inner.alias("file"), F.lit(rewritten).alias("rewritten"), DAY, HOUR, F.struct(*measures).alias("held"))
            parts.append(found)
    held = parts[0] if parts else live.select("file", "rewritten", DAY, HOUR, F.col("logged").alias("held")).limit(0)
    for part in parts[1:]:
        held = held.unionByName(part)
    base = log.base()
    waiting = spark.createDataFrame([], "file string, rewritten boolean")
    if base["folder"]:
        waiting = spark.read.schema(ENTRY).parquet(base["folder"]).where(F.col("action") == REMOVE).select("file", "rewritten")
    if log.files.exists(f"{log.folder}/commits"):
        waiting = waiting.unionByName(spark.read.schema(ENTRY).json(f"{log.folder}/commits").where(F.col("action") == REMOVE).select("file", "rewritten"))
    both = live.join(held, ["file", "rewritten", DAY, HOUR], "full").join(waiting.distinct(), ["file", "rewritten"], "left_anti")
    problem = (
        F.when(F.col("held").isNull(), "lost").when(F.col("logged").isNull(), "unlogged").when(F.col("held") != F.col("logged"), "changed")
    )
    return both.select("file", "rewritten", DAY, HOUR, problem.alias("problem")).where("problem is not null")
