"""How bronze is kept on storage: layout, retention, file inventory."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import as_instant, local_date
from tidemark.session import Files

# Fixed value: months that bronze is kept.
KEEP_MONTHS = 12


def sorted_days(rows: DataFrame, partition: str = "ingestion_date", sort: Sequence[str] = ("assetId", "lsn")) -> DataFrame:
    """Rows dealt out and sorted by (day, asset, version), so a hot day or asset is split over files."""
    return rows.repartitionByRange(partition, *sort).sortWithinPartitions(partition, *sort)


def bronze_layout(
    rows: DataFrame,
    path: str,
    partition: str = "ingestion_date",
    sort: Sequence[str] = ("assetId", "lsn"),
    mode: str = "overwrite",
) -> None:
    """Write rows partitioned by day and sorted by (asset, version).

    The range shuffle splits on day, asset and version together, so a day or an
    asset that holds much of the data is spread over many files, and each file
    covers a narrow key range that Parquet's statistics can skip.
    """
    (
        sorted_days(rows, partition, sort)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def expired(day: Column, as_of: Column | datetime | None, months: int = KEEP_MONTHS) -> Column:
    """True once ``months`` have passed since that day."""
    return F.add_months(day, months) <= local_date(as_instant(as_of))


def retention(
    rows: DataFrame, as_of: Column | datetime | None, day: str = "ingestion_date", months: int = KEEP_MONTHS
) -> DataFrame:
    """Rows still kept. On a partition column this prunes whole partitions."""
    return rows.filter(~expired(F.col(day), as_of, months))


def expired_partitions(
    rows: DataFrame, as_of: Column | datetime | None, day: str = "ingestion_date", months: int = KEEP_MONTHS
) -> DataFrame:
    """The partitions that retention drops, with their row counts."""
    return rows.filter(expired(F.col(day), as_of, months)).groupBy(day).agg(F.count("*").alias("rows"))


def drop_expired(
    spark: SparkSession | DataFrame, path: str, as_of: Column | datetime | None, day: str = "ingestion_date", months: int = KEEP_MONTHS
) -> list[str]:
    """Delete the expired day directories under ``path`` and return them.

    Directories are listed, and no row is read: only their names reach the driver.
    A table may stand for its session.
    """
    spark = spark.sparkSession if isinstance(spark, DataFrame) else spark
    files = Files(spark)
    listed = [(name.rsplit("=", 1)[1],) for name in files.glob(f"{path}/{day}=*")]
    days = spark.createDataFrame(listed, "day string")
    past = days.filter(expired(F.try_to_date("day"), as_of, months)).collect()
    names = sorted(f"{path}/{day}={r.day}" for r in past)
    for name in names:
        files.delete(name)
    return names


def file_inventory(spark: SparkSession, path: str, by: Sequence[str] = (), pattern: str = "*.parquet") -> DataFrame:
    """Object count and total bytes of the files under a folder, by directory values.

    Spark lists the files; nothing in them is read, so empty ones count too.
    ``by`` names the ``name=value`` directories to group by; values are text.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    values = [F.nullif(F.regexp_extract("path", rf"/{name}=([^/]*)/", 1), F.lit("")).alias(name) for name in by]
    return files.select(*values, "length").groupBy(*by).agg(F.count("*").alias("objects"), F.sum("length").alias("bytes"))
