"""Batch scans of the landing zone and of bronze."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import as_instant, local_date
from tidemark.operators.layout import file_inventory
from tidemark import tables
from tidemark.schemas import Feed, bronze_schema, landing_schema

# Fixed value: days that reconciliation looks back.
CHECK_DAYS = 7


def landing_path(base: str, feed: Feed) -> str:
    return f"{base}/{feed.name}"


def lz_scan(spark: SparkSession, base: str, feed: Feed) -> DataFrame:
    """Landing files of a feed, with the directory's date and hour as columns.

    Those that the table's log counts; all in the folder, if it has no log.
    """
    path = landing_path(base, feed)
    if tables.Log(spark, path).exists():
        return tables.read(spark, path, feed, landing_schema(feed))
    files = spark.read.schema(landing_schema(feed)).parquet(path)
    return files.withColumnRenamed("hour", "ingestion_hour").select(*feed.bronze_columns)


def trailing_days(rows: DataFrame, as_of: Column | datetime | None, days: int | None) -> DataFrame:
    """Rows ingested in the last ``days`` local days; prunes day partitions."""
    if days is None:
        return rows
    return rows.filter(F.col("ingestion_date") >= F.date_sub(local_date(as_instant(as_of)), days))


def bronze_scan(
    spark: SparkSession, path: str, feed: Feed, as_of: Column | datetime | None = None, days: int | None = None
) -> DataFrame:
    """The bronze table, optionally only its trailing days: the files that its log counts, or all if it has none."""
    if tables.Log(spark, path).exists():
        recent = lambda rows: trailing_days(rows, as_of, days)
        return recent(tables.read(spark, path, feed, bronze_schema(feed), recent))
    rows = spark.read.schema(bronze_schema(feed)).parquet(path).select(*feed.bronze_columns)
    return trailing_days(rows, as_of, days)


def lz_file_inventory(spark: SparkSession, base: str, feed: Feed) -> DataFrame:
    """Objects and bytes per ingestion day and hour, from a listing of the files."""
    found = file_inventory(spark, landing_path(base, feed), ["ingestion_date", "hour"])
    return found.withColumn("ingestion_date", F.col("ingestion_date").cast("date"))
