"""Totals, ranks and shares over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import stage

def global_total(df: DataFrame, totals: dict[str, str], over: DataFrame | None = None) -> DataFrame:
    """Attach whole-table double sums: ``totals`` maps output name to column.

    The same as ``sum(x) over ()``, but only the one-row total is moved. Pass as
    ``over`` the table ``df`` was made from, when that is cheaper to add up.
    """
    one_row = (df if over is None else over).agg(*[F.sum(F.col(c).cast("double")).alias(name) for name, c in totals.items()])
    return df.crossJoin(F.broadcast(one_row))


def market_cap_rank(df: DataFrame, by: str = "market_cap", out: str = "market_cap_rank") -> DataFrame:
    """``rank() over (order by <by> desc nulls last)`` for a table of any size.

    ``df`` should be staged (cheap to read twice). It is ranked over its distinct
    values: these are range-partitioned and staged with their range number, each
    range adds up its own counts, and the counts of higher ranges (one row per
    range) are added.
    """
    ranges = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("_n"))
    ranged = stage(
        counts.repartitionByRange(ranges, F.desc(by)).withColumn("_range", F.spark_partition_id()),
        "rank-ranges",
    )
    per_range = ranged.groupBy("_range").agg(F.sum("_n").alias("_rows"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_range.select(
        "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_above")
    )
    higher = W.partitionBy("_range").orderBy(F.desc(by)).rowsBetween(W.unboundedPreceding, -1)
    ranks = (
        ranged.withColumn("_higher", F.coalesce(F.sum("_n").over(higher), F.lit(0)))
        .join(F.broadcast(offsets), "_range")  # at most one row per range
        .select(by, (F.col("_above") + F.col("_higher") + 1).alias("_rank"))
    )
    known = ranged.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_known"))
    return (
        df.join(ranks, by, "left")
        .crossJoin(F.broadcast(known))
        .withColumn(out, F.coalesce("_rank", F.col("_known") + 1).cast("bigint"))
        .select(*df.columns, out)
    )


def share_of_total(df: DataFrame, part: str, whole: str, out: str) -> DataFrame:
    """part / whole as doubles; null where the whole is zero."""
    return df.withColumn(out, F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")))


def top_k_assets(
    df: DataFrame, k: int = 10, by: str = "market_cap", ties: Sequence[str] = ("asset_id",)
) -> DataFrame:
    """The page of k assets with the highest value; each task keeps only k rows."""
    return df.orderBy(F.desc_nulls_last(by), *[F.asc(t) for t in ties]).limit(k)
