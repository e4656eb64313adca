"""Compare a declared set of subjects with the set in use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def subject_set_check(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str] = ("subject", "field"), kind: str = "type"
) -> DataFrame:
    """One row per key with ``status`` same, changed, missing or extra.

    A missing or changed entry is a failure; an extra one is only reported.
    """
    left = expected.select(*keys, F.col(kind).alias("expected_type"), F.lit(True).alias("_declared")).distinct()
    right = actual.select(*keys, F.col(kind).alias("actual_type"), F.lit(True).alias("_used")).distinct()
    status = (
        F.when(F.col("_used").isNull(), "missing")
        .when(F.col("_declared").isNull(), "extra")
        .when(F.col("expected_type").eqNullSafe(F.col("actual_type")), "same")
        .otherwise("changed")
    )
    joined = left.join(right, list(keys), "full").withColumn("status", status)
    return joined.select(
        *keys, "expected_type", "actual_type", "status", F.col("status").isin("missing", "changed").alias("failed")
    )


def table_fields(df: DataFrame, subject: str) -> DataFrame:
    """The (subject, field, type) set of a DataFrame's schema."""
    rows = [(subject, f.name, f.dataType.simpleString()) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "subject string, field string, type string")
