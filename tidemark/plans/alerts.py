"""The four alert rules, evaluated each minute over report and metric history."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import alert_hold, counter_increase
from tidemark.plans.activity import GROUP_PATTERN, consumer_lag
from tidemark.session import stage

# Fixed value: the dead-letter topics.
DLQ_PATTERN = r"bronze\..*\.dlq"


@dataclass(frozen=True)
class Rule:
    uid: str
    threshold: float
    hold_minutes: int


# Thresholds and hold times.
STALE = Rule("pipeline-lag-stale", 30, 5)
MISMATCH = Rule("sink-validation-mismatch", 0, 10)
DEAD_LETTERS = Rule("dlq-records", 0, 0)
CONSUMER_LAG = Rule("consumer-lag", 1000, 10)


def evaluations(series: DataFrame, rule: Rule, value: str, ts: str = "ts") -> DataFrame:
    """A measured series in the shape the hold rule reads."""
    return series.select(
        F.col(ts).alias("ts"),
        F.lit(rule.uid).alias("rule_uid"),
        F.col(value).cast("double").alias("value"),
        F.lit(float(rule.threshold)).alias("threshold"),
        F.lit(rule.hold_minutes).alias("hold_minutes"),
    )


def rule_evaluations(
    health_history: DataFrame | None = None,
    validation_history: DataFrame | None = None,
    topic_offsets: DataFrame | None = None,
    consumer_offsets: DataFrame | None = None,
    dead_letters: DataFrame | None = None,
    dlq_pattern: str = DLQ_PATTERN,
    group_pattern: str = GROUP_PATTERN,
) -> DataFrame:
    """One evaluation per rule and check time, for the histories given.

    ``topic_offsets`` holds the counters of the dead-letter topics, ``dead_letters`` their
    increase where a job has it already.
    """
    parts = []
    if health_history is not None:
        lag = health_history.groupBy("checked_at").agg(F.max("minutes_lag").alias("v"))
        parts.append(evaluations(lag, STALE, "v", "checked_at"))
    if validation_history is not None:
        failed = validation_history.groupBy("checked_at").agg(
            F.count_if(F.col("validation_status") != "HEALTHY").alias("v")
        )
        parts.append(evaluations(failed, MISMATCH, "v", "checked_at"))
    if topic_offsets is not None:
        parts.append(evaluations(counter_increase(topic_offsets, dlq_pattern, 10), DEAD_LETTERS, "increase"))
    if dead_letters is not None:
        parts.append(evaluations(dead_letters, DEAD_LETTERS, "increase"))
    if consumer_offsets is not None:
        parts.append(evaluations(consumer_lag(consumer_offsets, group_pattern), CONSUMER_LAG, "lag"))
    return reduce(DataFrame.unionByName, parts)


def alerts(**histories: DataFrame) -> DataFrame:
    """State of every rule at every evaluation.

    The evaluations are staged: measuring them is the costly part, and the hold
    rule reads them more than once.
    """
    return alert_hold(stage(rule_evaluations(**histories), "evaluations"))
