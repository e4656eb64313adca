"""Counters and alert conditions over long time series.

A series may hold a large part of all samples, so no window here spans a whole
series. Rows are windowed within (series, chunk of time); what happened before
the chunk comes from one summary row per (series, chunk). After the first step
a series has at most one row per timestamp, which bounds a chunk's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import stage

HOUR = 3600
DAY = 24 * HOUR


def _seconds(ts: str | Column) -> Column:
    return F.unix_seconds(ts)


def whole(pattern: str) -> str:
    """A pattern that must match the whole label."""
    return rf"^(?:{pattern})\z"


def chunked(df: DataFrame, ts: str, seconds: int) -> DataFrame:
    """Add ``_chunk``, the number of the time chunk a row falls into."""
    return df.withColumn("_chunk", F.floor(_seconds(ts) / F.lit(seconds)).cast("bigint"))


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: str, values: dict[str, Column], inclusive: bool = False
) -> DataFrame:
    """Add, per output name, the last non-null value before (or at) each row.

    The same as ``last(value, ignorenulls) over (partition by keys order by
    order rows unbounded preceding)``, for rows that ``chunked`` has numbered.
    Chained calls share the shuffle on (keys, chunk).
    """
    group = [*keys, "_chunk"]
    chunked_rows = df.withColumns({f"_in_{name}": value for name, value in values.items()})
    summary = chunked_rows.groupBy(*group).agg(
        *[
            F.max_by(F.col(f"_in_{name}"), F.when(F.col(f"_in_{name}").isNotNull(), F.col(order))).alias(f"_end_{name}")
            for name in values
        ]
    )
    earlier = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = summary.select(
        *group, *[F.last(f"_end_{name}", True).over(earlier).alias(f"_prior_{name}") for name in values]
    )
    local = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    seen = {f"_seen_{name}": F.last(f"_in_{name}", True).over(local) for name in values}
    return (
        chunked_rows.withColumns(seen)
        .join(carried, group, "left")
        .select(*df.columns, *[F.coalesce(f"_seen_{name}", f"_prior_{name}").alias(name) for name in values])
    )


def running_total(df: DataFrame, keys: Sequence[str], order: str, values: dict[str, Column]) -> DataFrame:
    """Add, per output name, the sum of a column up to and with each row of its series.

    For rows that ``chunked`` has numbered: sums run within (series, chunk), and one
    row per chunk brings what came before it.
    """
    group = [*keys, "_chunk"]
    ends = df.groupBy(*group).agg(*[F.sum(v).alias(f"_end_{name}") for name, v in values.items()])
    earlier = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    prior = ends.select(*group, *[F.coalesce(F.sum(f"_end_{n}").over(earlier), F.lit(0)).alias(f"_prior_{n}") for n in values])
    local = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    sums = {f"_sum_{name}": F.coalesce(F.sum(v).over(local), F.lit(0)) for name, v in values.items()}
    joined = df.withColumns(sums).join(prior, group)
    return joined.select(*df.columns, *[(F.col(f"_sum_{n}") + F.col(f"_prior_{n}")).alias(n) for n in values])


def counter_delta(
    samples: DataFrame,
    keys: Sequence[str] = ("topic", "partition"),
    ts: str = "ts",
    value: str = "current_offset",
    chunk_seconds: int = HOUR,
) -> DataFrame:
    """Growth since the previous sample of the series, as ``delta``.

    A counter that fell was reset, so its growth is its new value. The first
    sample of a series has no growth. One sample per series and time is kept, and
    staged, since the chunks and their summaries both read it.
    """
    unique = stage(samples.groupBy(*keys, ts).agg(F.max(value).alias(value)), "samples")
    return _deltas(unique, keys, ts, value, chunk_seconds)


def _deltas(unique: DataFrame, keys: Sequence[str], ts: str, value: str, chunk_seconds: int) -> DataFrame:
    """``counter_delta`` of samples that are staged, one per series and time."""
    before = carry_forward(chunked(unique, ts, chunk_seconds), keys, ts, {"_before": F.col(value)})
    now, was = F.col(value), F.col("_before")
    delta = F.when(was.isNull(), F.lit(0)).when(now < was, now).otherwise(now - was)
    return before.select(*keys, ts, value, delta.alias("delta"))


def counter_increase(
    samples: DataFrame,
    topic_pattern: str,
    window_minutes: int = 10,
    by: Sequence[str] = (),
    ts: str = "ts",
) -> DataFrame:
    """Total growth over the trailing window, at each minute with samples in it.

    ``topic_pattern`` must match the whole topic. Growth is added up per minute
    first; each minute then counts toward the ``window_minutes`` evaluations it
    is within, so no window function is needed. An evaluation at minute m covers
    samples in (m - window, m].
    """
    chosen = samples.filter(F.col("topic").rlike(whole(topic_pattern)))
    keys, value = ("topic", "partition"), "current_offset"
    chosen = stage(chosen.groupBy(*keys, ts).agg(F.max(value).alias(value)), "samples")
    minute = F.ceil(_seconds(ts) / F.lit(60)).cast("bigint")
    per_minute = (
        _deltas(chosen, keys, ts, value, HOUR)
        .groupBy(*by, minute.alias("_minute"))
        .agg(F.sum("delta").alias("delta"))
    )
    last = chosen.agg(F.max(minute).alias("_last"))
    spread = F.explode(F.sequence(F.col("_minute"), F.col("_minute") + F.lit(window_minutes - 1)))
    return (
        per_minute.select(*by, "delta", spread.alias("_eval"))
        .crossJoin(F.broadcast(last))  # one row
        .filter("_eval <= _last")
        .groupBy(*by, F.timestamp_seconds(F.col("_eval") * 60).alias(ts))
        .agg(F.sum("delta").alias("increase"))
    )


def counter_rate(
    samples: DataFrame,
    topic_pattern: str,
    bucket_seconds: int = 60,
    by: Sequence[str] = ("topic",),
    ts: str = "ts",
) -> DataFrame:
    """Events per second by topic and time bucket."""
    chosen = samples.filter(F.col("topic").rlike(whole(topic_pattern)))
    start = F.floor(_seconds(ts) / F.lit(bucket_seconds)).cast("bigint") * bucket_seconds
    return (
        counter_delta(chosen, ts=ts)
        .groupBy(*by, F.timestamp_seconds(start).alias(ts))
        .agg((F.sum("delta") / F.lit(float(bucket_seconds))).alias("per_second"))
    )


def alert_hold(
    evaluations: DataFrame,
    keys: Sequence[str] = ("rule_uid",),
    ts: str = "ts",
    value: str = "value",
    threshold: str = "threshold",
    hold_minutes: str = "hold_minutes",
    every_minutes: int = 1,
    chunk_seconds: int = DAY,
) -> DataFrame:
    """Alert state of each evaluation: ``normal``, ``pending`` or ``firing``.

    A value over its threshold must stay over it for the hold time. No data
    counts as under it, and so does an evaluation that is missing altogether.
    ``since`` is when the present run of breaches began.
    """
    breach = F.coalesce(F.col(value) > F.col(threshold), F.lit(False))
    group = [*keys, "_chunk"]
    rows = chunked(evaluations.withColumn("_breach", breach), ts, chunk_seconds)
    minute = lambda c: F.floor(_seconds(c) / F.lit(60)).cast("bigint")

    # runs as seen within a chunk, whose first row counts as a new run
    local = W.partitionBy(*group).orderBy(ts)
    previous = F.lag(ts).over(local)
    continues = F.coalesce(F.lag("_breach").over(local) & (minute(ts) - minute(previous) <= every_minutes), F.lit(False))
    rows = rows.withColumn("_start", F.when(F.col("_breach") & ~continues, F.col(ts)))
    rows = rows.withColumns(
        {
            "_run": F.last("_start", True).over(local.rowsBetween(W.unboundedPreceding, 0)),
            "_first": F.first(ts).over(local.rowsBetween(W.unboundedPreceding, 0)),
        }
    )

    # one row per chunk: does its first run continue the last one of the chunk before,
    # and if so, when did that run begin
    ends = rows.groupBy(*group).agg(
        F.min(ts).alias("_opens"),
        F.max(ts).alias("_closes"),
        F.min_by("_breach", ts).alias("_opens_over"),
        F.max_by("_breach", ts).alias("_closes_over"),
        F.max("_start").alias("_last_run"),
    )
    chunks = W.partitionBy(*keys).orderBy("_chunk")
    joined = F.coalesce(
        F.col("_opens_over")
        & F.lag("_closes_over").over(chunks)
        & (minute("_opens") - minute(F.lag("_closes").over(chunks)) <= every_minutes),
        F.lit(False),
    )
    own = F.col("_closes_over") & ~(F.col("_joined") & (F.col("_last_run") == F.col("_opens")))
    before = chunks.rowsBetween(W.unboundedPreceding, -1)
    carried = (
        ends.withColumn("_joined", joined)
        .withColumn("_own", F.when(own, F.col("_last_run")))
        .select(*group, F.when(F.col("_joined"), F.last("_own", True).over(before)).alias("_from"))
    )

    began = F.when(F.col("_run") == F.col("_first"), F.coalesce("_from", "_run")).otherwise(F.col("_run"))
    since = F.when(F.col("_breach"), began)
    held = _seconds(ts) - _seconds("since") >= F.col(hold_minutes) * 60
    state = F.when(F.col("since").isNull(), "normal").when(held, "firing").otherwise("pending")
    return (
        rows.join(carried, group, "left")
        .select(*evaluations.columns, since.alias("since"))
        .withColumn("state", state)
    )


# What carries over from the evaluations of a series so far.
HELD = "last timestamp, over boolean, began timestamp"


def continue_hold(
    evaluations: DataFrame,
    held: DataFrame,
    keys: Sequence[str] = ("rule_uid",),
    ts: str = "ts",
    every_minutes: int = 1,
    **names: str,
) -> DataFrame:
    """``alert_hold`` of new evaluations, going on from what is ``held`` of the earlier ones.

    ``held`` has one row per series: its last evaluation, whether that was over its
    threshold, and when the run of breaches it ends began. Nothing older is read.
    Evaluations at or before the last one were settled then and are left out.
    """
    known = evaluations.join(held, list(keys), "left").where(F.col("last").isNull() | (F.col(ts) > F.col("last")))
    fresh = stage(known.select(*evaluations.columns), "fresh-evaluations")
    minute = lambda c: F.floor(_seconds(c) / F.lit(60)).cast("bigint")
    follows = F.col("over") & (minute("_opens") - minute("last") <= every_minutes)
    before = (
        fresh.groupBy(*keys)
        .agg(F.min(ts).alias("_opens"))
        .join(held, list(keys))
        .select(*keys, "_opens", F.when(follows, F.col("began")).alias("_from"))
    )
    hold = names.get("hold_minutes", "hold_minutes")
    states = alert_hold(fresh, keys, ts, every_minutes=every_minutes, **names).join(before, list(keys), "left")
    # only the first run of the new evaluations can go on an earlier one
    since = F.when(F.col("since") == F.col("_opens"), F.coalesce("_from", "since")).otherwise(F.col("since"))
    over = _seconds(ts) - _seconds("since") >= F.col(hold) * 60
    state = F.when(F.col("since").isNull(), "normal").when(over, "firing").otherwise("pending")
    return states.withColumn("since", since).withColumn("state", state).drop("_opens", "_from")


def hold_so_far(states: DataFrame, held: DataFrame, keys: Sequence[str] = ("rule_uid",), ts: str = "ts") -> DataFrame:
    """What is held once these states are settled too."""
    new = states.groupBy(*keys).agg(
        F.max(ts).alias("last"),
        F.max_by(F.col("since").isNotNull(), F.col(ts)).alias("over"),
        F.max_by("since", F.col(ts)).alias("began"),
    )
    both = new.unionByName(held.select(*new.columns))
    newest = F.max_by(F.struct("last", "over", "began"), F.col("last")).alias("h")
    return both.groupBy(*keys).agg(newest).select(*keys, "h.*")
