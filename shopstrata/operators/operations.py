"""Pipeline health metrics over the ledger, check results, dead letters and watermarks."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact_ratio, minutes_between, wall

RECENT = timedelta(hours=24)
SHOP_KEYS = ["table_name", "shop_id", "platform"]
#: Width of the first histogram when an order statistic is looked up.
BUCKET = 4096


def _recent(df: DataFrame, column: str, now: datetime) -> DataFrame:
    return df.where(F.col(column) >= wall(now - RECENT))


def current_batches(events: DataFrame) -> DataFrame:
    """State of each batch: its last ledger event."""
    last = [c for c in events.columns if c not in ("batch_id", "event_seq", "started_at")]
    return (
        events.groupBy("batch_id", "table_name", "shop_id", "platform")
        .agg(
            F.min("started_at").alias("started_at"),
            *[
                F.max_by(c, "event_seq").alias(c)
                for c in last
                if c not in ("table_name", "shop_id", "platform")
            ],
        )
    )


def latest_events(events: DataFrame) -> DataFrame:
    """One event per batch with its current state; reads like all of them together."""
    last = F.max("event_seq").alias("event_seq")
    seq = events.groupBy("batch_id", "table_name", "shop_id", "platform").agg(last)
    current = current_batches(events)
    same = [current[c].eqNullSafe(seq[c]) for c in ("batch_id", "table_name", "shop_id", "platform")]
    return current.join(seq, reduce(lambda a, b: a & b, same)).select(*[current[c] for c in current.columns], seq["event_seq"])


def latest_success(batches: DataFrame) -> DataFrame:
    """Latest successful batch with a window, per table, shop and platform; of any split of the batches, and of its own results."""
    done = batches.where("status = 'success' AND window_end IS NOT NULL") if "status" in batches.columns else batches
    latest = F.max(F.struct("started_at", "window_end"))
    return done.groupBy(*SHOP_KEYS).agg(latest.alias("_latest")).select(*SHOP_KEYS, "_latest.*")


def success_rate(batches: DataFrame, now: datetime) -> DataFrame:
    """Share of successful batches per table in the last 24 hours."""
    return (
        _recent(batches, "started_at", now)
        .groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("batches"), F.count_if(F.col("status") == "success").alias("successes"))
        .withColumn("success_rate", exact_ratio(F.col("successes"), F.col("batches")))
    )


def batch_delay(batches: DataFrame, now: datetime) -> DataFrame:
    """Minutes since the window end of the latest successful batch per table, shop and platform."""
    return delay_of(latest_success(batches), now)


def delay_of(latest: DataFrame, now: datetime) -> DataFrame:
    return latest.select(*SHOP_KEYS, minutes_between(F.col("window_end"), wall(now)).alias("delay_minutes"))


def ranked_value(df: DataFrame, group: str, value: str, percent: int) -> DataFrame:
    """Largest ``value`` per group whose percent rank is at most ``percent`` / 100.

    That is the element at position ``floor(percent/100 * (n - 1))`` of the sorted group.
    It is found exactly without sorting a group in one task: values are counted, the counts
    are summed into buckets of ``BUCKET`` values, and only the bucket that holds the
    position is looked at value by value.  A window partition is at most one row per
    bucket, then at most ``BUCKET`` rows.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_bucket", F.floor(F.col(value) / BUCKET))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        counts.groupBy(group, "_bucket")
        .agg(F.sum("_n").alias("_in_bucket"))
        .withColumn("_before", F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)))
        .withColumn("_total", F.sum("_in_bucket").over(Window.partitionBy(group)))
        .withColumn("_position", F.floor((F.col("_total") - 1) * percent / 100))
        .where("_before <= _position AND _position < _before + _in_bucket")
        .select(group, "_bucket", "_before", "_position")
    )
    within = Window.partitionBy(group).orderBy(value)
    return (
        counts.join(buckets, [group, "_bucket"])
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(within))
        .where("_position < _upto")
        .groupBy(group)
        .agg(F.min(value).alias(value))
    )


def duration_p95(task_runs: DataFrame, now: datetime) -> DataFrame:
    """95th percentile of task durations per flow in the last 24 hours."""
    recent = _recent(task_runs, "started_at", now)
    return ranked_value(recent, "dag_id", "duration_ms", 95).withColumnRenamed("duration_ms", "p95_ms")


def check_failures(results: DataFrame, now: datetime) -> DataFrame:
    """Failed data checks in the last 24 hours."""
    return _recent(results, "evaluated_at", now).where("passed = 0").agg(F.count(F.lit(1)).alias("dq_failures"))


def load_errors(errors: DataFrame, batches: DataFrame, now: datetime) -> DataFrame:
    """Dead letters of batches that started in the last 24 hours.

    Errors are counted per batch first: one broken batch may hold most of them.
    """
    per_batch = errors.groupBy("batch_id").agg(F.count(F.lit(1)).alias("_n"))
    recent = _recent(batches, "started_at", now).select("batch_id")
    return per_batch.join(recent, "batch_id", "left_semi").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("load_errors"))


def watermark_age(state: DataFrame, now: datetime) -> DataFrame:
    """Minutes since the watermark per table, shop and platform."""
    rows = state.where("watermark_type = 'updated_at'") if "watermark_type" in state.columns else state
    return rows.select(*SHOP_KEYS, minutes_between(F.col("watermark_value"), wall(now)).alias("age_minutes"))
