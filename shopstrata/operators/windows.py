"""Extraction windows and the advance-only watermark."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import wall
from ..functions.joins import join_lookup
from ..functions.times import BUSINESS_ZONE

# Re-read overlap, safety delay, start of history without a watermark, days
# rebuilt by default, and the start of a full rebuild.
OVERLAP = timedelta(hours=1)
DELAY = timedelta(minutes=5)
HISTORY_START = datetime(2020, 1, 1)
REBUILD_DAYS = 3
FULL_REBUILD_START = date(2019, 1, 1)

INCREMENTAL, FULL, BACKFILL = "incremental", "full", "backfill"
STATE_KEYS = ["table_name", "shop_id", "platform"]


@dataclass(frozen=True)
class TimeWindow:
    """Half-open range of update times."""

    start: datetime
    end: datetime

    def localized(self) -> TimeWindow:
        """Zone-aware bounds become business wall-clock times, naive ones are kept."""
        return TimeWindow(to_business_time(self.start), to_business_time(self.end))


def to_business_time(t: datetime) -> datetime:
    return t if t.tzinfo is None else t.astimezone(ZoneInfo(BUSINESS_ZONE)).replace(tzinfo=None)


def extract_window(
    watermark: datetime | None,
    now: datetime,
    *,
    overlap: timedelta = OVERLAP,
    delay: timedelta = DELAY,
    history_start: datetime = HISTORY_START,
) -> TimeWindow:
    """``[watermark - overlap, now - delay)``; without a watermark from ``history_start``."""
    return TimeWindow(history_start if watermark is None else watermark - overlap, now - delay)


def resolve_run(
    run_type: str, start: datetime | None, end: datetime | None, *, overlap: timedelta = OVERLAP
) -> tuple[str, TimeWindow | None]:
    """Run type and explicit window of a scheduled run.

    Only a backfill with a start has a window of its own; an interval that is just a point
    ``t`` means ``[t - overlap, t)``.  Scheduled and manual runs are incremental.
    """
    if run_type == BACKFILL and start is not None:
        if end is None or start >= end:
            return BACKFILL, TimeWindow(start - overlap, start).localized()
        return BACKFILL, TimeWindow(start, end).localized()
    return (run_type if run_type in (FULL, BACKFILL) else INCREMENTAL), None


def resolve_build_since(run_type: str, start: datetime | None, now: datetime, *, days: int = REBUILD_DAYS) -> date:
    """First day to rebuild: the backfill date, else the last ``days`` days."""
    if run_type == BACKFILL and start is not None:
        return to_business_time(start).date()
    return to_business_time(now).date() - timedelta(days=days - 1)


def compute_windows(
    state: DataFrame,
    now: datetime,
    *,
    overlap: timedelta = OVERLAP,
    delay: timedelta = DELAY,
    history_start: datetime = HISTORY_START,
) -> DataFrame:
    """The same windows for every row of the watermark state at once."""
    return state.select(
        *STATE_KEYS,
        F.coalesce(F.col("watermark_value") - F.lit(overlap), wall(history_start)).alias("window_start"),
        wall(now - delay).alias("window_end"),
    )


def advance_watermarks(state: DataFrame, reached: DataFrame) -> DataFrame:
    """Watermarks after a run, with ``moved`` telling which ones went forward.

    A value never goes back, and an equal value does not count as a move.
    """
    tagged = state.select(*STATE_KEYS, F.col("watermark_value").alias("_old"), F.lit(None).cast("timestamp_ntz").alias("_new"))
    tagged = tagged.unionByName(
        reached.select(*STATE_KEYS, F.lit(None).cast("timestamp_ntz").alias("_old"), F.col("watermark_value").alias("_new"))
    )
    return (
        tagged.groupBy(*STATE_KEYS)
        .agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
        .select(
            *STATE_KEYS,
            F.greatest("_old", "_new").alias("watermark_value"),
            F.when(F.col("_new").isNotNull() & (F.col("_old").isNull() | (F.col("_new") > F.col("_old"))), 1)
            .otherwise(0).alias("moved"),
        )
    )


def window_row_counts(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows updated inside the window of their shop, per shop and platform."""
    spans = windows.select("shop_id", "platform", "window_start", "window_end")
    inside = (F.col("updated_at") >= F.col("window_start")) & (F.col("updated_at") < F.col("window_end"))
    counted = (
        join_lookup(rows.select("shop_id", "platform", "updated_at"), spans, ["shop_id", "platform"], "updated_at")
        .where(inside)
        .groupBy("shop_id", "platform")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return spans.join(counted, ["shop_id", "platform"], "left").select(
        "shop_id", "platform", F.coalesce("_n", F.lit(0)).alias("rows_in_window")
    )
