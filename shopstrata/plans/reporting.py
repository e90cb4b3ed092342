"""Read-only jobs over stored tables: pipeline metrics and chart queries."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import charts, operations
from ..sources.tables import Warehouse
from . import state

LABELS = {"table_name": "string", "shop_id": "bigint", "platform": "string", "dag_id": "string"}


def pipeline_metrics(wh: Warehouse, now: datetime) -> DataFrame:
    """All health metrics as rows ``metric, table_name, shop_id, platform, dag_id, value``."""
    since = (now - operations.RECENT).date()  # no metric of the last day lists an older period
    batches = state.ledger(wh, since)
    letters = wh.read_log(state.ERRORS, since=since).dropDuplicates(["batch_id", "error_key"])
    metrics = {
        "etl_batch_success_rate": (operations.success_rate(batches, now), "success_rate"),
        "etl_batch_delay_minutes": (operations.delay_of(state.latest_successes(wh), now), "delay_minutes"),
        "etl_task_duration_ms_p95": (operations.duration_p95(wh.read_log(state.TASKS, since=since), now), "p95_ms"),
        "etl_dq_failures_total": (operations.check_failures(wh.read_log(state.RESULTS, since=since), now), "dq_failures"),
        "etl_load_errors_total": (operations.load_errors(letters, batches, now), "load_errors"),
        "etl_watermark_age_minutes": (operations.watermark_age(wh.read(state.WATERMARKS), now), "age_minutes"),
    }
    rows = [
        df.select(
            F.lit(name).alias("metric"),
            *[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in LABELS.items()],
            F.col(value).cast("double").alias("value"),
        )
        for name, (df, value) in metrics.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def chart(wh: Warehouse, name: str) -> DataFrame:
    """A dashboard chart over the stored report tables."""
    if name not in charts.CHARTS:
        raise ValueError(f"unknown chart {name!r}, expected one of {sorted(charts.CHARTS)}")
    table, build = charts.CHARTS[name]
    return build(wh.read(table))
