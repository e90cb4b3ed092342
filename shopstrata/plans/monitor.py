"""Scheduled data-quality scan of the raw tables over the last hours."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import wall
from ..operators import alerts, quality, windows
from ..sources.config_files import registry_frame
from ..sources.tables import Warehouse
from . import state

MONITORED = ("dw.ods_orders", "dw.ods_order_items")


@dataclass(frozen=True)
class ScanResult:
    batch_id: str
    checks: int
    warned: int
    blocked: int


class ScanBlocked(RuntimeError):
    def __init__(self, result: ScanResult) -> None:
        super().__init__(f"{result.blocked} blocking data checks failed")
        self.result = result


def scan_quality(
    wh: Warehouse,
    shops: Sequence[Mapping[str, Any]],
    *,
    now: datetime,
    hours: int = 24,
    tables: Sequence[str] = MONITORED,
    alert_level: str = alerts.DEFAULT_LEVEL,
    alerts_enabled: bool = True,
) -> ScanResult:
    """Evaluate all registered rules of ``tables`` for every shop; blocking failures raise."""
    batch = state.new_batch_id()
    start = now - timedelta(hours=hours)
    spans = registry_frame(wh.spark, list(shops)).select(
        "shop_id", "platform", wall(start).alias("window_start"), wall(now).alias("window_end")
    )
    rules = state.enabled_rules(wh, tables)
    if not rules:
        return ScanResult(batch, 0, 0, 0)
    # a reference rule may point at any stored table, not only at the scanned ones
    parents = {str(r.params["parent_table"]) for r in rules if r.params.get("parent_table") in wh.names()}
    frames = {name: wh.read(name) for name in {*tables, *parents}}
    counted = [
        windows.window_row_counts(frames[name], spans)
        .withColumnRenamed("rows_in_window", "rows_read")
        .withColumn("table_name", F.lit(name))
        for name in tables
    ]
    verdicts = wh.stage(
        quality.run_checks(
            frames, rules, now=now, windows=spans, ledger=state.ledger(wh),
            batch_rows=reduce(DataFrame.unionByName, counted),
            run_type="monitor", bounds=(start, now),
        ),
        "scan",
    )
    state.record_verdicts(wh, verdicts.df, batch, now)
    state.record_alerts(
        wh, alerts.check_alerts(verdicts.df), batch, now, min_level=alert_level, enabled=alerts_enabled
    )
    failed = {r.severity: r["count"] for r in verdicts.df.where("passed = 0").groupBy("severity").count().collect()}
    result = ScanResult(batch, verdicts.df.count(), failed.get("warn", 0), failed.get("block", 0))
    verdicts.drop()
    if result.blocked:
        raise ScanBlocked(result)
    return result


def row_counts(wh: Warehouse, names: Sequence[str]):
    """Row counts of stored tables, e.g. before and after a restore."""
    from ..operators.compare import table_row_counts

    return table_row_counts({n: wh.read(n) for n in names}).select("table_name", F.col("row_cnt"))
