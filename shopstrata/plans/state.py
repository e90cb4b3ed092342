"""Reading and writing the operational tables: ledger, watermarks, rules, alerts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clip, wall
from ..operators import alerts, merge, operations, quality, windows
from ..schemas import TABLES
from ..sources.config_files import rules_frame
from ..sources.tables import Warehouse

WATERMARKS, BATCHES, TASKS = "etl_meta.etl_watermark", "etl_meta.etl_batch", "etl_meta.etl_task_run"
ERRORS, DEFS, RESULTS, ALERTS = (
    "etl_meta.etl_load_error", "etl_meta.dq_check_def", "etl_meta.dq_check_result", "etl_meta.alert",
)
MOVES, FILES = "etl_meta.moved_day", "etl_meta.etl_feed_file"
RUNNING, SUCCESS, FAILED = "running", "success", "failed"


def new_batch_id() -> str:
    return uuid.uuid4().hex


# ---- ledger ------------------------------------------------------------------------------


def ledger(wh: Warehouse, since: date | None = None) -> DataFrame:
    """Current state of every batch; ``since`` leaves out periods before that day."""
    return operations.current_batches(wh.read_log(BATCHES, since=since))


def latest_successes(wh: Warehouse) -> DataFrame:
    """Latest successful batch of each table, shop and platform: what the ledger's last merge found, and what came since."""
    found, tail = wh.read_summary(BATCHES)
    fresh = operations.latest_success(operations.current_batches(tail))
    return fresh if found is None else operations.latest_success(found.unionByName(fresh))


#: Appends after which a log is put together.
LOOSE_APPENDS = 64


def tidy_logs(wh: Warehouse, most: int = LOOSE_APPENDS) -> list[str]:
    """Put logs of more than ``most`` loose appends together; the ledger keeps one row of each batch and its summary."""
    tidied = []
    for name in (BATCHES, TASKS, ERRORS, RESULTS, ALERTS, FILES):
        if len(wh.entries(name).appends) > most:
            of_batches = name == BATCHES
            done = wh.merge_log(
                name, operations.latest_events if of_batches else None,
                (lambda rows: operations.latest_success(operations.current_batches(rows))) if of_batches else None,
            )
            tidied += [name] if done else []
    return tidied


# ---- files of the feed -------------------------------------------------------------------


def feed_files(wh: Warehouse) -> DataFrame:
    """The files that were read, as they were when they were read last."""
    return merge.latest_by_key(wh.read_log(FILES), ["path"], ts="read_at")


def record_files(wh: Warehouse, listing: DataFrame, times: DataFrame, batch_id: str, now: datetime) -> None:
    """Append what a run found in files that were new to it; an empty file has no times."""
    found = times.withColumnRenamed("source_file", "path")
    rows = listing.join(found, "path", "left").fillna(0, ["messages"])
    wh.append(FILES, rows.select("*", F.lit(batch_id).alias("batch_id"), wall(now).alias("read_at")), once=f"files-{batch_id}")


def record_batches(
    wh: Warehouse, shops: DataFrame, *, batch_id: str, table_name: str, run_type: str, status: str,
    started_at: datetime, ended_at: datetime | None = None, error_msg: str | None = None,
) -> None:
    """Append one event per row of ``shops`` (shop, platform and what is known of the batch).

    ``shops`` may carry ``window_start, window_end, rows_read, rows_written, status`` and
    ``error_msg`` of its own; what it lacks is filled from the arguments.
    """
    known = set(shops.columns)
    defaults: dict[str, Any] = {
        "window_start": F.lit(None), "window_end": F.lit(None), "rows_read": F.lit(0), "rows_written": F.lit(0),
        "status": F.lit(status), "error_msg": F.lit(error_msg),
    }
    events = shops.select(
        F.lit(batch_id).alias("batch_id"), F.lit(table_name).alias("table_name"), "shop_id", "platform",
        F.lit(run_type).alias("run_type"),
        *[(F.col(c) if c in known else d).alias(c) for c, d in defaults.items()],
        wall(started_at).alias("started_at"),
        (F.lit(None) if ended_at is None else wall(ended_at)).alias("ended_at"),
        F.lit(0 if status == RUNNING else 1).alias("event_seq"),
    )
    wh.append(BATCHES, events.withColumn("error_msg", clip(F.col("error_msg").cast("string"))))


def nobody(wh: Warehouse) -> DataFrame:
    """A single row for events that belong to no shop."""
    return wh.spark.range(1).select(F.lit(0).cast("bigint").alias("shop_id"), F.lit("").alias("platform"))


def record_task_run(
    wh: Warehouse, *, dag_id: str, task_id: str, status: str, started_at: datetime, ended_at: datetime,
    interval: tuple[datetime | None, datetime | None] = (None, None), error: str | None = None,
) -> str:
    run_id = new_batch_id()
    millis = int((ended_at - started_at).total_seconds() * 1000)
    row = (run_id, dag_id, task_id, *interval, status, error, millis, started_at, ended_at)
    wh.append(TASKS, wh.spark.createDataFrame([row], TABLES[TASKS].schema))
    return run_id


def run_task(
    wh: Warehouse, dag_id: str, task_id: str, work: Callable[[], Any], *, clock: Callable[[], datetime] = datetime.now,
    interval: tuple[datetime | None, datetime | None] = (None, None),
) -> Any:
    """Run ``work`` and record the outcome as a task run; an error is recorded and raised again."""
    started = clock()
    try:
        result = work()
    except Exception as problem:
        record_task_run(
            wh, dag_id=dag_id, task_id=task_id, status=FAILED, started_at=started, ended_at=clock(),
            interval=interval, error=str(problem)[:2000],
        )
        raise
    record_task_run(
        wh, dag_id=dag_id, task_id=task_id, status=SUCCESS, started_at=started, ended_at=clock(), interval=interval
    )
    return result


# ---- watermarks --------------------------------------------------------------------------


def watermarks(wh: Warehouse, table_name: str) -> DataFrame:
    return wh.read(WATERMARKS).where(F.col("table_name") == table_name)


def oldest_needed(wh: Warehouse, table_name: str, overlap: timedelta) -> datetime | None:
    """Where the earliest window of a scheduled run starts.

    None without watermarks, and as long as a shop that sent messages has none: its whole history
    is still to be read.
    """
    marks, shop = watermarks(wh, table_name), ["shop_id", "platform"]
    seen = ledger(wh).where((F.col("table_name") == table_name) & F.col("shop_id").isNotNull()).select(*shop).distinct()
    if not seen.join(marks, shop, "left_anti").isEmpty():
        return None
    oldest = marks.agg(F.min("watermark_value")).first()[0]
    return oldest - overlap if oldest is not None else None


def advance(wh: Warehouse, reached: DataFrame, now: datetime) -> int:
    """Move watermarks forward; returns how many moved."""
    return wh.retried(lambda: _advance_once(wh, reached, now))


def _advance_once(wh: Warehouse, reached: DataFrame, now: datetime) -> int:
    at = wh.version(WATERMARKS)
    state = wh.read_at(WATERMARKS, at)
    after = wh.stage(windows.advance_watermarks(state, reached), "watermarks")
    moved = after.df.where("moved = 1").count()
    if moved:
        old = state.select(*windows.STATE_KEYS, F.col("updated_at").alias("_before"), "watermark_type")
        rows = after.df.join(old, windows.STATE_KEYS, "left").select(
            *windows.STATE_KEYS, "watermark_value",
            F.coalesce("watermark_type", F.lit("updated_at")).alias("watermark_type"),
            F.when(F.col("moved") == 1, wall(now)).otherwise(F.col("_before")).alias("updated_at"),
        )
        wh.replace(WATERMARKS, rows, at=at)
    after.drop()
    return moved


# ---- moved days --------------------------------------------------------------------------


def record_moves(wh: Warehouse, days: DataFrame, now: datetime) -> None:
    """Remember days (shop, platform, day) whose summaries a merge has made wrong."""
    stamped = wh.stage(days.withColumn("recorded_at", wall(now)), "moves")
    if not stamped.df.isEmpty():
        def add() -> None:
            at = wh.version(MOVES)
            wh.replace(MOVES, merge.merge_replace(wh.read_at(MOVES, at), stamped.df, TABLES[MOVES].key), at=at)

        wh.retried(add)
    stamped.drop()


def settle_moves(wh: Warehouse, done: DataFrame) -> None:
    """Forget days that were built anew, unless they were recorded again meanwhile."""
    def remove() -> None:
        at = wh.version(MOVES)
        known = wh.read_at(MOVES, at)
        wh.replace(MOVES, known.join(done, TABLES[MOVES].columns, "left_anti").select(*known.columns), at=at)

    wh.retried(remove)


# ---- rules -------------------------------------------------------------------------------


def sync_rules(wh: Warehouse, rules: Sequence[quality.Rule], now: datetime) -> dict[str, int]:
    """Register configured rules that are not known yet; existing ones are never touched."""
    return wh.retried(lambda: _sync_rules_once(wh, rules, now))


def _sync_rules_once(wh: Warehouse, rules: Sequence[quality.Rule], now: datetime) -> dict[str, int]:
    at = wh.version(DEFS)
    defs = wh.read_at(DEFS, at)
    specs = rules_frame(wh.spark, list(rules))
    fresh = [r.asDict() for r in quality.sync_rules(defs, specs).collect()]  # configuration: tens of rows
    if fresh:
        top = defs.agg(F.max("check_id")).first()[0] or 0
        order = sorted(fresh, key=lambda r: (r["table_name"], r["rule_type"], r["params"]))
        rows = [
            (top + n, r["table_name"], r["rule_type"], r["params"], r["severity"], 1, now)
            for n, r in enumerate(order, start=1)
        ]
        wh.replace(DEFS, defs.unionByName(wh.spark.createDataFrame(rows, TABLES[DEFS].schema)), at=at)
    return {"inserted": len(fresh), "skipped": len(rules) - len(fresh)}


def enabled_rules(wh: Warehouse, table_names: Sequence[str]) -> list[quality.Rule]:
    """The registered, enabled rules of some tables (configuration: tens of rows)."""
    rows = wh.read(DEFS).where(F.col("table_name").isin(*table_names) & (F.col("enabled") == 1)).collect()
    return [
        quality.Rule(r.table_name, r.rule_type, json.loads(r.params), r.severity, r.check_id)
        for r in sorted(rows, key=lambda r: r.check_id)
    ]


def record_verdicts(wh: Warehouse, verdicts: DataFrame, batch_id: str, now: datetime) -> None:
    wh.append(
        RESULTS,
        verdicts.select(
            "check_id", F.lit(batch_id).alias("batch_id"), "shop_id", "platform", F.lit(now.date()).alias("stat_date"),
            "actual_value", "expected_value", "passed", "detail", wall(now).alias("evaluated_at"),
        ),
    )


# ---- alerts ------------------------------------------------------------------------------


def record_alerts(wh: Warehouse, rows: DataFrame, batch_id: str, now: datetime, *, min_level: str, enabled: bool) -> None:
    kept = alerts.keep_alerts(rows, min_level=min_level, enabled=enabled)
    wh.append(ALERTS, kept.select(F.lit(batch_id).alias("batch_id"), "title", "text", "level", wall(now).alias("created_at")))


def alert_row(wh: Warehouse, title: str, text: str, level: str) -> DataFrame:
    return wh.spark.range(1).select(
        F.lit(title).alias("title"), clip(F.lit(text)).alias("text"), F.lit(level).alias("level")
    )
