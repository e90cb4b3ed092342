"""One run of the order ingest for all shops at once.

read window -> drop repeats -> map -> contract -> rate gate -> orders and items -> checks ->
watermarks.  Shops are independent: a shop over its dead-letter limit, or blocked by a
check, does not move its watermark and does not hold up the others.  State is written last,
so a run that breaks anywhere is simply run again.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import wall
from ..functions.joins import join_lookup
from ..operators import alerts, feed, quality, windows
from ..operators.deadletters import MAPPER_ERROR, stamp
from ..operators.windows import FULL, INCREMENTAL, TimeWindow
from ..sources import landing
from ..sources.tables import Staged, Warehouse
from . import state
from .parallel import in_parallel
from .upsert import MergeCounts, upsert

STREAM = "stream"
SHOP = ["shop_id", "platform"]


@dataclass(frozen=True)
class IngestSettings:
    overlap: timedelta = windows.OVERLAP
    delay: timedelta = windows.DELAY
    history_start: datetime = windows.HISTORY_START
    dead_letter_limit: float = 0.01
    run_checks: bool = True
    alerts_enabled: bool = True
    alert_level: str = alerts.DEFAULT_LEVEL


@dataclass(frozen=True)
class IngestResult:
    batch_id: str
    run_type: str
    rows_read: int = 0
    dead_letters: int = 0
    orders: MergeCounts = field(default_factory=MergeCounts)
    items: MergeCounts = field(default_factory=MergeCounts)
    shops_over_limit: int = 0
    shops_blocked: int = 0
    watermarks_moved: int = 0


STRAY = "messages without a shop exceed the dead-letter limit"


class IngestFailed(RuntimeError):
    """Some shops were not accepted; ``result`` tells what happened to the others."""

    def __init__(self, message: str, result: IngestResult) -> None:
        super().__init__(message)
        self.result = result


class DeadLetterLimitExceeded(IngestFailed):
    pass


class DataBlocked(IngestFailed):
    pass


@dataclass(frozen=True)
class _Spans:
    """Windows of a run: the same for all shops, per shop, or none (a stream)."""

    run_type: str
    window: TimeWindow | None
    per_shop: DataFrame | None = None

    @classmethod
    def of(
        cls, wh: Warehouse, run_type: str, window: TimeWindow | None, now: datetime, settings: IngestSettings
    ) -> _Spans:
        if window is not None or run_type == STREAM:
            return cls(run_type, window)
        everything = windows.extract_window(
            None, now, overlap=settings.overlap, delay=settings.delay, history_start=settings.history_start
        )
        marks = state.watermarks(wh, feed.ORDERS_TABLE)
        if run_type == FULL or marks.isEmpty():
            return cls(run_type, everything)
        per_shop = windows.compute_windows(
            marks, now, overlap=settings.overlap, delay=settings.delay, history_start=settings.history_start
        )
        return cls(run_type, everything, per_shop.select(*SHOP, F.col("window_start").alias("_start")))

    def messages(self, keyed: DataFrame) -> DataFrame:
        """Messages of each shop's window; a stream takes what it gets."""
        if self.window is None:
            return keyed
        start, end = wall(self.window.start), wall(self.window.end)
        if self.per_shop is None:
            return keyed.where(feed.in_window(start, end))
        spanned = join_lookup(keyed, self.per_shop, SHOP, "value", "left")
        return spanned.where(feed.in_window(F.coalesce("_start", start), end)).drop("_start")

    def shops(self, report: DataFrame) -> DataFrame:
        """Adds the window to the rows of the batch report."""
        if self.window is None:
            return report.withColumns(
                {"window_start": F.col("oldest"), "window_end": F.col("newest") + F.make_dt_interval(secs=F.lit(0.001))}
            )
        start, end = wall(self.window.start), wall(self.window.end)
        if self.per_shop is None:
            return report.withColumns({"window_start": start, "window_end": end})
        joined = report.join(self.per_shop, SHOP, "left")
        return joined.withColumns({"window_start": F.coalesce("_start", start), "window_end": end}).drop("_start")


def batch_report(staged: DataFrame, limit: float) -> DataFrame:
    """Per shop: messages read, orders accepted, dead letters, gate, and the span of times.

    Messages that belong to no shop are measured against everything that was read.
    """
    rates = feed.dead_letter_rates(staged, limit)
    time = F.col("order_row.updated_at")
    accepted = staged.groupBy(*SHOP).agg(
        F.count("order_row").alias("rows_written"), F.min(time).alias("oldest"), F.max(time).alias("newest")
    )
    keep = [F.col("a.rows_written"), F.col("a.oldest"), F.col("a.newest")]
    same = F.col("r.shop_id").eqNullSafe(F.col("a.shop_id")) & F.col("r.platform").eqNullSafe(F.col("a.platform"))
    return rates.alias("r").join(accepted.alias("a"), same).select("r.*", *keep)


def _gate(report: DataFrame, limit: float) -> tuple[DataFrame, bool]:
    """Shops over the limit, and whether messages without a shop exceed it overall."""
    over = report.where("over_limit = 1 AND shop_id IS NOT NULL").select(*SHOP)
    sums = report.agg(
        F.sum(F.when(F.col("shop_id").isNull(), F.col("dead_letters"))).alias("stray"), F.sum("rows_read").alias("rows")
    ).first()
    stray = limit > 0 and bool(sums.rows) and (sums.stray or 0) / sums.rows > limit
    return over, stray


def ingest_batch(
    wh: Warehouse,
    messages: DataFrame,
    *,
    now: datetime,
    run_type: str = INCREMENTAL,
    window: TimeWindow | None = None,
    settings: IngestSettings = IngestSettings(),
    batch_id: str | None = None,
    shops: DataFrame | None = None,
) -> IngestResult:
    """Ingest feed ``messages`` (``platform, source_shop_id, value``).

    ``run_type``: ``incremental`` reads from the watermark and advances it; ``full`` ignores
    it, ``backfill`` takes ``window``, neither advances; ``stream`` takes every message and
    advances to the newest one.  ``shops`` (shop_id, platform) may name shops whose watermark
    advances even when they sent nothing.
    """
    run = _Run(wh, batch_id or state.new_batch_id(), run_type, now, settings)
    try:
        return run.execute(messages, window, shops)
    except IngestFailed:
        raise
    except Exception as problem:
        run.broken(problem)
        raise
    finally:
        run.clean_up()


def ingest_directory(
    wh: Warehouse,
    path: str,
    *,
    now: datetime,
    platform: str | None = None,
    settings: IngestSettings = IngestSettings(),
    shops: DataFrame | None = None,
) -> IngestResult:
    """An incremental run over a landing directory that reads only files which may hold something for it.

    Every file is recorded with the times of its messages when it is read first.  Later runs leave out
    those whose newest message lies before all windows, whatever the directory looks like; files that
    changed are read as new.  A message without a readable time counts in the run that reads its file
    first.
    """
    batch = state.new_batch_id()
    since = state.oldest_needed(wh, feed.ORDERS_TABLE, settings.overlap)
    listing = wh.stage(landing.list_files(wh.spark, path), "files")
    chosen = wh.stage(
        feed.files_to_read(listing.df, state.feed_files(wh), None if since is None else wall(since)), "chosen"
    )
    known = {r.path: r.known for r in chosen.df.collect()}  # names of the files to read, which a scan needs anyway
    messages = landing.scan_files(wh.spark, path, sorted(known), platform=platform)
    marked = messages.join(
        F.broadcast(chosen.df.withColumnRenamed("path", feed.SOURCE_FILE)) if len(known) <= MOST_FILES_SENT
        else chosen.df.withColumnRenamed("path", feed.SOURCE_FILE), feed.SOURCE_FILE,
    )
    new = listing.df.join(chosen.df.where(~F.col("known")), "path", "left_semi")
    times = feed.file_times(marked.where(~F.col(feed.KNOWN)))
    try:
        result = ingest_batch(wh, marked, now=now, settings=settings, batch_id=batch, shops=shops)
    except IngestFailed:
        state.record_files(wh, new, times, batch, now)  # shops that were held up read them again by their watermark
        raise
    state.record_files(wh, new, times, batch, now)
    for staged in (listing, chosen):
        staged.drop()
    return result


#: Names of files sent to all tasks; more are joined by a shuffle.
MOST_FILES_SENT = 100_000


class _Run:
    """One batch: the staged results and what is written in which order."""

    def __init__(self, wh: Warehouse, batch: str, run_type: str, now: datetime, settings: IngestSettings) -> None:
        self.wh, self.batch, self.run_type, self.now, self.settings = wh, batch, run_type, now, settings
        self._staged: list[Staged] = []
        self._event = {"batch_id": batch, "table_name": feed.ORDERS_TABLE, "run_type": run_type, "started_at": now}

    def _stage(self, df: DataFrame, label: str) -> DataFrame:
        self._staged.append(self.wh.stage(df, label))
        return self._staged[-1].df

    def clean_up(self) -> None:
        for staged in self._staged:
            staged.drop()
        state.tidy_logs(self.wh)

    def broken(self, problem: Exception) -> None:
        state.record_batches(
            self.wh, state.nobody(self.wh), status=state.FAILED, ended_at=self.now,
            error_msg=str(problem)[:2000], **self._event,
        )
        self._alert(state.alert_row(self.wh, f"ingest failed: {feed.ORDERS_TABLE}", str(problem), "error"))

    def _alert(self, rows: DataFrame) -> None:
        state.record_alerts(
            self.wh, rows, self.batch, self.now, min_level=self.settings.alert_level, enabled=self.settings.alerts_enabled
        )

    def execute(self, messages: DataFrame, window: TimeWindow | None, shops: DataFrame | None) -> IngestResult:
        wh, settings = self.wh, self.settings
        spans = _Spans.of(wh, self.run_type, window, self.now, settings)
        newest = feed.newest_messages(self._unseen(spans.messages(feed.message_keys(messages))))
        staged = self._stage(feed.mark_messages(feed.map_messages(newest, self.batch)), "feed")
        report = self._stage(spans.shops(batch_report(staged, settings.dead_letter_limit)), "report")
        named = report.where("shop_id IS NOT NULL")
        letters = stamp(feed.letters_of(staged), self.batch, wall(self.now))
        _, _, (over, stray), totals = in_parallel(
            lambda: state.record_batches(wh, named, status=state.RUNNING, **self._event),
            # a micro-batch that is replayed has the same id, and its letters count once
            lambda: wh.append(state.ERRORS, letters, once=f"letters-{self.batch}" if self.run_type == STREAM else None),
            lambda: _gate(report, settings.dead_letter_limit),
            lambda: report.agg(F.sum("rows_read").alias("rows"), F.sum("dead_letters").alias("dead")).first(),
        )
        result = IngestResult(self.batch, self.run_type, totals.rows or 0, totals.dead or 0)
        if stray:
            self._alert(state.alert_row(wh, f"unreadable messages: {feed.ORDERS_TABLE}", STRAY, "error"))
        n_over = over.count()
        # a refused window is read again by the next run; a stream's file is not, so there the good
        # messages of a shop over the limit are stored and the gate only holds its watermark
        keep_all = n_over == 0 or self.run_type == STREAM
        passed = staged if keep_all else join_lookup(staged, over, SHOP, ["order_row", "letters"], "left_anti")
        orders, items = in_parallel(
            lambda: upsert(
                wh, feed.ORDERS_TABLE, feed.accepted_orders(passed), moves=lambda days: state.record_moves(wh, days, self.now)
            ),
            lambda: upsert(wh, feed.ITEMS_TABLE, feed.accepted_items(passed)),
        )

        healthy = named if n_over == 0 else named.join(over, SHOP, "left_anti")
        blocked = self._check(healthy)
        n_blocked = 0 if blocked is None else blocked.count()
        moved = self._advance(healthy, blocked, shops, spans)
        self._finish(named, {"over": over, "blocked": blocked})
        result = replace(
            result, orders=orders, items=items, shops_over_limit=n_over, shops_blocked=n_blocked, watermarks_moved=moved
        )
        if n_over:
            raise DeadLetterLimitExceeded(f"{n_over} shops exceed the dead-letter limit", result)
        if n_blocked:
            raise DataBlocked(f"{n_blocked} shops are blocked by data checks", result)
        if stray:
            raise DeadLetterLimitExceeded(STRAY, result)
        return result

    def _unseen(self, keyed: DataFrame) -> DataFrame:
        """Without messages that lack a readable time and were set aside by an earlier run: they
        belong to every window and would count against their shop for good."""
        if feed.KNOWN in keyed.columns:  # the ledger of files says which were read before
            return keyed.where(F.col("message_time").isNotNull() | ~F.col(feed.KNOWN))
        seen = self.wh.read_log(state.ERRORS).where(F.col("error_type") == MAPPER_ERROR)
        known = seen.select(F.xxhash64("platform", "raw_row").alias("_text")).distinct()
        if self.run_type == STREAM or known.isEmpty():
            return keyed
        untimed = keyed.withColumn("_text", F.when(F.col("message_time").isNull(), F.xxhash64("platform", "value")))
        return join_lookup(untimed, known, ["_text"], "value", "left_anti").drop("_text")

    def _check(self, batch: DataFrame) -> DataFrame | None:
        """Run the registered checks; returns the shops they block, None when nothing ran."""
        wh = self.wh
        rules = state.enabled_rules(wh, (feed.ORDERS_TABLE, feed.ITEMS_TABLE)) if self.settings.run_checks else []
        if not rules:
            return None
        bounds = batch.agg(F.min("window_start").alias("first"), F.max("window_end").alias("last")).first()
        tables = {name: wh.read(name) for name in (feed.ORDERS_TABLE, feed.ITEMS_TABLE)}
        verdicts = self._stage(
            quality.run_checks(
                tables, rules, now=self.now, windows=batch, ledger=state.ledger(wh),
                batch_rows=batch, run_type=self.run_type, bounds=(bounds.first, bounds.last) if bounds.first else None,
            ),
            "verdicts",
        )
        state.record_verdicts(wh, verdicts, self.batch, self.now)
        self._alert(alerts.check_alerts(verdicts))
        failed = verdicts.where("passed = 0 AND severity = 'block'")
        if not failed.where("shop_id IS NULL").isEmpty():
            return batch.select(*SHOP)  # a check of a whole table holds for every shop
        return failed.select(*SHOP).distinct()

    def _advance(
        self, healthy: DataFrame, blocked: DataFrame | None, shops: DataFrame | None, spans: _Spans
    ) -> int:
        if self.run_type not in (INCREMENTAL, STREAM):
            return 0
        mark = F.col("newest") if self.run_type == STREAM else F.col("window_end")
        reached = healthy.select(*SHOP, mark.alias("watermark_value"))
        if shops is not None and spans.window is not None:
            silent = shops.select(*SHOP).join(healthy.select(*SHOP), SHOP, "left_anti")
            reached = reached.unionByName(silent.withColumn("watermark_value", wall(spans.window.end)))
        if blocked is not None:
            reached = reached.join(blocked, SHOP, "left_anti")
        return state.advance(self.wh, reached.withColumn("table_name", F.lit(feed.ORDERS_TABLE)), self.now)

    def _finish(self, report: DataFrame, held: dict[str, DataFrame | None]) -> None:
        """Final ledger event of every shop, and one alert per shop that was held up."""
        reasons = {"over": "dead-letter limit exceeded", "blocked": "blocked by data checks"}
        marked = report.select(*SHOP, "rows_read", "rows_written", "window_start", "window_end")
        why = F.lit(None).cast("string")
        for kind, rows in held.items():
            if rows is not None:
                flag = rows.select(*SHOP).distinct().withColumn(f"_{kind}", F.lit(True))
                marked = marked.join(flag, SHOP, "left")
                why = F.coalesce(why, F.when(F.col(f"_{kind}"), F.lit(reasons[kind])))
        finished = self._stage(
            marked.withColumn("error_msg", why)
            .withColumn("status", F.when(why.isNull(), state.SUCCESS).otherwise(state.FAILED))
            .withColumn(
                "rows_written",
                F.when((why == reasons["over"]) & F.lit(self.run_type != STREAM), 0).otherwise(F.col("rows_written")),
            ),
            "finished",
        )
        state.record_batches(self.wh, finished, status=state.SUCCESS, ended_at=self.now, **self._event)
        self._alert(
            finished.where("status = 'failed'").select(
                F.concat(
                    F.lit("["), "platform", F.lit("/shop="), F.col("shop_id").cast("string"),
                    F.lit(f"] ingest failed: {feed.ORDERS_TABLE}"),
                ).alias("title"),
                F.col("error_msg").alias("text"), F.lit("error").alias("level"),
            )
        )
