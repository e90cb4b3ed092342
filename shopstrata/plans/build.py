"""The warehouse build: detail facts, dimensions, daily summaries and reports.

One pass over all registered shops.  Detail tables are merged, summaries and reports are
overwritten for the window, so the same window can be built again at any time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime, time, timedelta
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import business_date
from ..functions.joins import join_lookup
from ..functions.status import StatusMap
from ..operators import alerts, daily, dimensions, facts, merge, reports
from ..schemas import TABLES
from ..sources.config_files import registry_frame
from ..sources.tables import DAY, Staged, Warehouse
from . import state
from .parallel import in_parallel
from .upsert import MergeCounts, upsert

SHOP = ["shop_id", "platform"]
FOREVER = date(9999, 12, 31)
CALENDAR_MARGIN = (365, 366)


@dataclass(frozen=True)
class BuildSummary:
    batch_id: str
    since: date
    end: date
    shop_versions_added: int = 0
    orders: MergeCounts = field(default_factory=MergeCounts)
    items: MergeCounts = field(default_factory=MergeCounts)
    days_rebuilt: int = 0


def periods(wh: Warehouse, since: date, end: date) -> set[str]:
    """All partition periods of the closed date range."""
    return {wh.period(since + timedelta(days=n)) for n in range((end - since).days + 1)}


def _overwrite(
    wh: Warehouse, name: str, fresh: DataFrame, since: date, end: date, scope: DataFrame, within: Iterable[str] | None = None
) -> None:
    """Replace the window of a dated table for the shops, platforms or days in ``scope``.

    ``within`` names the periods that ``fresh`` may have rows in where the window has no end.
    """
    wh.retried(lambda: _overwrite_once(wh, name, fresh, since, end, scope, within))


def _overwrite_once(
    wh: Warehouse, name: str, fresh: DataFrame, since: date, end: date, scope: DataFrame, within: Iterable[str] | None
) -> None:
    at = wh.version(name)
    upto = [p for p in sorted(at.parts) if wh.period(since) <= p <= wh.period(end)]
    span = set(upto) | (periods(wh, since, end) if within is None else {p for p in within if p >= wh.period(since)})
    if not span:
        return
    stored = wh.read_parts(name, span, at)
    rows = merge.overwrite_window(stored, fresh.select(*stored.columns), "stat_date", since, end, scope=scope)
    wh.replace(name, rows, sorted(span), at=at)


def _rates(df: DataFrame, name: str) -> dict[str, T.DataType]:
    fields = TABLES[name].schema.fields
    return {f.name: f.dataType for f in fields if isinstance(f.dataType, T.DecimalType) and f.name in df.columns}


def _fitted(df: DataFrame, name: str) -> DataFrame:
    """A rate or percentage that its stored column cannot hold becomes NULL; the rest of the report stands."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in _rates(df, name).items()})


def _misfits(df: DataFrame, name: str) -> DataFrame:
    """An alert for every row with such a value."""
    lost = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string")))
        for c, t in _rates(df, name).items()
    ]
    who = [F.col(c).cast("string") for c in ("stat_date", "platform", "shop_id") if c in df.columns]
    found = df.select(F.concat_ws(" ", *who).alias("who"), F.concat_ws(", ", *lost).alias("what")).where("what <> ''")
    return found.select(
        F.concat(F.lit(f"value out of range: {name} "), "who").alias("title"), F.col("what").alias("text"),
        F.lit("error").alias("level"),
    )


def refresh_calendar(wh: Warehouse, since: date, end: date, holidays: Mapping[date, str] | None = None) -> None:
    before, after = CALENDAR_MARGIN
    bounds = wh.spark.range(1).select(
        F.lit(since - timedelta(days=before)).alias("first_day"), F.lit(end + timedelta(days=after)).alias("last_day")
    )
    fresh = dimensions.calendar(bounds, holidays)

    def refresh() -> None:
        at = wh.version("dw.dim_date")
        stored = wh.read_at("dw.dim_date", at)
        rows = merge.refresh_columns(stored, fresh, "date_key", dimensions.REFRESHED_DATE_COLUMNS)
        wh.replace("dw.dim_date", rows, at=at)

    wh.retried(refresh)


def sync_shops(wh: Warehouse, registry: DataFrame, effective: date) -> int:
    """Bring the shop dimension in line with the registry; returns the versions opened."""
    return wh.retried(lambda: _sync_shops_once(wh, registry, effective))


def _sync_shops_once(wh: Warehouse, registry: DataFrame, effective: date) -> int:
    at = wh.version("dw.dim_shop")
    versions = wh.read_at("dw.dim_shop", at)
    changes = wh.stage(dimensions.shop_changes(registry, versions, effective), "shops")
    opened = changes.df.where("change = 'open'").count()
    if not changes.df.isEmpty():
        wh.replace("dw.dim_shop", dimensions.apply_shop_changes(versions, changes.df), at=at)
    changes.drop()
    return opened


def build_warehouse(
    wh: Warehouse,
    shops: Sequence[Mapping[str, Any]],
    *,
    since: date,
    now: datetime,
    status_map: StatusMap | None = None,
    holidays: Mapping[date, str] | None = None,
    batch_id: str | None = None,
    alert_level: str = alerts.DEFAULT_LEVEL,
    alerts_enabled: bool = True,
) -> BuildSummary:
    """Build the days ``[since, now]`` of all registered ``shops``."""
    end = now.date()
    if since > end:
        raise ValueError(f"the window starts at {since}, after its end {end}")
    batch = batch_id or state.new_batch_id()
    registry = registry_frame(wh.spark, list(shops))
    window = {
        "window_start": F.lit(datetime.combine(since, time.min).isoformat(" ")).cast("timestamp_ntz"),
        "window_end": F.lit(datetime.combine(end, time.min).isoformat(" ")).cast("timestamp_ntz"),
    }
    event = {"batch_id": batch, "table_name": "dw.build", "run_type": "transform", "started_at": now}
    platforms = registry.select(F.lit(0).cast("bigint").alias("shop_id"), "platform").distinct()
    kpi_event = {**event, "table_name": "dw.build_kpi"}
    shops_of = registry.select(*SHOP).withColumns(window)
    try:
        state.record_batches(wh, shops_of, status=state.RUNNING, **event)
        def alert(rows: DataFrame) -> None:
            state.record_alerts(wh, rows, batch, now, min_level=alert_level, enabled=alerts_enabled)

        moved = wh.stage(wh.read(state.MOVES).join(registry.select(*SHOP), SHOP, "left_semi"), "moved")
        summary, counts = _build(wh, registry, since, end, now, batch, status_map, holidays, alert)
        outside = moved.df.where(~F.col("stat_date").between(F.lit(since), F.lit(end)))
        rebuilt = rebuild_days(wh, outside.select(*SHOP, "stat_date"), batch, status_map, alert)
        if not moved.df.isEmpty():
            state.settle_moves(wh, moved.df)
        kpi = wh.read("dw.ads_daily_kpi", since=since).where(F.col("stat_date") >= F.lit(since))
        kpi_rows = kpi.groupBy("platform").agg(F.count(F.lit(1)).alias("rows_written"))
        by_platform = platforms.join(kpi_rows, "platform", "left").fillna(0, ["rows_written"])
        by_platform = by_platform.withColumns({**window, "rows_read": F.lit(0)})
        in_parallel(
            lambda: state.record_batches(wh, counts.df.withColumns(window), status=state.SUCCESS, ended_at=now, **event),
            lambda: state.record_batches(wh, by_platform, status=state.SUCCESS, ended_at=now, **kpi_event),
        )
        for staged in (moved, counts):
            staged.drop()
    except Exception as problem:
        state.record_batches(
            wh, shops_of, status=state.FAILED, ended_at=now, error_msg=str(problem)[:2000], **event
        )
        state.record_alerts(
            wh, state.alert_row(wh, "warehouse build failed", f"[{since}, {end}]: {problem}", "error"), batch, now,
            min_level=alert_level, enabled=alerts_enabled,
        )
        raise
    return replace(summary, days_rebuilt=rebuilt)


def _build(
    wh: Warehouse, registry: DataFrame, since: date, end: date, now: datetime, batch: str,
    status_map: StatusMap | None, holidays: Mapping[date, str] | None, alert: Callable[[DataFrame], None],
) -> tuple[BuildSummary, Staged]:
    """Details and summaries side by side, then the reports over them."""
    keys = registry.select(*SHOP)
    day_before = since - timedelta(days=1)
    orders = join_lookup(
        facts.business_window(wh.read("dw.ods_orders", since=since, end=end), since, end), keys, SHOP, "order_id", "left_semi"
    )
    # every step below starts from these rows, so the window is read and joined once
    staged = wh.stage(facts.dwd_orders(orders, batch, status_map), "dwd")
    dwd = staged.df
    whole = set(wh.parts("dw.ods_orders")) <= {p for p in wh.parts("dw.ods_orders") if p >= wh.period(since)}

    def product_dimension() -> None:
        refresh_sightings(wh)
        seen = wh.read("dw.dim_product_sighting").join(keys, SHOP, "left_semi")
        products = dimensions.product_dimension_of(seen, now)
        keyed = products.withColumn("product_key", F.xxhash64("shop_id", "product_id"))

        def write() -> None:
            at = wh.version("dw.dim_product")
            stored = wh.read_at("dw.dim_product", at)
            wh.replace("dw.dim_product", merge.merge_replace(stored, keyed, ["shop_id", "product_id"]), at=at)

        wh.retried(write)

    def window_items() -> tuple[Staged, MergeCounts]:
        items = wh.stage(facts.dwd_items(order_items(wh, dwd, everything=whole), batch), "items")
        merged, _ = in_parallel(
            lambda: upsert(wh, "dw.dwd_order_items", items.df, replace_equal=True),
            lambda: _overwrite(wh, "dw.dws_product_daily", daily.product_daily(dwd, items.df), since, end, keys),
        )
        return items, merged

    _, opened, order_counts, (items, item_counts), *_ = in_parallel(
        lambda: refresh_calendar(wh, since, end, holidays),
        lambda: sync_shops(wh, registry, end),
        lambda: upsert(wh, "dw.dwd_orders", dwd, replace_equal=True),
        window_items,
        product_dimension,
        lambda: _overwrite(wh, "dw.dws_shop_daily", daily.shop_daily(dwd), since, end, keys),
    )
    read = (
        dwd.select(*SHOP, F.lit(1).alias("_order"))
        .unionByName(items.df.select(*SHOP, F.lit(0).alias("_order")))
        .groupBy(*SHOP)
        .agg(F.count(F.lit(1)).alias("rows_read"), F.sum("_order").alias("rows_written"))
    )
    counted = keys.join(read, SHOP, "left").fillna(0, ["rows_read", "rows_written"])

    shop_days = wh.read("dw.dws_shop_daily", since=day_before)
    overview = reports.shop_overview(
        shop_days.join(keys, SHOP, "left_semi"), wh.read("dw.dws_product_daily", since=since),
        wh.read("dw.dim_product"), since=since,
    )
    platforms = keys.select("platform").distinct()
    kpi = reports.daily_kpi(shop_days.join(platforms, ["platform"], "left_semi"), since=since)
    days = wh.parts("dw.dws_shop_daily")  # a report has no day that the summary has not
    counts, *_ = in_parallel(
        lambda: wh.stage(counted, "counts"),
        lambda: _overwrite(wh, "dw.ads_shop_overview", _fitted(overview, "dw.ads_shop_overview"), since, FOREVER, keys, days),
        lambda: _overwrite(wh, "dw.ads_daily_kpi", _fitted(kpi, "dw.ads_daily_kpi"), since, FOREVER, platforms, days),
        lambda: alert(_misfits(overview, "dw.ads_shop_overview").unionByName(_misfits(kpi, "dw.ads_daily_kpi"))),
    )
    for done in (staged, items):
        done.drop()
    return BuildSummary(batch, since, end, opened, order_counts, item_counts), counts


def order_items(wh: Warehouse, orders: DataFrame, *, everything: bool = False) -> DataFrame:
    """Stored items of ``orders``, read from the periods alone that hold any of them.

    An item is filed by its own update time, so the index of the items says where those of an order
    are.  Only the buckets of these orders are read, unless ``everything`` says that all periods matter.
    """
    name = "dw.ods_order_items"
    keys = ["shop_id", "order_id"]
    order_keys = orders.select(*keys)
    if everything:
        items = wh.read(name)
    else:
        at = wh.with_index(name)
        bucket = wh.bucket(TABLES[name], at.index.buckets)
        buckets = [r[0] for r in order_keys.select(bucket).distinct().collect()]
        places = wh.read_index(name, at, buckets).select(*keys, wh.period_column(F.col(DAY)).alias("part"))
        held = join_lookup(places, order_keys, keys, "order_id", "left_semi", salts=1).select("part").distinct()
        items = wh.read_parts(name, [r.part for r in held.collect()], at)
    return join_lookup(items, order_keys, keys, "item_id", "left_semi", salts=1)


def refresh_sightings(wh: Warehouse) -> list[str]:
    """Product sightings of the item periods that changed since they were made; the others are not read."""
    name, source = "dw.dim_product_sighting", "dw.ods_order_items"

    def refresh() -> list[str]:
        at, items = wh.version(name), wh.version(source)
        made = {p: x.made_from for p, x in at.parts.items()}
        stale = [p for p, x in items.parts.items() if made.get(p) != x.content]
        gone = [p for p in made if p not in items.parts]
        if stale or gone:
            rows = wh.read_parts(source, stale, items).withColumn("period", wh.part_column(TABLES[source]))
            fresh = dimensions.product_sightings(rows, "platform", "period")
            wh.replace(name, fresh, sorted({*stale, *gone}), at=at, made_from={p: items.parts[p].content for p in stale})
        return sorted(stale)

    return wh.retried(refresh)


def rebuild_days(
    wh: Warehouse, pairs: DataFrame, batch: str, status_map: StatusMap | None, alert: Callable[[DataFrame], None]
) -> int:
    """Build single days (``shop_id, platform, stat_date``) again; returns how many.

    These are days that an order has left or reached by a change of its date, wherever they lie. Reports
    of the day after compare with them and are made again as well.
    """
    known = wh.stage(pairs.distinct(), "days")
    days = [r.stat_date for r in known.df.select("stat_date").distinct().collect()]  # at most the days of the history
    if not days:
        known.drop()
        return 0
    scope = [*SHOP, "stat_date"]
    first, last = min(days), max(days)
    stored = wh.read_parts("dw.ods_orders", {wh.period(d) for d in days})
    dated = facts.business_window(stored, first, last).withColumn("stat_date", business_date(F.col("created_at"), F.col("updated_at")))
    orders = join_lookup(dated, known.df, scope, "order_id", "left_semi").drop("stat_date")
    dwd = facts.dwd_orders(orders, batch, status_map)
    items = wh.stage(facts.dwd_items(order_items(wh, orders), batch), "items")
    in_parallel(
        lambda: upsert(wh, "dw.dwd_orders", dwd, replace_equal=True),
        lambda: upsert(wh, "dw.dwd_order_items", items.df, replace_equal=True),
        lambda: _overwrite(wh, "dw.dws_shop_daily", daily.shop_daily(dwd), first, last, known.df),
        lambda: _overwrite(wh, "dw.dws_product_daily", daily.product_daily(dwd, items.df), first, last, known.df),
    )
    items.drop()
    shops = known.df.select(*SHOP).distinct()
    shop_days = wh.read("dw.dws_shop_daily", since=first - timedelta(days=1)).join(shops, SHOP, "left_semi")
    platforms = known.df.select("platform").distinct()
    platform_days = wh.read("dw.dws_shop_daily", since=first - timedelta(days=1)).join(platforms, ["platform"], "left_semi")
    overview = reports.shop_overview(
        shop_days, wh.read("dw.dws_product_daily", since=first), wh.read("dw.dim_product"), since=first
    )
    kpi = reports.daily_kpi(platform_days, since=first)
    touched = wh.stage(reports.with_next_day(known.df, shop_days, SHOP), "touched")
    touched_kpi = wh.stage(reports.with_next_day(known.df.select("platform", "stat_date").distinct(), platform_days, ["platform"]), "kpi")
    overview = overview.join(touched.df, scope, "left_semi")
    kpi = kpi.join(touched_kpi.df, ["platform", "stat_date"], "left_semi")
    within = wh.parts("dw.dws_shop_daily")
    in_parallel(
        lambda: _overwrite(wh, "dw.ads_shop_overview", _fitted(overview, "dw.ads_shop_overview"), first, FOREVER, touched.df, within),
        lambda: _overwrite(wh, "dw.ads_daily_kpi", _fitted(kpi, "dw.ads_daily_kpi"), first, FOREVER, touched_kpi.df, within),
        lambda: alert(_misfits(overview, "dw.ads_shop_overview").unionByName(_misfits(kpi, "dw.ads_daily_kpi"))),
    )
    n = known.df.count()
    for staged in (known, touched, touched_kpi):
        staged.drop()
    return n
