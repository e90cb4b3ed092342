"""Named queries: every operator applied to whole tables of the given data set."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    alerts, charts, compare, contracts, daily, dimensions, facts, feed, merge, operations, quality, reports, windows,
)
from ..sources import sample
from ..sources.sample import EVENTS_NOW, ORDERS_NOW

Query = Callable[[SparkSession, str], DataFrame]

BATCH = "b1"
EFFECTIVE = date(2001, 8, 1)
SINCE, UNTIL = date(1998, 1, 1), date(2001, 8, 1)
FEED_WINDOW = windows.TimeWindow(datetime(1996, 1, 1), datetime(2001, 7, 1))
STATUS_MAP = {"beta": {"TRADE_MYSTERY": "completed"}}
DEAD_LETTER_LIMIT = 0.01

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- scans -------------------------------------------------------------------------------


@query
def scan_update_window(spark, d):
    """Messages of the feed updated inside a half-open window, repeats included."""
    keyed = feed.message_keys(sample.feed_messages(spark, d))
    start, end = F.lit(FEED_WINDOW.start.isoformat(" ")), F.lit(FEED_WINDOW.end.isoformat(" "))
    inside = feed.in_window(start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))
    return keyed.where(inside).select("platform", "shop_id", "order_id", "message_time")


@query
def scan_business_window(spark, d):
    orders = facts.business_window(sample.ods_orders(spark, d), SINCE, UNTIL)
    return orders.select(
        "shop_id", "order_id", "order_status", "buyer_nick", "order_amount_cents", "payment_amount_cents",
        "refund_amount_cents", "is_deleted", "created_at", "updated_at",
    )


@query
def scan_new_files(spark, d):
    """Files of a feed that a run must read: new, changed, or with messages of its window."""
    listing, ledger = sample.feed_files(spark, d)
    chosen = feed.files_to_read(listing, ledger, F.lit("1999-06-01").cast("timestamp_ntz"))
    return chosen.withColumn("known", F.col("known").cast("int"))


# ---- feed --------------------------------------------------------------------------------


def _mapped(spark, d):
    keyed = feed.message_keys(sample.feed_messages(spark, d))
    return feed.map_messages(feed.newest_messages(keyed), BATCH)


def _marked(spark, d):
    return feed.mark_messages(_mapped(spark, d))


def _without_text(df: DataFrame) -> DataFrame:
    return df.drop("raw_json", "etl_batch_id")


@query
def yuan_to_cents(spark, d):
    return sample.cents_of_texts(spark, d)


@query
def map_orders(spark, d):
    return _without_text(feed.mapped_orders(_mapped(spark, d)))


@query
def explode_items(spark, d):
    return _without_text(feed.mapped_items(_mapped(spark, d)))


@query
def accepted_orders(spark, d):
    return _without_text(feed.accepted_orders(_marked(spark, d)))


@query
def accepted_items(spark, d):
    return _without_text(feed.accepted_items(_marked(spark, d)))


@query
def dead_letters(spark, d):
    return feed.letters_of(_marked(spark, d)).select(
        "table_name", "shop_id", "platform", "error_type", "error_msg",
        F.get_json_object("raw_row", "$.order_id").alias("order_id"),
    )


@query
def dead_letter_rate(spark, d):
    return feed.dead_letter_rates(_marked(spark, d), DEAD_LETTER_LIMIT)


def _order_rows(spark, d):
    """ODS rows before their contract: some amounts negative, some values missing."""
    sign = F.when(F.col("order_id").cast("bigint") % 23 == 0, -1).otherwise(1)
    rows = sample.ods_orders(spark, d).withColumns(
        {
            "order_amount_cents": F.col("order_amount_cents") * sign,
            "raw_json": F.lit("{}"),
            "etl_batch_id": F.lit(BATCH),
        }
    )
    return rows.select(*feed.ORDER_COLUMNS)


@query
def contract_orders(spark, d):
    rows = _order_rows(spark, d)
    return rows.select(
        "shop_id", "order_id", contracts.contract_errors(rows.columns, contracts.ORDER_CHECKS).alias("error_msg")
    )


@query
def contract_items(spark, d):
    line = F.col("item_id").cast("bigint")
    rows = (
        sample.ods_items(spark, d)
        .withColumns(
            {
                "quantity": F.when(F.col("price_cents") % 29 == 0, 0).otherwise(F.col("quantity")),
                "price_cents": F.when(line == 7, -F.col("price_cents")).otherwise(F.col("price_cents")),
                "raw_json": F.lit("{}"),
                "etl_batch_id": F.lit(BATCH),
            }
        )
        .select(*feed.ITEM_COLUMNS)
    )
    return rows.select(
        "shop_id", "order_id", "item_id",
        contracts.contract_errors(rows.columns, contracts.ITEM_CHECKS).alias("error_msg"),
    )


@query
def contract_split(spark, d):
    good, bad = contracts.contract_split(_order_rows(spark, d), contracts.ORDER_CHECKS)
    both = good.withColumn("error_msg", F.lit(None).cast("string")).unionByName(bad)
    return both.select(
        F.when(F.col("error_msg").isNull(), "good").otherwise("bad").alias("side"),
        "shop_id", "order_id", "order_amount_cents", "error_msg",
    )


# ---- merges ------------------------------------------------------------------------------


@query
def dedup_latest(spark, d):
    return sample.ods_items(spark, d)


@query
def merge_monotonic(spark, d):
    return merge.merge_monotonic(
        sample.merge_existing(spark, d), sample.merge_incoming(spark, d), sample.ORDER_KEY, with_action=True
    )


@query
def merge_decisions(spark, d):
    """What a merge does with each incoming row, told by the key and update time of the stored one alone."""
    known = sample.merge_existing(spark, d).select(*sample.ORDER_KEY, F.col("updated_at").alias("known_at"))
    decided = merge.decide(sample.merge_incoming(spark, d), known, sample.ORDER_KEY, "updated_at", "known_at")
    return decided.select(*sample.ORDER_KEY, "known_at", "updated_at", merge.ACTION)


@query
def moved_days(spark, d):
    """Days that orders leave and reach when some are dated anew, as far as their new version wins."""
    stored, incoming = (
        x.withColumn("stat_date", F.to_date(F.coalesce("created_at", "updated_at")))
        for x in (sample.merge_existing(spark, d), sample.dated_anew(spark, d))
    )
    return merge.moved_days(stored, incoming, sample.ORDER_KEY, "stat_date", ("shop_id", "platform"))


@query
def moved_shop_days(spark, d):
    """Shop days after the merge, built again for exactly these days and kept for all others."""
    before, incoming = sample.merge_existing(spark, d), sample.dated_anew(spark, d)
    after = merge.merge_monotonic(before, incoming, sample.ORDER_KEY)
    keys = ["shop_id", "platform", "stat_date"]
    days = moved_days(spark, d)
    dwd = facts.dwd_orders(after, BATCH)
    fresh = daily.shop_daily(dwd.join(days, keys, "left_semi"))
    kept = daily.shop_daily(facts.dwd_orders(before, BATCH)).join(days, keys, "left_anti")
    return kept.unionByName(fresh)


@query
def merge_replace(spark, d):
    return merge.merge_replace(sample.merge_incoming(spark, d), sample.merge_existing(spark, d), sample.ORDER_KEY)


@query
def overwrite_window(spark, d):
    """Shop days rebuilt for a window of platform alpha, from orders whose payment was corrected."""
    stored = shop_daily(spark, d)
    corrected = facts.dwd_orders(sample.merge_incoming(spark, d), BATCH)
    window = F.col("stat_date").between(F.lit(SINCE), F.lit(UNTIL)) & (F.col("platform") == "alpha")
    fresh = daily.shop_daily(corrected.where(window & (F.col("shop_id") != 3)))
    return merge.overwrite_window(stored, fresh, "stat_date", SINCE, UNTIL, platform="alpha")


@query
def table_row_counts(spark, d):
    return compare.table_row_counts(
        {
            "dw.ods_orders": sample.ods_orders(spark, d),
            "dw.ods_order_items": sample.ods_items(spark, d),
            "dw.dws_shop_daily": shop_daily(spark, d),
            "dw.dws_product_daily": product_daily(spark, d),
            "etl_meta.etl_batch": sample.etl_batch(spark, d),
        }
    )


@query
def table_diff(spark, d):
    """Orders before and after a merge, without the update time."""
    merged = merge.merge_monotonic(sample.merge_existing(spark, d), sample.merge_incoming(spark, d), sample.ORDER_KEY)
    return compare.table_diff(sample.ods_orders(spark, d), merged, ignore=["updated_at"])


# ---- detail layer ------------------------------------------------------------------------


def _dwd(spark, d):
    return facts.dwd_orders(sample.ods_orders(spark, d), BATCH)


def _dwd_items(spark, d):
    return facts.dwd_items(sample.ods_items(spark, d), BATCH)


@query
def normalize_status(spark, d):
    """Statuses with and without a platform's code map."""
    plain = _dwd(spark, d).select("shop_id", "order_id", "platform", "status_raw", "status_norm")
    mapped = facts.dwd_orders(sample.ods_orders(spark, d), BATCH, STATUS_MAP)
    return plain.join(
        mapped.select("shop_id", "order_id", F.col("status_norm").alias("status_mapped")), ["shop_id", "order_id"]
    )


@query
def dwd_orders(spark, d):
    return _dwd(spark, d)


@query
def dwd_order_items(spark, d):
    return _dwd_items(spark, d)


@query
def window_items(spark, d):
    """Items of the orders of a business window."""
    orders = facts.business_window(sample.ods_orders(spark, d), SINCE, UNTIL)
    return facts.items_of_orders(sample.ods_items(spark, d), orders)


@query
def paid_orders(spark, d):
    return facts.paid_orders(_dwd(spark, d))


# ---- summaries and reports ---------------------------------------------------------------


@query
def shop_daily(spark, d):
    return daily.shop_daily(_dwd(spark, d))


@query
def product_daily(spark, d):
    return daily.product_daily(_dwd(spark, d), _dwd_items(spark, d))


@query
def product_sightings(spark, d):
    """First and last sighting of each product name by month of the items."""
    items = sample.ods_items(spark, d).withColumn("period", F.date_format("updated_at", "yyyy-MM"))
    return dimensions.product_sightings(items, "platform", "period")


@query
def dim_product_of_sightings(spark, d):
    """The product dimension put together from the sightings of all months."""
    return dimensions.product_dimension_of(product_sightings(spark, d), ORDERS_NOW)


@query
def dim_product(spark, d):
    return dimensions.product_dimension(sample.ods_items(spark, d), ORDERS_NOW)


@query
def shop_overview(spark, d):
    items = sample.ods_items(spark, d)
    products = daily.product_daily(_dwd(spark, d), facts.dwd_items(items, BATCH))
    catalogue = items.select("shop_id", "product_id").distinct()
    return reports.shop_overview(shop_daily(spark, d), products, catalogue)


@query
def shop_overview_window(spark, d):
    """The overview of a rebuild window; its first day is compared with one day of look-back."""
    items = sample.ods_items(spark, d)
    products = daily.product_daily(_dwd(spark, d), facts.dwd_items(items, BATCH))
    catalogue = items.select("shop_id", "product_id").distinct()
    return reports.shop_overview(shop_daily(spark, d), products, catalogue, since=SINCE)


@query
def daily_kpi(spark, d):
    return reports.daily_kpi(shop_daily(spark, d))


@query
def daily_kpi_distinct_buyers(spark, d):
    return reports.kpi_distinct_buyers(_dwd(spark, d))


# ---- dimensions --------------------------------------------------------------------------


def _calendar(spark, d, before: int, after: int):
    day = F.to_date(F.coalesce("created_at", "updated_at"))
    bounds = sample.ods_orders(spark, d).agg(
        F.date_sub(F.min(day), before).alias("first_day"), F.date_add(F.max(day), after).alias("last_day")
    )
    return dimensions.calendar(bounds, HOLIDAYS)


#: The holiday table extended by days the data covers.
HOLIDAYS = {**dimensions.HOLIDAYS, date(1999, 10, 1): "国庆节", date(2000, 1, 1): "元旦", date(2001, 5, 1): "劳动节"}


@query
def dim_date(spark, d):
    """Every day from a year before the first order to a year after the last."""
    return _calendar(spark, d, 365, 366)


@query
def dim_date_refresh(spark, d):
    """A stored calendar with outdated flags, refreshed by a longer one."""
    stored = _calendar(spark, d, 30, 0).withColumns(
        {
            "is_holiday": F.when(F.col("day_num") == 1, 1).otherwise(0),
            "holiday_name": F.when(F.col("day_num") == 1, "first"),
            "week_of_year": F.lit(0),
        }
    )
    return merge.refresh_columns(stored, dim_date(spark, d), "date_key", dimensions.REFRESHED_DATE_COLUMNS)


@query
def scd2_diff(spark, d):
    return dimensions.shop_changes(sample.shop_registry(spark, d), sample.shop_versions(spark, d), EFFECTIVE)


@query
def scd2_apply(spark, d):
    versions = sample.shop_versions(spark, d)
    changes = dimensions.shop_changes(sample.shop_registry(spark, d), versions, EFFECTIVE)
    return dimensions.apply_shop_changes(versions, changes).drop("shop_key")


# ---- state -------------------------------------------------------------------------------


@query
def watermark_advance(spark, d):
    """Backfill batches offered to the stored watermarks; only newer values move them."""
    reached = (
        sample.etl_batch(spark, d).where("status = 'success'")
        .withColumn("shop_id", F.col("shop_id") + F.when(F.col("run_type") == "backfill", 2).otherwise(0))
        .groupBy("table_name", "shop_id", "platform").agg(F.max("window_end").alias("watermark_value"))
    )
    return windows.advance_watermarks(sample.etl_watermark(spark, d), reached)


@query
def compute_windows(spark, d):
    return windows.compute_windows(sample.etl_watermark(spark, d), EVENTS_NOW)


@query
def window_row_counts(spark, d):
    spans = windows.compute_windows(
        sample.ods_orders(spark, d).groupBy("shop_id", "platform").agg(
            F.min("updated_at").alias("watermark_value")
        ).withColumn("table_name", F.lit("dw.ods_orders")),
        ORDERS_NOW,
    )
    return windows.window_row_counts(sample.ods_orders(spark, d), spans)


def own_windows(spark, d):
    """A window of its own for every shop and platform, half of which have no orders.

    Where a shop has orders both ends are update times of orders: the first counts, the last does not.
    """
    shops = sample.read(spark, d, "region").select(
        (F.col("r_regionkey") + 1).cast("bigint").alias("shop_id"), F.explode(F.array(F.lit("alpha"), F.lit("beta"))).alias("platform")
    )
    start = F.make_timestamp_ntz(F.lit(1996), F.col("shop_id"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    end = F.make_timestamp_ntz(F.lit(1998), F.lit(1), F.col("shop_id"), F.lit(0), F.lit(0), F.lit(0))
    orders = sample.ods_orders(spark, d)
    ends = orders.groupBy("shop_id", "platform").agg(
        F.min(F.when(F.col("updated_at") >= start, F.col("updated_at"))).alias("_first"),
        F.max(F.when(F.col("updated_at") < end, F.col("updated_at"))).alias("_last"),
    )
    return shops.join(ends, ["shop_id", "platform"], "left").select(
        "shop_id", "platform",
        F.coalesce("_first", start).alias("window_start"), F.coalesce("_last", end).alias("window_end"),
    )


@query
def window_row_counts_own(spark, d):
    """Rows inside each shop's own window; shops without rows count 0."""
    return windows.window_row_counts(sample.ods_orders(spark, d), own_windows(spark, d))


@query
def rule_sync(spark, d):
    return quality.sync_rules(sample.rule_defs(spark, d), sample.rule_specs(spark, d))


# ---- data quality ------------------------------------------------------------------------

ORDERS, ITEMS = "dw.ods_orders", "dw.ods_order_items"

#: The rule set of the sample warehouse.
RULES = [
    quality.Rule(ORDERS, "null_rate", {"column": "buyer_nick", "max_rate": 0.0}, "block", 1),
    quality.Rule(ORDERS, "unique", {"columns": ["shop_id", "order_id"]}, "block", 2),
    quality.Rule(ORDERS, "range", {"column": "order_amount_cents", "min": 0, "max": 500000000}, "warn", 3),
    quality.Rule(ORDERS, "freshness", {"column": "updated_at", "max_age_minutes": 2880}, "warn", 4),
    quality.Rule(ORDERS, "row_count_delta", {"max_deviation": 0.9, "lookback_batches": 10}, "warn", 5),
    quality.Rule(ITEMS, "range", {"column": "quantity", "min": 1, "max": 10000}, "warn", 6),
    quality.Rule(
        ITEMS, "referential",
        {
            "child_column": "order_id", "child_shop_column": "shop_id", "parent_table": ORDERS,
            "parent_column": "order_id", "parent_shop_column": "shop_id",
        },
        "block", 7,
    ),
]


def _table_rule(rule_type: str, table: str, severity: str = "block", **params) -> quality.Rule:
    return quality.Rule(table, rule_type, {**params, "scope": "table"}, severity, 1)


@query
def dq_null_rate(spark, d):
    orders = sample.ods_orders(spark, d)
    rules = [_table_rule("null_rate", ORDERS, column="buyer_nick", max_rate=rate) for rate in (0.0, 0.02)]
    return quality.run_checks({ORDERS: orders}, rules, now=ORDERS_NOW)


@query
def dq_unique(spark, d):
    tables = {"dw.items_feed": sample.ods_items_feed(spark, d), ITEMS: sample.ods_items(spark, d)}
    key = list(sample.ITEM_KEY)
    return quality.run_checks(tables, [_table_rule("unique", t, columns=key) for t in tables], now=ORDERS_NOW)


@query
def dq_range(spark, d):
    orders = sample.ods_orders(spark, d)
    rules = [_table_rule("range", ORDERS, column="order_amount_cents", min=0, max=top) for top in (500000000, 1000000)]
    return quality.run_checks({ORDERS: orders}, rules, now=ORDERS_NOW)


@query
def dq_freshness(spark, d):
    orders = sample.ods_orders(spark, d)
    rules = [_table_rule("freshness", ORDERS, max_age_minutes=m) for m in (2880, 100)]
    return quality.run_checks({ORDERS: orders}, rules, now=datetime(2001, 8, 2, 12))


@query
def dq_row_count_delta(spark, d):
    """Rows of each shop against its earlier batches, for every table of the ledger."""
    ledger = sample.etl_batch(spark, d)
    rows = ledger.groupBy("shop_id", "platform").agg(F.max("rows_read").alias("rows_read"))
    tables = {t: ledger for t in (ORDERS, ITEMS)}
    rules = [quality.Rule(t, "row_count_delta", {"max_deviation": 3.5}, "warn", 1) for t in tables]
    return quality.run_checks(tables, rules, now=EVENTS_NOW, ledger=ledger, batch_rows=rows)


@query
def dq_referential(spark, d):
    """Items against all orders, and against orders without the deleted ones."""
    orders = sample.ods_orders(spark, d)
    tables = {ITEMS: sample.ods_items(spark, d), ORDERS: orders, "dw.live_orders": orders.where("is_deleted = 0")}
    pair = {"child_column": "order_id", "child_shop_column": "shop_id", "parent_column": "order_id", "parent_shop_column": "shop_id"}
    rules = [_table_rule("referential", ITEMS, parent_table=p, **pair) for p in (ORDERS, "dw.live_orders")]
    return quality.run_checks(tables, rules, now=ORDERS_NOW)


@query
def dq_own_windows(spark, d):
    """Rules over each shop's own window; shops without rows pass with a note."""
    rules = [
        quality.Rule(ORDERS, "null_rate", {"column": "buyer_nick", "max_rate": 0.01}, "block", 1),
        quality.Rule(ORDERS, "range", {"column": "order_amount_cents", "min": 0, "max": 49900000}, "warn", 2),
        quality.Rule(ORDERS, "freshness", {"column": "updated_at", "max_age_minutes": 1882200}, "warn", 3),
    ]
    return quality.run_checks(
        {ORDERS: sample.ods_orders(spark, d)}, rules, now=ORDERS_NOW, windows=own_windows(spark, d)
    )


def _verdicts(spark, d):
    orders = sample.ods_orders(spark, d)
    shops = orders.groupBy("shop_id", "platform").agg(F.count(F.lit(1)).alias("rows_read"))
    spans = shops.select(
        "shop_id", "platform",
        F.lit(datetime(1990, 1, 1).isoformat(" ")).cast("timestamp_ntz").alias("window_start"),
        F.lit(ORDERS_NOW.isoformat(" ")).cast("timestamp_ntz").alias("window_end"),
    )
    return quality.run_checks(
        {ORDERS: orders, ITEMS: sample.ods_items(spark, d)}, RULES, now=ORDERS_NOW,
        windows=spans, ledger=sample.etl_batch(spark, d), batch_rows=shops,
    )


@query
def dq_run_all(spark, d):
    return _verdicts(spark, d)


@query
def dq_failures_by_severity(spark, d):
    return quality.failures_by_severity(_verdicts(spark, d))


@query
def dq_alert_rows(spark, d):
    return alerts.keep_alerts(alerts.check_alerts(_verdicts(spark, d)))


@query
def dq_results_with_defs(spark, d):
    """Stored check results with the rule they belong to, counted per rule and outcome."""
    results = sample.dq_check_result(spark, d)
    defs = spark.createDataFrame(
        [(r.check_id, r.table_name, r.rule_type, r.severity) for r in RULES],
        "check_id bigint, table_name string, rule_type string, severity string",
    )
    per_check = results.groupBy("check_id", "passed").agg(F.count(F.lit(1)).alias("results"))
    return per_check.join(defs, "check_id").select("check_id", "table_name", "rule_type", "severity", "passed", "results")


# ---- operations --------------------------------------------------------------------------


@query
def ops_success_rate(spark, d):
    return operations.success_rate(sample.etl_batch(spark, d), EVENTS_NOW)


@query
def ops_batch_delay(spark, d):
    return operations.batch_delay(sample.etl_batch(spark, d), EVENTS_NOW)


@query
def ops_duration_p95(spark, d):
    return operations.duration_p95(sample.etl_task_run(spark, d), EVENTS_NOW)


@query
def ops_dq_failures(spark, d):
    return operations.check_failures(sample.dq_check_result(spark, d), EVENTS_NOW)


@query
def ops_load_errors(spark, d):
    return operations.load_errors(sample.etl_load_error(spark, d), sample.etl_batch(spark, d), EVENTS_NOW)


@query
def ops_watermark_age(spark, d):
    return operations.watermark_age(sample.etl_watermark(spark, d), EVENTS_NOW)


# ---- charts ------------------------------------------------------------------------------


@query
def bi_gmv_trend(spark, d):
    return charts.sum_by_day(shop_overview(spark, d), "gmv_cents")


@query
def bi_order_trend(spark, d):
    return charts.sum_by_day(shop_overview(spark, d), "order_cnt")


@query
def bi_refund_rate_trend(spark, d):
    return charts.mean_by_day(shop_overview(spark, d), "refund_rate", scale=10_000)


@query
def bi_avg_order_trend(spark, d):
    return charts.mean_by_day(shop_overview(spark, d), "avg_order_cents")


@query
def bi_shop_detail(spark, d):
    return charts.shop_detail(shop_overview(spark, d))


@query
def bi_gmv_total(spark, d):
    return charts.total(daily_kpi(spark, d), "gmv_cents")


@query
def bi_order_total(spark, d):
    return charts.total(daily_kpi(spark, d), "order_cnt")


@query
def bi_kpi_gmv_trend(spark, d):
    return charts.sum_by_day(daily_kpi(spark, d), "gmv_cents")


@query
def bi_kpi_order_trend(spark, d):
    return charts.sum_by_day(daily_kpi(spark, d), "order_cnt")


@query
def bi_status_share(spark, d):
    return charts.status_share(_dwd(spark, d))


@query
def bi_daily_orders(spark, d):
    return charts.orders_by_day(_dwd(spark, d))


@query
def bi_order_detail(spark, d):
    return charts.order_detail(_dwd(spark, d))
