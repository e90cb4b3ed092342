"""Operators on small literal frames, and their invariants."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shopstrata.operators import alerts, compare, contracts, daily, deadletters, dimensions, facts, feed, merge, operations
from shopstrata.operators import reports, windows
from shopstrata.schemas import DIM_SHOP, DWD_ORDERS, DWS_SHOP_DAILY, conform

T0 = datetime(2026, 9, 15, 10)
DAY = date(2026, 9, 15)


def dwd(spark, *rows):
    base = {
        "shop_id": 1, "platform": "mock", "status_raw": "", "status_norm": "paid", "buyer_nick": "", "is_deleted": 0,
        "order_amount_cents": 0, "payment_amount_cents": 0, "refund_amount_cents": 0, "created_at": T0,
        "updated_at": T0, "stat_date": DAY, "etl_batch_id": "b",
    }
    full = [{**base, "order_id": f"o{n}", **r} for n, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[c] for c in DWD_ORDERS.fieldNames()) for r in full], DWD_ORDERS)


def shop_days(spark, *rows):
    names = DWS_SHOP_DAILY.fieldNames()
    return spark.createDataFrame([tuple({"platform": "mock", **r}[c] for c in names) for r in rows], DWS_SHOP_DAILY)


def shop_day(day, gmv, orders, shop=1, refund=0):
    return {"stat_date": date(2026, 9, day), "shop_id": shop, "gmv_cents": gmv, "order_cnt": orders, "buyer_cnt": orders,
            "refund_cents": refund, "avg_order_cents": gmv // orders if orders else 0}


def product_days(spark, *rows):
    return spark.createDataFrame(list(rows), "stat_date date, shop_id bigint, product_id string, platform string, sold_qty int, sales_cents bigint")


@pytest.mark.parametrize(
    ("raw", "refund", "paid", "want"),
    [("paid", 0, 100, "paid"), ("completed", 100, 100, "refunded"), ("shipped", 1, 1, "refunded"),
     ("completed", 100, 0, "completed"), ("completed", None, 100, "completed"), ("cancelled", 100, 100, "cancelled"),
     ("mystery", 0, 0, "unknown"), (None, 0, 0, "unknown"), ("DONE", 0, 1, "completed"), ("OTHER", 0, 1, "unknown")],
)
def test_status(spark, raw, refund, paid, want):
    row = spark.createDataFrame([("tao", raw, refund, paid)], "p string, r string, rf bigint, pay bigint")
    from shopstrata.functions import status_norm

    got = row.select(status_norm(F.col("p"), F.col("r"), F.col("rf"), F.col("pay"), {"tao": {"DONE": "completed"}}))
    assert got.first()[0] == want


def test_shop_daily_counts_paid_scope_only(spark):
    frame = dwd(
        spark,
        {"payment_amount_cents": 100, "buyer_nick": "a"}, {"status_norm": "pending", "payment_amount_cents": 999},
        {"status_norm": "cancelled", "payment_amount_cents": 999},
        {"status_norm": "refunded", "payment_amount_cents": 50, "refund_amount_cents": 50, "buyer_nick": "a"},
        {"payment_amount_cents": 100, "is_deleted": 1, "buyer_nick": "d"},
    )
    row = daily.shop_daily(frame).first()
    assert (row.stat_date, row.gmv_cents, row.order_cnt, row.buyer_cnt, row.refund_cents, row.avg_order_cents) == (
        DAY, 150, 2, 1, 50, 75
    )


def test_missing_values_in_daily_sums(spark):
    frame = dwd(
        spark, {"payment_amount_cents": None, "buyer_nick": None, "is_deleted": None},
        {"payment_amount_cents": 7, "buyer_nick": "a", "created_at": None, "updated_at": T0},
    )
    row = daily.shop_daily(frame).first()
    assert (row.gmv_cents, row.order_cnt, row.buyer_cnt, row.avg_order_cents) == (7, 2, 2, 3)  # a missing buyer is one buyer


def test_product_daily_joins_paid_orders(spark):
    orders = dwd(spark, {"order_id": "a"}, {"order_id": "b", "status_norm": "cancelled"})
    items = spark.createDataFrame(
        [(1, "a", "p1", 2, 200), (1, "b", "p9", 5, 500), (1, "a", "p2", None, None)],
        "shop_id bigint, order_id string, product_id string, quantity int, amount_cents bigint",
    )
    rows = sorted((r.product_id, r.sold_qty, r.sales_cents) for r in daily.product_daily(orders, items).collect())
    assert rows == [("p1", 2, 200), ("p2", 0, 0)]


def test_item_amount_is_null_when_a_factor_is(spark):
    items = spark.createDataFrame(
        [(1, "o", "1", "m", "p", "n", 3, 250, T0), (1, "o", "2", "m", "p", "n", None, 250, T0)],
        "shop_id bigint, order_id string, item_id string, platform string, product_id string, product_name string, "
        "quantity int, price_cents bigint, updated_at timestamp_ntz",
    )
    assert [r.amount_cents for r in facts.dwd_items(items, "b").orderBy("item_id").collect()] == [750, None]


def test_overview_compares_with_the_row_before_and_drops_the_look_back(spark):
    days = shop_days(spark, shop_day(14, 100, 2, refund=10), shop_day(15, 200, 4))
    products = product_days(spark, (DAY, 1, "p1", "mock", 1, 100), (DAY, 1, "p2", "mock", 1, 100))
    catalogue = spark.createDataFrame([(1, f"p{n}") for n in range(8)], "shop_id bigint, product_id string")
    rows = reports.shop_overview(days, products, catalogue, since=DAY).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.gmv_dod_pct, r.order_dod_pct, r.refund_rate) == (100.0, 100.0, 0.0)
    assert (r.active_product_cnt, r.product_total_cnt, r.sell_through_rate) == (2, 8, 0.25)


def test_overview_guards_against_zero(spark):
    days = shop_days(spark, shop_day(14, 0, 0), shop_day(15, 5, 1))
    empty = product_days(spark)
    r14, r15 = reports.shop_overview(days, empty, empty.select("shop_id", "product_id")).orderBy("stat_date").collect()
    assert r14.refund_rate == 0 and r14.sell_through_rate == 0 and r14.gmv_dod_pct is None
    assert r15.gmv_dod_pct is None  # nothing to compare with when the day before is 0


def test_kpi_sums_shops_of_a_platform(spark):
    days = shop_days(spark, shop_day(14, 100, 2), shop_day(15, 100, 2), shop_day(15, 300, 3, shop=2))
    r = reports.daily_kpi(days, since=DAY).collect()
    assert [(x.gmv_cents, x.order_cnt, x.shop_cnt, x.avg_order_cents, x.gmv_dod_pct) for x in r] == [(400, 5, 2, 80, 300.0)]


def test_products_take_the_latest_name(spark):
    items = spark.createDataFrame(
        [(1, "p1", "old", datetime(2026, 6, 1)), (1, "p1", "new", datetime(2026, 9, 15)), (1, "p2", "gone", datetime(2025, 1, 1))],
        "shop_id bigint, product_id string, product_name string, updated_at timestamp_ntz",
    )
    rows = {r.product_id: r for r in dimensions.product_dimension(items, datetime(2026, 9, 17)).collect()}
    assert (rows["p1"].product_name, rows["p1"].first_seen_at, rows["p1"].is_active) == ("new", datetime(2026, 6, 1), 1)
    assert rows["p2"].is_active == 0


def test_calendar(spark):
    bounds = spark.createDataFrame([(date(2026, 9, 30), date(2026, 10, 4))], "first_day date, last_day date")
    rows = {r.stat_date: r for r in dimensions.calendar(bounds).collect()}
    assert len(rows) == 5 and rows[date(2026, 10, 1)].holiday_name == "国庆节"
    assert (rows[date(2026, 10, 4)].day_of_week, rows[date(2026, 10, 4)].is_weekend, rows[date(2026, 10, 4)].is_holiday) == (7, 1, 0)
    for day, r in rows.items():
        assert (r.date_key, r.week_of_year, r.quarter_num) == (int(day.strftime("%Y%m%d")), day.isocalendar().week, (day.month + 2) // 3)


def test_shop_changes(spark):
    registry = spark.createDataFrame(
        [(1, "m", "new name", "active"), (2, "m", "same", "active"), (4, "m", "fresh", "active")],
        "shop_id bigint, platform string, shop_name string, status string",
    )
    versions = spark.createDataFrame(
        [(10, 1, "m", "old name", "active", DAY, None, 1), (11, 2, "m", "same", "active", DAY, None, 1),
         (12, 3, "m", "removed", "active", DAY, None, 1), (13, 3, "m", "older", "active", DAY, DAY, 0)], DIM_SHOP,
    )
    rows = dimensions.shop_changes(registry, versions, date(2026, 9, 17)).collect()
    assert sorted((r.change, r.shop_id, r.shop_key) for r in rows) == [
        ("close", 1, 10), ("close", 3, 12), ("open", 1, None), ("open", 4, None),
    ] or sorted((r.change, r.shop_id) for r in rows) == [("close", 1), ("close", 3), ("open", 1), ("open", 4)]


DEMO = "shop_id bigint, order_id string, status string, amount_cents bigint, updated_at timestamp_ntz"
KEY = ("shop_id", "order_id")


def demo(spark, *rows):
    return spark.createDataFrame([(1, *r) for r in rows], DEMO)


def content(df):
    return sorted(map(tuple, df.collect()))


def test_merge_inserts_updates_and_ignores_late_rows(spark):
    t = datetime(2026, 9, 1, 10)
    old = demo(spark, ("A", "paid", 100, t), ("B", "shipped", 200, t), ("Z", "kept", 1, t))
    new = demo(spark, ("A", "completed", 150, t + timedelta(hours=1)), ("B", "late", 1, t - timedelta(hours=1)),
               ("C", "paid", 300, t), ("Z", "tie", 9, t))
    merged = merge.merge_monotonic(old, new, KEY, with_action=True)
    assert {(r.order_id, r.status, r.merge_action) for r in merged.collect()} == {
        ("A", "completed", "updated"), ("B", "shipped", "ignored"), ("C", "paid", "inserted"), ("Z", "kept", "ignored"),
    }
    recompute = merge.merge_monotonic(old, new, KEY, replace_equal=True)
    assert {r.status for r in recompute.where("order_id = 'Z'").collect()} == {"tie"}


def test_merge_is_idempotent_and_independent_of_order(spark):
    rng = random.Random(7)
    t = datetime(2026, 9, 1)
    events = [(f"k{rng.randrange(20)}", f"s{n}", n, t + timedelta(seconds=n * 37 % 1000)) for n in range(120)]
    empty = demo(spark)
    whole = content(merge.merge_monotonic(empty, demo(spark, *events), KEY))
    rng.shuffle(events)
    state = empty
    for start in range(0, 120, 40):
        batch = demo(spark, *events[start:start + 40])
        state = spark.createDataFrame(merge.merge_monotonic(state, batch, KEY).collect(), DEMO)
    assert content(state) == whole
    assert content(merge.merge_monotonic(state, state, KEY)) == whole


def test_merge_without_moving_existing_rows_gives_the_same(spark):
    rng = random.Random(3)
    t = datetime(2026, 9, 1)
    old = demo(spark, *[(f"k{n}", "old", n, t + timedelta(hours=n % 5)) for n in range(40)])
    new = demo(spark, *[(f"k{rng.randrange(60)}", f"n{n}", n, t + timedelta(hours=n % 7)) for n in range(80)])
    for equal in (False, True):
        shuffled = merge.merge_monotonic(old, new, KEY, replace_equal=equal, with_action=True)
        resident = merge.merge_monotonic(old, new, KEY, replace_equal=equal, with_action=True, broadcast_incoming=True)
        assert content(shuffled) == content(resident)
    assert {r[0] for r in resident.select(merge.ACTION).distinct().collect()} == {"inserted", "updated", "ignored", "kept"}


def test_merge_fills_missing_and_ignores_additional_columns(spark):
    t = datetime(2026, 9, 1)
    new = demo(spark, ("A", "paid", 1, t)).drop("status").withColumn("extra", F.lit(1))
    assert content(merge.merge_monotonic(demo(spark), new, KEY)) == [(1, "A", None, 1, t)]
    with pytest.raises(ValueError):
        merge.merge_monotonic(demo(spark).select(*KEY), new, KEY)


def test_one_very_frequent_key_is_cut_before_the_shuffle(spark):
    hot = spark.range(0, 20000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("updated_at"),
    )
    best = merge.latest_by_key(hot, ["k"])
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert best.count() == hot.select("k").distinct().count()
    assert best.where("k = 0").first().v == 19998


def test_overwrite_drops_rows_nothing_replaces(spark):
    days = shop_days(spark, shop_day(14, 1, 1), shop_day(15, 2, 1), shop_day(16, 3, 1), shop_day(15, 9, 1, shop=2))
    fresh = shop_days(spark, shop_day(16, 30, 1))
    every = merge.overwrite_window(days, fresh, "stat_date", DAY, date(2026, 9, 16))
    assert sorted((r.stat_date.day, r.gmv_cents) for r in every.collect()) == [(14, 1), (16, 30)]
    one = merge.overwrite_window(days, fresh, "stat_date", DAY, date(2026, 9, 16), shop_id=1)
    assert sorted((r.stat_date.day, r.gmv_cents) for r in one.collect()) == [(14, 1), (15, 9), (16, 30)]
    scope = spark.createDataFrame([(2,)], "shop_id bigint")
    two = merge.overwrite_window(days, fresh.limit(0), "stat_date", DAY, date(2026, 9, 16), scope=scope)
    assert sorted((r.stat_date.day, r.gmv_cents) for r in two.collect()) == [(14, 1), (15, 2), (16, 3)]


def test_table_diff_counts_copies(spark):
    left, right = spark.createDataFrame([(1,), (1,), (2,)], "a int"), spark.createDataFrame([(1,), (3,)], "a int")
    rows = sorted(map(tuple, compare.table_diff(left, right).collect()))
    assert rows == [(1, 2, 1), (2, 1, 0), (3, 0, 1)]


def order_row(spark, **change):
    row = {
        "shop_id": 1, "order_id": "x", "platform": "m", "order_status": "paid", "buyer_nick": "u", "order_amount_cents": 1,
        "payment_amount_cents": 1, "refund_amount_cents": 0, "raw_json": "{}", "is_deleted": 0, "created_at": T0,
        "updated_at": T0, "etl_batch_id": "b", **change,
    }
    from shopstrata.schemas import ODS_ORDERS

    return spark.createDataFrame([tuple(row[c] for c in ODS_ORDERS.fieldNames())], ODS_ORDERS)


def test_contracts_report_every_broken_check(spark):
    good, bad = contracts.contract_split(
        order_row(spark).unionByName(order_row(spark, order_id="", order_amount_cents=-1, is_deleted=2)), contracts.ORDER_CHECKS
    )
    assert good.count() == 1 and good.columns == order_row(spark).columns
    message = bad.first().error_msg
    assert message.split("; ") == [
        "order_id: at least 1 character, got ", "order_amount_cents: at least 0, got -1", "is_deleted: one of 0, 1, got 2",
    ]


def test_contracts_are_strict_about_columns(spark):
    missing = order_row(spark).drop("order_id")
    assert contracts.contract_split(missing, contracts.ORDER_CHECKS)[0].isEmpty()
    extra = order_row(spark).withColumn("surprise", F.lit(1))
    assert "surprise: column not expected" in contracts.contract_split(extra, contracts.ORDER_CHECKS)[1].first().error_msg


def test_repeated_letters_are_one(spark):
    one = spark.createDataFrame([("t", 1, "p", "{}", "mapper_error", "m")], "table_name string, shop_id bigint, platform string, raw_row string, error_type string, error_msg string")
    stamped = [deadletters.stamp(one, b, F.lit(T0.isoformat(" ")).cast("timestamp_ntz")) for b in ("b1", "b2")]
    row = deadletters.distinct_letters(stamped[0].unionByName(stamped[1])).collect()
    assert len(row) == 1 and row[0].times_seen == 2


def test_windows():
    now, mark = datetime(2026, 9, 2, 12), datetime(2026, 9, 2, 11)
    assert windows.extract_window(mark, now) == windows.TimeWindow(datetime(2026, 9, 2, 10), datetime(2026, 9, 2, 11, 55))
    assert windows.extract_window(None, now).start == datetime(2020, 1, 1)
    t = datetime(2026, 9, 10, 8)
    assert windows.resolve_run("backfill", t, t) == ("backfill", windows.TimeWindow(t - timedelta(hours=1), t))
    assert windows.resolve_run("backfill", t, t + timedelta(hours=1))[1].end == t + timedelta(hours=1)
    assert windows.resolve_run("backfill", None, None) == ("backfill", None)
    assert windows.resolve_run("scheduled", t, t) == ("incremental", None) == windows.resolve_run("manual", None, None)
    from datetime import UTC

    aware = windows.TimeWindow(datetime(2026, 9, 10, 3, tzinfo=UTC), datetime(2026, 9, 10, 4, tzinfo=UTC))
    assert aware.localized() == windows.TimeWindow(datetime(2026, 9, 10, 11), datetime(2026, 9, 10, 12))
    assert windows.resolve_build_since("backfill", datetime(2026, 9, 1, 20, tzinfo=UTC), now) == date(2026, 9, 2)
    assert windows.resolve_build_since("scheduled", None, datetime(2026, 9, 17, 10)) == date(2026, 9, 15)
    assert windows.resolve_build_since("scheduled", None, datetime(2026, 9, 17, 10), days=7) == date(2026, 9, 11)


def test_watermarks_only_advance(spark):
    schema = "table_name string, shop_id bigint, platform string, watermark_value timestamp_ntz"
    old = spark.createDataFrame([("t", 1, "p", T0), ("t", 2, "p", T0), ("t", 3, "p", T0)], schema)
    new = spark.createDataFrame([("t", 1, "p", T0 + timedelta(1)), ("t", 2, "p", T0), ("t", 4, "p", T0)], schema)
    rows = {r.shop_id: (r.watermark_value, r.moved) for r in windows.advance_watermarks(old, new).collect()}
    assert rows == {1: (T0 + timedelta(1), 1), 2: (T0, 0), 3: (T0, 0), 4: (T0, 1)}


@pytest.mark.parametrize("percent", [0, 50, 95, 100])
def test_ranked_value_matches_brute_force(spark, percent):
    rng = random.Random(percent)
    data = [("hot", rng.choice([5, 5, 5, rng.randrange(10**6)])) for _ in range(700)]
    data += [("one", 42), ("pair", 1), ("pair", 10**7), ("none", None)] + [("neg", rng.randrange(-9000, 9000)) for _ in range(90)]
    df = spark.createDataFrame(data, "g string, v bigint")
    got = {r.g: r.v for r in operations.ranked_value(df, "g", "v", percent).collect()}
    want = {}
    for g in {g for g, v in data if v is not None}:
        xs = sorted(v for k, v in data if k == g)
        fits = [v for v in xs if len(xs) == 1 or sum(x < v for x in xs) / (len(xs) - 1) <= percent / 100]
        want[g] = max(fits)
    assert got == want


def test_alert_threshold(spark):
    rows = spark.createDataFrame([("a", x) for x in ("info", "warning", "error", "critical")], "title string, level string")
    assert alerts.keep_alerts(rows).count() == 3 and alerts.keep_alerts(rows, min_level="critical").count() == 1
    assert alerts.keep_alerts(rows, enabled=False).isEmpty()


def test_messages_of_one_hot_order_are_counted_and_cut(spark):
    text = '{"shop_id": 1, "order_id": "x", "updated_at": "2026-09-01T00:00:%02d"}'
    rows = [("p", None, text % (n % 60)) for n in range(300)] + [("p", None, '{"shop_id": 1}')] * 3
    keyed = feed.message_keys(spark.createDataFrame(rows, "platform string, source_shop_id bigint, value string"))
    newest = feed.newest_messages(keyed)
    got = sorted((r.copies, r.value) for r in newest.collect())
    assert got == [(3, '{"shop_id": 1}'), (300, text % 59)]
    assert newest._jdf.queryExecution().executedPlan().toString().count("partial_max") >= 1


def test_conform_projects_onto_a_schema(spark):
    df = conform(spark.createDataFrame([(1, "x")], "shop_id int, junk string"), DWS_SHOP_DAILY)
    assert df.schema == DWS_SHOP_DAILY and df.first().shop_id == 1
