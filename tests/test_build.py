"""The warehouse build: golden values, replay, window overwrite, shop history, monitor."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from feed_messages import column, item, messages, order

from shopstrata.operators import dimensions
from shopstrata.operators.compare import table_diff
from shopstrata.operators.quality import Rule
from shopstrata.plans import build as build_plan
from shopstrata.plans import monitor, state
from shopstrata.plans.build import build_warehouse
from shopstrata.plans.ingest import ingest_batch
from shopstrata.plans.upsert import upsert
from shopstrata.operators import feed
from shopstrata.sources.tables import ConcurrentWrite, Warehouse

NOW = datetime(2026, 9, 17, 10)
SHOPS = [{"shop_id": 1, "platform": "canned", "shop_name": "demo", "status": "active"}]


def seed(wh, rows):
    """Load messages into the raw tables without going through an ingest run."""
    mapped = feed.map_messages(feed.newest_messages(feed.message_keys(messages(wh.spark, rows))), "seed")
    marked = feed.mark_messages(mapped)
    upsert(wh, "dw.ods_orders", feed.accepted_orders(marked))
    upsert(wh, "dw.ods_order_items", feed.accepted_items(marked))


def day(n: int, hour: int = 8) -> datetime:
    return datetime(2026, 9, n, hour)


STATUSES = ["paid", "shipped", "completed", "cancelled", "pending"]
THREE = [{"shop_id": n, "platform": "canned", "shop_name": f"shop {n}", "status": "active"} for n in (1, 2, 3)]


def traffic(seed_number: int, n: int, days=range(4, 12)) -> list[dict]:
    """Orders of three shops: amounts, refunds, states and items drawn at random."""
    r = random.Random(seed_number)
    out = []
    for k in range(n):
        paid = r.randint(100, 9999)
        lines = [item(f"{k}-{i}", f"P{r.randint(1, 6)}", r.randint(1, 4), f"{r.randint(1, 30)}.{r.randint(10, 99)}")
                 for i in range(r.randint(1, 3))]
        out.append(order(
            k, shop_id=r.randint(1, 3), updated=datetime(2026, 9, r.choice(days), r.randint(0, 23)), status=r.choice(STATUSES),
            payment_amount=f"{paid // 100}.{paid % 100:02d}", refund_amount=r.choice(["0", "0", "1.50"]),
            buyer_nick=f"b{r.randint(1, 9)}", is_deleted=r.random() < 0.1, items=lines,
        ))
    return out


def summed(rows):
    """Sales by (day, shop) and by (day, shop, product), added up one order at a time."""
    shops, products = {}, {}
    for o in rows:
        if o["status"] in ("cancelled", "pending") or o["is_deleted"]:
            continue
        cents, refund = (round(Decimal(o[c]) * 100) for c in ("payment_amount", "refund_amount"))
        key = date.fromisoformat(o["created_at"][:10]), o["shop_id"]
        day = shops.setdefault(key, [0, 0, set(), 0])
        day[0] += cents
        day[1] += 1
        day[2].add(o["buyer_nick"])
        day[3] += refund
        for i in o["items"]:
            line = products.setdefault((*key, i["product_id"]), [0, 0])
            line[0] += i["quantity"]
            line[1] += i["quantity"] * round(Decimal(i["price"]) * 100)
    return {k: (g, n, len(b), f) for k, (g, n, b, f) in shops.items()}, {k: tuple(v) for k, v in products.items()}


def stored_sums(wh):
    shops = {
        (r.stat_date, r.shop_id): (r.gmv_cents, r.order_cnt, r.buyer_cnt, r.refund_cents)
        for r in wh.read("dw.dws_shop_daily").collect()
    }
    products = {
        (r.stat_date, r.shop_id, r.product_id): (r.sold_qty, r.sales_cents) for r in wh.read("dw.dws_product_daily").collect()
    }
    return shops, products


DERIVED = ("dw.dws_shop_daily", "dw.dws_product_daily", "dw.ads_shop_overview", "dw.ads_daily_kpi", "dw.dim_product")


def held(wh, names=DERIVED):
    return {n: wh.stage(wh.read(n), "held").df for n in names}


def test_build_adds_up_and_a_rerun_changes_nothing(spark, wh):
    rows = traffic(1, 60)
    seed(wh, rows)
    summary = build_warehouse(wh, THREE, since=date(2026, 9, 4), now=NOW)
    assert summary.orders.inserted == 60 and summary.shop_versions_added == 3
    shops, products = summed(rows)
    assert stored_sums(wh) == (shops, products)
    names = {i["product_id"] for o in rows for i in o["items"]}
    for r in wh.read("dw.ads_shop_overview").collect():
        gmv, n, _, refund = shops[r.stat_date, r.shop_id]
        assert float(r.refund_rate) == round(refund / gmv, 4) and r.avg_order_cents == gmv // n
        assert r.active_product_cnt == len({k[2] for k in products if k[:2] == (r.stat_date, r.shop_id)})
        before = [d for d, s in shops if s == r.shop_id and d < r.stat_date]
        assert (r.gmv_dod_pct is None) == (not before)
    for r in wh.read("dw.ads_daily_kpi").collect():
        of_day = [v for (d, _), v in shops.items() if d == r.stat_date]
        assert (r.gmv_cents, r.shop_cnt) == (sum(v[0] for v in of_day), len(of_day))
    assert set(column(wh.read("dw.dim_product"), "product_id")) == names
    events = {(r.table_name, r.status, r.rows_written) for r in state.ledger(wh).collect()}
    assert {e[:2] for e in events} == {("dw.build", "success"), ("dw.build_kpi", "success")}
    assert ("dw.build_kpi", "success", len({d for d, _ in shops})) in events
    before = held(wh)
    again = build_warehouse(wh, THREE, since=date(2026, 9, 4), now=NOW)
    assert again.shop_versions_added == 0
    for n, rows_before in before.items():
        assert table_diff(wh.read(n), rows_before).isEmpty(), n


def test_a_rebuild_only_changes_its_window(spark, wh):
    old = traffic(2, 30)
    seed(wh, old)
    build_warehouse(wh, THREE, since=date(2026, 9, 4), now=NOW)
    new = [{**o, "payment_amount": "77.70", "updated_at": "2026-09-16T23:00:00"} for o in old]
    seed(wh, new)
    build_warehouse(wh, THREE, since=date(2026, 9, 9), now=NOW)
    late = date(2026, 9, 9)
    want = {k: v for k, v in summed(old)[0].items() if k[0] < late} | {k: v for k, v in summed(new)[0].items() if k[0] >= late}
    assert stored_sums(wh)[0] == want


def test_days_that_an_order_left_or_reached_are_built_again(spark, wh):
    """Orders change their day, from inside the window and from outside; the result is that of a full build."""
    rows = traffic(3, 40)
    at = datetime(2026, 9, 17, 9)
    ingest_batch(wh, messages(spark, rows), now=at)
    build_warehouse(wh, THREE, since=date(2026, 9, 1), now=NOW)
    moved = [
        {**o, "created_at": f"2026-09-{day:02d}T03:00:00", "updated_at": "2026-09-17T09:30:00"}
        for o, day in zip(rows[:6], (2, 3, 16, 2, 5, 17), strict=True)
    ]
    ingest_batch(wh, messages(spark, moved), now=at + timedelta(hours=1))
    changed = [(o, m) for o, m in zip(rows, moved, strict=False) if o["created_at"][:10] != m["created_at"][:10]]
    want = {(o["shop_id"], date.fromisoformat(o["created_at"][:10])) for pair in changed for o in pair}
    assert {(r.shop_id, r.stat_date) for r in wh.read(state.MOVES).collect()} == want
    summary = build_warehouse(wh, THREE, since=date(2026, 9, 15), now=NOW + timedelta(hours=2))
    assert summary.days_rebuilt > 3 and wh.read(state.MOVES).isEmpty()
    assert stored_sums(wh) == summed({o["order_id"]: o for o in [*rows, *moved]}.values())
    # a report's first day has nothing to compare with, so a full build knows more changes; all else is equal
    before = {n: rows_before.select(*[c for c in rows_before.columns if not c.endswith("dod_pct")]) for n, rows_before in held(wh).items()}
    build_warehouse(wh, THREE, since=date(2026, 9, 1), now=NOW + timedelta(hours=2))
    for n, rows_before in before.items():
        assert table_diff(wh.read(n).select(*rows_before.columns), rows_before).isEmpty(), n


def test_a_small_build_reads_only_the_item_periods_of_its_orders(spark, wh):
    rows = [order(n, updated=datetime(2026, 1 + n % 8, 1 + n % 27, 5), items=[item(f"{n}", f"P{n % 9}")]) for n in range(80)]
    seed(wh, rows)
    build_warehouse(wh, SHOPS, since=date(2026, 1, 1), now=NOW)
    late = [order(500, updated=day(16), items=[item("x", "P500")]), order(501, updated=day(16), created_at="2026-09-16T01:00:00")]
    seed(wh, late)
    wanted = wh.read("dw.ods_orders").where("order_id IN ('C0500', 'C0003')")
    found = build_plan.order_items(wh, wanted)
    assert sorted({f.split("part=")[1][:7] for f in found.inputFiles() if "part=" in f and "ods_order_items" in f}) == ["2026-04", "2026-09"]
    assert column(found, "item_id") == ["3", "x"]
    assert build_plan.refresh_sightings(wh) == ["2026-09"]  # the only period that changed since the build
    assert build_plan.refresh_sightings(wh) == []
    build_warehouse(wh, SHOPS, since=date(2026, 9, 15), now=NOW)
    full = dimensions.product_dimension(wh.read("dw.ods_order_items"), NOW)
    assert table_diff(wh.read("dw.dim_product").select(*full.columns), full).isEmpty()


def test_a_day_that_lost_all_its_orders_disappears(spark, wh):
    seed(wh, [order(1, updated=day(15)), order(2, updated=day(16))])
    build_warehouse(wh, SHOPS, since=date(2026, 9, 15), now=NOW)
    seed(wh, [order(2, updated=day(16, 9), status="cancelled")])
    build_warehouse(wh, SHOPS, since=date(2026, 9, 15), now=NOW)
    assert column(wh.read("dw.dws_shop_daily"), "stat_date") == [date(2026, 9, 15)]
    assert column(wh.read("dw.ads_daily_kpi"), "stat_date") in ([date(2026, 9, 15)], [date(2026, 9, 15), date(2026, 9, 16)])
    assert column(wh.read("dw.ads_daily_kpi"), "stat_date") == [date(2026, 9, 15)]


def test_history_and_other_shops(spark, wh):
    seed(wh, [order(1, updated=datetime(2026, 8, 1, 8), payment_amount="100.00"), order(2, shop_id=2, updated=day(16))])
    build_warehouse(wh, SHOPS, since=date(2026, 9, 15), now=NOW)
    assert wh.read("dw.dwd_orders").count() == 0  # outside the window, or not a registered shop
    build_warehouse(wh, SHOPS, since=date(2019, 1, 1), now=NOW)
    assert [(r.stat_date, r.gmv_cents) for r in wh.read("dw.dws_shop_daily").collect()] == [(date(2026, 8, 1), 10000)]


def test_shop_history_follows_the_registry(spark, wh):
    registry = build_plan.registry_frame
    first, second, third = date(2026, 9, 1), date(2026, 9, 2), date(2026, 9, 3)
    assert build_plan.sync_shops(wh, registry(spark, SHOPS), first) == 1
    renamed = [{**SHOPS[0], "shop_name": "renamed"}]
    assert build_plan.sync_shops(wh, registry(spark, renamed), second) == 1
    again = [{**SHOPS[0], "shop_name": "again"}]
    assert build_plan.sync_shops(wh, registry(spark, again), second) == 1  # replaces the version of that day
    other = [{"shop_id": 9, "platform": "canned", "shop_name": "other", "status": "active"}]
    assert build_plan.sync_shops(wh, registry(spark, other), third) == 1
    rows = sorted((r.shop_id, r.shop_name, r.valid_from, r.valid_to, r.is_current) for r in wh.read("dw.dim_shop").collect())
    assert rows == [
        (1, "again", second, third, 0), (1, "demo", first, second, 0), (9, "other", third, None, 1),
    ]


def test_failed_build_is_recorded_and_raised(spark, wh, monkeypatch):
    monkeypatch.setattr("shopstrata.plans.build.daily.shop_daily", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        build_warehouse(wh, SHOPS, since=date(2026, 9, 15), now=NOW)
    assert column(state.ledger(wh), "status") == ["failed"]
    assert column(wh.read_log(state.ALERTS), "level") == ["error"]
    with pytest.raises(ValueError, match="after its end"):
        build_warehouse(wh, SHOPS, since=date(2026, 9, 18), now=NOW)


def test_two_writers_cannot_both_replace_a_table(spark, wh):
    rows = spark.createDataFrame([(1, 1, "p", "n", "active", date(2026, 1, 1), None, 1)], wh.read("dw.dim_shop").schema)
    wh.replace("dw.dim_shop", rows)
    late = Warehouse(spark, wh.root)
    stale = late._pointer("dw.dim_shop")
    wh.replace("dw.dim_shop", rows)
    late._pointer = lambda name: stale
    with pytest.raises(ConcurrentWrite):
        late.replace("dw.dim_shop", rows)
    assert wh.read("dw.dim_shop").count() == 1
    wh.replace("dw.dim_shop", rows)
    assert wh.expire("dw.dim_shop", keep=1) >= 1 and wh.read("dw.dim_shop").count() == 1


def test_monitor_scans_the_last_hours(spark, wh):
    seed(wh, [order(1, updated=NOW - timedelta(hours=2)), order(2, updated=NOW - timedelta(days=3), buyer_nick=None)])
    rules = [
        Rule("dw.ods_orders", "range", {"column": "order_amount_cents", "min": 0, "max": 1000}, "warn"),
        Rule("dw.ods_orders", "row_count_delta", {"max_deviation": 0.5}, "warn"),
        Rule("dw.ods_order_items", "range", {"column": "quantity", "min": 1, "max": 10}, "warn"),
    ]
    state.sync_rules(wh, rules, NOW)
    result = state.run_task(wh, "dq_monitor", "dq_scan", lambda: monitor.scan_quality(wh, SHOPS, now=NOW))
    assert (result.checks, result.warned, result.blocked) == (3, 1, 0)
    state.sync_rules(wh, [Rule("dw.ods_order_items", "unique", {"columns": ["product_name"]}, "block")], NOW)
    with pytest.raises(monitor.ScanBlocked):
        state.run_task(wh, "dq_monitor", "dq_scan", lambda: monitor.scan_quality(wh, SHOPS, now=NOW))
    assert column(wh.read_log(state.TASKS), "status") == ["failed", "success"]
    assert monitor.row_counts(wh, ["dw.ods_orders"]).first().row_cnt == 2
