"""Writers that come between each other, versions, and keys of any length."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from feed_messages import NOW_SHOP, column, messages, order

from shopstrata.operators import feed
from shopstrata.plans import build, state
from shopstrata.plans.ingest import ingest_batch
from shopstrata.plans.upsert import upsert
from shopstrata.sources import sample
from shopstrata.sources.tables import ConcurrentWrite

NOW = datetime(2026, 9, 2)


def orders(spark, rows):
    keyed = feed.message_keys(messages(spark, rows))
    return feed.accepted_orders(feed.mark_messages(feed.map_messages(feed.newest_messages(keyed), "b")))


def test_a_merge_that_was_overtaken_is_done_again(spark, wh, monkeypatch):
    upsert(wh, "dw.ods_orders", orders(spark, [order(1)]))
    once, replace = [], wh.replace

    def overtaken(name, df, parts=None, **given):
        if not once:
            once.append(name)
            upsert(wh, "dw.ods_orders", orders(spark, [order(2)]))
        replace(name, df, parts, **given)

    monkeypatch.setattr(wh, "replace", overtaken)
    upsert(wh, "dw.ods_orders", orders(spark, [order(3)]))
    assert column(wh.read("dw.ods_orders"), "order_id") == ["C0001", "C0002", "C0003"]


def test_a_write_from_an_old_version_is_refused(spark, wh):
    upsert(wh, "dw.ods_orders", orders(spark, [order(1)]))
    at = wh.version("dw.ods_orders")
    upsert(wh, "dw.ods_orders", orders(spark, [order(2)]))
    with pytest.raises(ConcurrentWrite):
        wh.replace("dw.ods_orders", wh.read_at("dw.ods_orders", at), at=at)
    assert wh.read("dw.ods_orders").count() == 2


def test_expire_keeps_what_is_being_written(spark, wh):
    for n in range(4):
        upsert(wh, "dw.ods_orders", orders(spark, [order(n)]))
    name = wh._dir("dw.ods_orders")
    spark.range(1).write.parquet(f"{name}/snap=1000005-000000001/part=2026-09")
    assert wh.expire("dw.ods_orders", keep=1) == 3
    assert "snap=1000005-000000001" in wh._files.names(name) and wh.read("dw.ods_orders").count() == 4


def test_product_ids_are_never_cut(spark):
    rows = spark.createDataFrame([(7,), (12345,), (1234567,)], "part long")
    assert column(rows.select(sample.product_id(rows.part).alias("p")), "p") == ["P00007", "P12345", "P1234567"]


def test_one_extreme_value_does_not_stop_the_build(spark, wh):
    days = [("1", "0.01", 1), ("2", "20000.00", 2)]
    rows = [
        order(n, updated=datetime(2026, 9, d, 10), order_amount=amount, payment_amount=amount)
        for n, (_, amount, d) in enumerate(days)
    ]
    ingest_batch(wh, messages(spark, rows), now=datetime(2026, 9, 3))
    build.build_warehouse(wh, NOW_SHOP, since=date(2026, 9, 1), now=datetime(2026, 9, 3))
    report = {str(r.stat_date): r for r in wh.read("dw.ads_shop_overview").collect()}
    assert report["2026-09-02"].gmv_cents == 2_000_000 and report["2026-09-02"].gmv_dod_pct is None
    assert any("out of range" in t for t in column(wh.read_log(state.ALERTS), "title"))
