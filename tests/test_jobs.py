"""Backfill, metrics, charts and the command line over stored tables."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

from feed_messages import column, messages, order

from shopstrata.__main__ import main
from shopstrata.operators.charts import CHARTS
from shopstrata.operators.compare import table_diff
from shopstrata.plans import reporting, state
from shopstrata.plans.backfill import backfill
from shopstrata.plans.build import build_warehouse
from shopstrata.plans.ingest import ingest_batch
from shopstrata.sources.tables import Warehouse

NOW = datetime(2026, 9, 17, 10)
SHOPS = [{"shop_id": n, "platform": "canned", "shop_name": f"shop {n}", "status": "active"} for n in (1, 2)]


def test_backfill_equals_the_live_runs(spark, wh, tmp_path):
    t = datetime(2026, 9, 15, 8)
    feed = [order(n, shop_id=1 + n % 2, updated=t + timedelta(hours=n)) for n in range(8)]
    for n in (4, 8):  # two live runs, the second with a correction
        ingest_batch(wh, messages(spark, feed[:n]), now=t + timedelta(hours=n))
    build_warehouse(wh, SHOPS, since=date(2026, 9, 15), now=NOW)
    mark = wh.read(state.WATERMARKS).collect()

    other = Warehouse(spark, str(tmp_path / "other"), grain="day")
    result = backfill(other, messages(spark, feed), SHOPS, start=datetime(2026, 9, 15), end=datetime(2026, 9, 16), now=NOW)
    assert result.ingest.watermarks_moved == 0 and result.build.since == date(2026, 9, 15)
    for name in ("dw.ods_orders", "dw.dws_shop_daily", "dw.ads_shop_overview", "dw.ads_daily_kpi"):
        assert table_diff(wh.read(name), other.read(name), ignore=["etl_batch_id"]).isEmpty(), name
    backfill(wh, messages(spark, feed), SHOPS, start=datetime(2026, 9, 15), end=datetime(2026, 9, 16), now=NOW)
    assert wh.read(state.WATERMARKS).collect() == mark
    assert table_diff(wh.read("dw.ads_daily_kpi"), other.read("dw.ads_daily_kpi")).isEmpty()

    metrics = {r.metric for r in reporting.pipeline_metrics(wh, NOW).collect()}
    assert {"etl_batch_success_rate", "etl_dq_failures_total", "etl_watermark_age_minutes"} <= metrics
    for name in CHARTS:
        assert reporting.chart(wh, name).count() > 0, name


def test_command_line(spark, tmp_path, capsys):
    root = str(tmp_path / "warehouse")
    feed = tmp_path / "feed" / "platform=canned"
    feed.mkdir(parents=True)
    (feed / "a.json").write_text("".join(json.dumps(order(n, updated=NOW - timedelta(hours=3))) + "\n" for n in range(3)))
    (tmp_path / "shops.json").write_text(json.dumps({"shops": SHOPS}))
    rule = {"table_name": "dw.ods_orders", "rule_type": "unique", "params": {"columns": ["shop_id", "order_id"]}, "severity": "block"}
    (tmp_path / "rules.json").write_text(json.dumps([rule]))

    def call(*args):
        main(["--root", root, "--now", NOW.isoformat(), *args])
        return capsys.readouterr().out

    assert "'inserted': 1" in call("sync-rules", "--rules", str(tmp_path / "rules.json"))
    assert "inserted=3" in call("ingest", "--feed", str(tmp_path / "feed"), "--shops", str(tmp_path / "shops.json"))
    assert "shop_versions_added=2" in call("build", "--shops", str(tmp_path / "shops.json"))
    assert "checks=1" in call("scan", "--shops", str(tmp_path / "shops.json"))
    assert "3702" in call("chart", "gmv_total")
    assert "etl_task_duration_ms_p95" in call("metrics")
    assert ": 3}" in call("counts", "dw.ods_orders")
    assert column(Warehouse(spark, root).read_log(state.TASKS), "dag_id") == ["build", "ingest", "scan"]
