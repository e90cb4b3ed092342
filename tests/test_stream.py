"""The streaming ingest gives what batch runs give."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from feed_messages import column, messages, order

from shopstrata.operators.compare import table_diff
from shopstrata.plans import state
from shopstrata.plans.ingest import IngestSettings, ingest_batch
from shopstrata.sources.landing import scan_feed
from shopstrata.sources.tables import Warehouse
from shopstrata.streaming.order_stream import start_order_stream

NOW = datetime(2026, 9, 2)
OPEN = IngestSettings(dead_letter_limit=0.0)


def land(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps(r) + "\n" for r in rows), encoding="utf-8")


def run(wh, tmp_path, settings=OPEN):
    query = start_order_stream(
        wh, str(tmp_path / "landing"), str(tmp_path / "progress"), platform="canned", settings=settings,
        clock=lambda: NOW, max_files=1,
    )
    query.awaitTermination()
    assert query.exception() is None


def test_stream_equals_batch(spark, wh, tmp_path):
    t = datetime(2026, 9, 1, 10)
    first = [order(i, updated=t) for i in range(5)] + [order(9, order_amount="abc")]
    second = [order(1, updated=t + timedelta(hours=1), status="shipped"), order(2, updated=t - timedelta(days=40), status="cancelled")]
    land(tmp_path / "landing", "a", first)
    run(wh, tmp_path)
    land(tmp_path / "landing", "b", second)
    run(wh, tmp_path)  # continues after the first file; late and newer rows find their order

    other = Warehouse(spark, str(tmp_path / "batch"))
    ingest_batch(other, messages(spark, first + second), now=NOW, settings=OPEN, run_type="full")
    for name in ("dw.ods_orders", "dw.ods_order_items"):
        assert table_diff(wh.read(name), other.read(name), ignore=["etl_batch_id"]).isEmpty(), name
    assert wh.read(state.WATERMARKS).first().watermark_value == t + timedelta(hours=1)
    assert wh.read_log(state.ERRORS).where("error_type = 'mapper_error'").count() == 1


def test_a_stream_over_its_limits_loses_no_order(spark, wh, tmp_path):
    """A file is not read again, so good messages are stored even where the gate holds the watermark."""
    t = datetime(2026, 9, 1, 10)
    folder = tmp_path / "landing"
    land(folder, "a", [order(i, updated=t) for i in range(9)] + [order(9, order_amount="abc")])
    run(wh, tmp_path, IngestSettings())
    assert wh.read("dw.ods_orders").count() == 9 and wh.read(state.WATERMARKS).count() == 0
    good = [order(20 + i, shop_id=1 + i % 3, updated=t + timedelta(hours=1)) for i in range(9)]
    (folder / "b.json").write_text("not json\n" + "".join(json.dumps(r) + "\n" for r in good), encoding="utf-8")
    run(wh, tmp_path, IngestSettings())
    assert wh.read("dw.ods_orders").count() == 18 and column(wh.read(state.WATERMARKS), "shop_id") == [1, 2, 3]
    other = Warehouse(spark, str(tmp_path / "batch"))
    everything = [order(i, updated=t) for i in range(9)] + good
    ingest_batch(other, messages(spark, everything), now=NOW, settings=OPEN, run_type="full")
    for name in ("dw.ods_orders", "dw.ods_order_items"):
        assert table_diff(wh.read(name), other.read(name), ignore=["etl_batch_id"]).isEmpty(), name


def test_landing_scan_prunes_by_arrival(spark, tmp_path):
    root = tmp_path / "landing"
    land(root / "platform=alpha" / "arrived=2026-09-01" / "shop_id=1", "a", [order(1)])
    land(root / "platform=beta" / "arrived=2026-09-03" / "shop_id=2", "b", [order(2)])
    everything = scan_feed(spark, str(root)).collect()
    assert sorted((r.platform, r.source_shop_id) for r in everything) == [("alpha", 1), ("beta", 2)]
    late = scan_feed(spark, str(root), updated_since=datetime(2026, 9, 2))
    assert column(late, "platform") == ["beta"]
    assert "arrived" in late._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
