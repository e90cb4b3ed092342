"""The ingest job: dead letters, gate, replay, watermarks, checks."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from feed_messages import column, item, messages, order

from shopstrata.operators.quality import Rule
from shopstrata.operators.windows import TimeWindow
from shopstrata.plans import reporting, state
from shopstrata.plans.ingest import DataBlocked, DeadLetterLimitExceeded, IngestSettings, ingest_batch, ingest_directory
from shopstrata.sources import landing

NOW = datetime(2026, 9, 2)
OPEN = IngestSettings(dead_letter_limit=0.0)
SHOP = (1, "canned")


def watermark(wh):
    rows = wh.read(state.WATERMARKS).where("shop_id = 1").collect()
    return rows[0].watermark_value if rows else None


def last_status(wh):
    return {(r.shop_id, r.platform): r.status for r in state.ledger(wh).collect()}


def test_bad_rows_become_dead_letters_and_the_batch_goes_on(spark, wh):
    rows = [order(i) for i in range(10)]
    rows += [order(99, order_amount="abc"), order(100, drop=("order_id",))]
    result = ingest_batch(wh, messages(spark, rows), now=NOW, settings=OPEN)
    # an unreadable amount, and a missing id on the order and on the item side
    assert (result.rows_read, result.dead_letters) == (12, 3)
    assert result.orders.inserted == 10 and result.items.inserted == 10
    assert result.watermarks_moved == 1 and watermark(wh) == NOW - timedelta(minutes=5)
    letters = wh.read_log(state.ERRORS).collect()
    assert sorted(x.error_type for x in letters) == ["mapper_error"] * 3 + ["parent_rejected"]
    assert any("invalid value abc" in x.error_msg for x in letters)
    assert any("buyer-100" in x.raw_row for x in letters)
    assert last_status(wh) == {SHOP: "success"}


def test_contract_failure_is_set_aside(spark, wh):
    rows = [order(0), order(1), order(3, order_amount="-5.00")]
    result = ingest_batch(wh, messages(spark, rows), now=NOW, settings=OPEN)
    assert result.dead_letters == 1 and column(wh.read("dw.ods_orders"), "order_id") == ["C0000", "C0001"]
    letter = wh.read_log(state.ERRORS).where("error_type = 'schema_mismatch'").collect()[0]
    assert "order_amount_cents" in letter.error_msg and "C0003" in letter.raw_row
    assert column(wh.read("dw.ods_order_items"), "order_id") == ["C0000", "C0001"]  # no orphans


def test_rate_over_the_limit_writes_nothing_and_keeps_the_watermark(spark, wh):
    rows = [order(i) for i in range(10)] + [order(100 + i, order_amount="abc") for i in range(3)]
    with pytest.raises(DeadLetterLimitExceeded):
        ingest_batch(wh, messages(spark, rows), now=NOW, settings=IngestSettings(dead_letter_limit=0.1))
    assert wh.read("dw.ods_orders").count() == 0 and watermark(wh) is None
    assert last_status(wh) == {SHOP: "failed"}
    assert column(wh.read_log(state.ALERTS), "level") == ["error"]


def test_a_shop_over_the_limit_does_not_hold_up_the_others(spark, wh):
    rows = [order(i) for i in range(5)] + [order(100 + i, shop_id=2, order_amount="abc") for i in range(2)]
    with pytest.raises(DeadLetterLimitExceeded) as failure:
        ingest_batch(wh, messages(spark, rows), now=NOW)
    assert failure.value.result.orders.inserted == 5 and failure.value.result.shops_over_limit == 1
    assert last_status(wh) == {SHOP: "success", (2, "canned"): "failed"}
    assert column(wh.read(state.WATERMARKS), "shop_id") == [1]


def test_rerun_changes_nothing_and_repeats_are_dropped(spark, wh):
    t = datetime(2026, 9, 1, 23, 30)
    rows = [order(i, updated=t) for i in range(4)] + [order(0, updated=t), order(1, updated=t + timedelta(minutes=5), status="shipped")]
    first = ingest_batch(wh, messages(spark, rows), now=NOW)
    assert (first.rows_read, first.orders.inserted) == (6, 4)
    before = wh.read("dw.ods_orders").drop("etl_batch_id").collect()
    again = ingest_batch(wh, messages(spark, rows), now=NOW)  # the overlap is read again
    assert again.rows_read == 6 and again.orders.written == 0 and again.orders.ignored == 4
    assert again.watermarks_moved == 0
    assert sorted(wh.read("dw.ods_orders").drop("etl_batch_id").collect()) == sorted(before)
    assert wh.read("dw.ods_orders").where("order_id = 'C0001'").first().order_status == "shipped"


def test_late_rows_never_replace_newer_ones(spark, wh):
    t = datetime(2026, 9, 1, 10)
    ingest_batch(wh, messages(spark, [order(1, updated=t, status="completed")]), now=NOW)
    window = TimeWindow(datetime(2026, 8, 1), NOW)
    late = [order(1, updated=t - timedelta(hours=3), status="paid")]
    result = ingest_batch(wh, messages(spark, late), now=NOW, run_type="backfill", window=window)
    assert result.orders.ignored == 1 and result.watermarks_moved == 0
    assert wh.read("dw.ods_orders").first().order_status == "completed"


def test_an_order_that_changes_its_month_is_not_duplicated(spark, wh):
    ingest_batch(wh, messages(spark, [order(1, updated=datetime(2026, 8, 31, 10)), order(2, updated=datetime(2026, 8, 31, 11))]), now=NOW)
    moved = order(1, updated=datetime(2026, 9, 1, 23, 50), created_at="2026-09-01T00:00:00")
    result = ingest_batch(wh, messages(spark, [moved]), now=NOW, run_type="full")
    assert result.orders.updated == 1
    assert column(wh.read("dw.ods_orders"), "order_id") == ["C0001", "C0002"]
    assert wh.parts("dw.ods_orders") == ["2026-08", "2026-09"]


def test_window_is_half_open_and_starts_an_hour_before_the_watermark(spark, wh):
    ingest_batch(wh, messages(spark, [order(0)]), now=NOW)
    mark = NOW - timedelta(minutes=5)
    later = NOW + timedelta(hours=1)
    rows = [
        order(1, updated=mark - timedelta(hours=1)), order(2, updated=mark - timedelta(hours=1, seconds=1)),
        order(3, updated=later - timedelta(minutes=5)), order(4, updated=later - timedelta(minutes=5, seconds=1)),
    ]
    ingest_batch(wh, messages(spark, rows), now=later)
    assert column(wh.read("dw.ods_orders"), "order_id") == ["C0000", "C0001", "C0004"]


def test_one_bad_item_rejects_the_items_but_not_the_order(spark, wh):
    rows = [
        order(1, items=[item("a", "P1"), item("b", "P2", price="free")]),
        order(2, items=[item("c", "P1", quantity=0), item("d", "P2")]),
        order(3, items=None),
    ]
    result = ingest_batch(wh, messages(spark, rows), now=NOW, settings=OPEN)
    assert column(wh.read("dw.ods_orders"), "order_id") == ["C0001", "C0002", "C0003"]
    assert column(wh.read("dw.ods_order_items"), "item_id") == ["d"]
    kinds = [(x.table_name, x.error_type) for x in wh.read_log(state.ERRORS).collect()]
    assert sorted(kinds) == [("dw.ods_order_items", "mapper_error"), ("dw.ods_order_items", "schema_mismatch")]
    assert result.dead_letters == 2


def test_raw_text_is_kept(spark, wh):
    text = '{"shop_id": 1, "order_id": "x", "order_amount": "1", "payment_amount": 2.5, "created_at": "2026-09-01", ' \
           '"updated_at": "2026-09-01T02:00:00Z", "extra": {"b": 1}, "items": [{"item_id": 7, "price": 1.5, "tag": "t"}]}'
    ingest_batch(wh, messages(spark, [text]), now=NOW, settings=OPEN)
    row = wh.read("dw.ods_orders").first()
    assert row.raw_json == text and row.payment_amount_cents == 250 and row.updated_at == datetime(2026, 9, 1, 10)
    letter = wh.read_log(state.ERRORS).first()  # quantity 0 breaks the contract, its text is kept
    assert '\\"tag\\":\\"t\\"' in letter.raw_row


def test_unreadable_text_counts_against_the_whole_batch(spark, wh):
    with pytest.raises(DeadLetterLimitExceeded) as failure:
        ingest_batch(wh, messages(spark, [order(1), "not json"]), now=NOW)
    assert failure.value.result.orders.inserted == 1  # the shops themselves are not held up
    assert "error" in column(wh.read_log(state.ALERTS), "level")
    rows = messages(spark, [order(2), "no json either"])
    result = ingest_batch(wh, rows, now=NOW, run_type="full", settings=IngestSettings(dead_letter_limit=1.5))
    assert result.orders.inserted == 1


def test_an_untimed_message_counts_once(spark, wh):
    bad = order(99, updated_at="some day")
    with pytest.raises(DeadLetterLimitExceeded):
        ingest_batch(wh, messages(spark, [order(i) for i in range(4)] + [bad]), now=NOW)
    again = ingest_batch(wh, messages(spark, [order(i) for i in range(6)] + [bad]), now=NOW)
    assert (again.dead_letters, again.orders.inserted, again.watermarks_moved) == (0, 6, 1)
    assert wh.read_log(state.ERRORS).where("error_type = 'mapper_error'").select("raw_row").distinct().count() == 1


def test_pruning_waits_for_shops_without_a_watermark(spark, wh):
    rows = [order(i) for i in range(5)] + [order(50, shop_id=2, order_amount="abc")]
    with pytest.raises(DeadLetterLimitExceeded):
        ingest_batch(wh, messages(spark, rows), now=NOW)
    assert state.oldest_needed(wh, "dw.ods_orders", timedelta(hours=1)) is None
    ingest_batch(wh, messages(spark, [order(51, shop_id=2)]), now=NOW)
    assert state.oldest_needed(wh, "dw.ods_orders", timedelta(hours=1)) == NOW - timedelta(hours=1, minutes=5)


RULES = [
    Rule("dw.ods_orders", "null_rate", {"column": "buyer_nick", "max_rate": 0.0}, "block"),
    Rule("dw.ods_orders", "unique", {"columns": ["order_id"]}, "block"),
    Rule("dw.ods_orders", "range", {"column": "order_amount_cents", "min": 0, "max": 2000}, "warn"),
    Rule("dw.ods_orders", "freshness", {"column": "updated_at", "max_age_minutes": 1440}, "block"),
    Rule("dw.ods_orders", "row_count_delta", {"max_deviation": 0.5, "lookback_batches": 5}, "warn"),
    Rule(
        "dw.ods_order_items", "referential",
        {"child_column": "order_id", "child_shop_column": "shop_id", "parent_table": "dw.ods_orders",
         "parent_column": "order_id", "parent_shop_column": "shop_id"},
        "block",
    ),
]


def test_all_rules_run_and_pass_on_a_clean_batch(spark, wh):
    assert state.sync_rules(wh, RULES, NOW) == {"inserted": 6, "skipped": 0}
    assert state.sync_rules(wh, [replace(r, severity="warn") for r in RULES], NOW) == {"inserted": 0, "skipped": 6}
    result = ingest_batch(wh, messages(spark, [order(i) for i in range(5)]), now=NOW)
    assert result.watermarks_moved == 1
    results = wh.read_log(state.RESULTS).collect()
    assert len(results) == 6 and all(r.passed == 1 for r in results)
    assert all(r.actual_value is not None and r.expected_value is not None for r in results)
    assert wh.read_log(state.ALERTS).count() == 0


def test_a_blocking_rule_keeps_the_watermark(spark, wh):
    state.sync_rules(wh, RULES, NOW)
    stale = [order(i, updated=datetime(2026, 8, 26, 10)) for i in range(5)]
    with pytest.raises(DataBlocked):
        ingest_batch(wh, messages(spark, stale), now=NOW)
    assert watermark(wh) is None and last_status(wh) == {SHOP: "failed"}
    assert wh.read("dw.ods_orders").count() == 5  # written before the check, merged again by the next run
    assert "error" in column(wh.read_log(state.ALERTS), "level")


def test_a_warning_does_not_block(spark, wh):
    state.sync_rules(wh, RULES, NOW)
    result = ingest_batch(wh, messages(spark, [order(1), order(2, order_amount="50.00")]), now=NOW)
    assert result.watermarks_moved == 1
    alerts = wh.read_log(state.ALERTS).collect()
    assert [a.level for a in alerts] == ["warning"] and "range" in alerts[0].text


def test_a_crash_leaves_the_watermark_and_the_rerun_converges(spark, wh, monkeypatch):
    rows = messages(spark, [order(i) for i in range(3)])
    with monkeypatch.context() as broken:
        broken.setattr("shopstrata.plans.ingest.state.advance", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest_batch(wh, rows, now=NOW)
    assert watermark(wh) is None and "failed" in last_status(wh).values()
    assert ingest_batch(wh, rows, now=NOW).watermarks_moved == 1
    assert wh.read("dw.ods_orders").count() == 3


def test_silent_registered_shops_advance_too(spark, wh):
    shops = spark.createDataFrame([(1, "canned"), (7, "canned")], "shop_id bigint, platform string")
    assert ingest_batch(wh, messages(spark, [order(1)]), now=NOW, shops=shops).watermarks_moved == 2
    assert column(wh.read(state.WATERMARKS), "shop_id") == [1, 7]


def test_a_fraction_in_text_is_no_quantity(spark, wh):
    lines = [item("a", "P1", quantity=2.7), item("b", "P1", quantity=" 3 "), item("c", "P1", quantity="4")]
    ingest_batch(wh, messages(spark, [order(1, items=lines)]), now=NOW)
    assert column(wh.read("dw.ods_order_items"), "quantity") == [2, 3, 4]
    bad = [order(2, items=[item("d", "P1", quantity="2.7")]), order(3, items=[item("e", "P1", quantity="1e1")])]
    with pytest.raises(DeadLetterLimitExceeded):
        ingest_batch(wh, messages(spark, bad), now=NOW, run_type="full")
    assert wh.read("dw.ods_order_items").count() == 3


# ---- a landing directory and its ledger of files --------------------------------------------


def put(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))


def test_a_second_run_reads_new_files_only(spark, wh, tmp_path, monkeypatch):
    feed_dir = tmp_path / "feed"
    day = feed_dir / "platform=canned"
    put(day, "a.json", [order(1, updated=NOW - timedelta(days=3)), order(2, updated=NOW - timedelta(days=2))])
    put(day, "b.json", [order(3, updated=NOW - timedelta(minutes=30)), order(4, updated=NOW - timedelta(minutes=2))])
    put(day, "odd.json", [order(5, updated_at="some day")])
    read, scan = [], landing.scan_files
    monkeypatch.setattr(
        landing, "scan_files", lambda s, p, files, **k: read.append(sorted(f.rsplit("/", 1)[1] for f in files)) or scan(s, p, files, **k)
    )
    lenient = IngestSettings(dead_letter_limit=0.9)
    first = ingest_directory(wh, str(feed_dir), now=NOW, settings=lenient)
    assert (first.orders.inserted, first.dead_letters) == (3, 2)  # an order and its items; order 4 is younger than the delay
    put(day, "c.json", [order(6, updated=NOW - timedelta(days=30)), order(7, updated=NOW)])
    second = ingest_directory(wh, str(feed_dir), now=NOW + timedelta(minutes=10), settings=lenient)
    # b may hold something for the window, a and odd do not; the message without a time was counted
    assert read == [["a.json", "b.json", "odd.json"], ["b.json", "c.json"]]
    assert (second.orders.inserted, second.dead_letters) == (2, 0)
    put(day, "a.json", [order(1, updated=NOW - timedelta(days=3)), order(8, updated=NOW + timedelta(minutes=11))])
    third = ingest_directory(wh, str(feed_dir), now=NOW + timedelta(minutes=20), settings=lenient)
    assert read[2] == ["a.json", "b.json", "c.json"] and third.orders.inserted == 1  # a has changed
    assert column(wh.read("dw.ods_orders"), "order_id") == ["C0001", "C0002", "C0003", "C0004", "C0007", "C0008"]
    files = {r.path.rsplit("/", 1)[1]: (r.messages, r.last_time) for r in state.feed_files(wh).collect()}
    assert files["odd.json"] == (1, None) and files["b.json"] == (2, NOW - timedelta(minutes=2))


def test_metrics_read_the_same_from_a_merged_ledger(spark, wh):
    for n in range(3):
        at = NOW + timedelta(hours=n)
        sent = [order(n, updated=at - timedelta(minutes=30)), order(50 + n, shop_id=2, updated=at - timedelta(minutes=30))]
        ingest_batch(wh, messages(spark, sent), now=at)
    late = NOW + timedelta(hours=3)
    before = [tuple(r) for r in reporting.pipeline_metrics(wh, late).orderBy("metric", "table_name", "shop_id").collect()]
    events = wh.read_log(state.BATCHES).count()
    assert state.BATCHES in state.tidy_logs(wh, 0) and wh.entries(state.BATCHES).appends == {}
    assert wh.read_log(state.BATCHES).count() < events
    after = [tuple(r) for r in reporting.pipeline_metrics(wh, late).orderBy("metric", "table_name", "shop_id").collect()]
    assert after == before
    ingest_batch(wh, messages(spark, [order(9, updated=late - timedelta(minutes=30))]), now=late)
    delays = {r.shop_id: r.value for r in reporting.pipeline_metrics(wh, late).where("metric = 'etl_batch_delay_minutes'").collect()}
    assert delays == {1: 5.0, 2: 65.0}
    listed = {f.split("part=")[1][:7] for f in wh.read_log(state.BATCHES, since=date(2026, 10, 1)).inputFiles()}
    assert listed == set()
