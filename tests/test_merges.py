"""Small merges as deltas, the key index, appends of many writers, days that orders leave."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest
from feed_messages import column
from pyspark.sql import functions as F

from shopstrata.functions import wall
from shopstrata.operators.compare import table_diff
from shopstrata.operators.merge import merge_monotonic
from shopstrata.plans import state, upsert
from shopstrata.schemas import TABLES, conform
from shopstrata.sources import tables
from shopstrata.sources.tables import Warehouse

ORDERS = "dw.ods_orders"


def rows_of(spark, rows):
    """Orders as (id, created, updated, amount); months are what they are filed by."""
    given = [(1, f"C{i:05d}", "canned", "paid", a, c, u) for i, c, u, a in rows]
    df = spark.createDataFrame(
        given, "shop_id long, order_id string, platform string, order_status string, order_amount_cents long, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    )
    return conform(df, TABLES[ORDERS].schema)


def year(spark, n=1200):
    return rows_of(spark, [(i, datetime(2026, 1 + i % 9, 1 + i % 28), datetime(2026, 9, 30), i) for i in range(n)])


def plan_files(df):
    return sorted({f.split("/dw/ods_orders/")[-1].rsplit("/", 1)[0] for f in df.inputFiles() if "/dw/ods_orders/" in f})


CHANGES = [
    (5, datetime(2026, 6, 6), datetime(2026, 10, 1), 111),  # a newer version, same period
    (6, datetime(2026, 2, 3), datetime(2026, 10, 1), 222),  # moves to another period
    (7, datetime(2026, 8, 8), datetime(2026, 9, 1), 333),  # older than what is stored
    (5000, datetime(2026, 3, 1), datetime(2026, 10, 1), 444),  # new
    (5001, datetime(2026, 12, 1), datetime(2026, 10, 1), 555),  # new, in a period of its own
    (5, datetime(2026, 7, 6), datetime(2026, 9, 30, 12), 666),  # a repeat that is older
]


def test_a_small_merge_adds_a_delta_and_reads_like_a_rewrite(spark, wh):
    upsert.upsert(wh, ORDERS, year(spark))
    before = wh.version(ORDERS).parts
    want = merge_monotonic(wh.stage(wh.read(ORDERS), "old").df, rows_of(spark, CHANGES), TABLES[ORDERS].key)
    counts = upsert.upsert(wh, ORDERS, rows_of(spark, CHANGES))
    assert (counts.inserted, counts.updated, counts.ignored, counts.kept) == (2, 2, 1, 0)
    after = wh.version(ORDERS)
    assert {p: x.base for p, x in after.parts.items() if p in before} == {p: x.base for p, x in before.items()}
    assert [p for p, x in after.parts.items() if x.deltas] == ["2026-02", "2026-03", "2026-06", "2026-07"]
    assert table_diff(wh.read(ORDERS), want).isEmpty() and wh.read(ORDERS).count() == 1202
    # one period alone shows neither the row that left it nor an old version
    july = wh.read_parts(ORDERS, ["2026-07"])
    assert july.where("order_id = 'C00006'").isEmpty() and not july.isEmpty()
    # back again, and the index knows the last place
    back = [(6, datetime(2026, 7, 3), datetime(2026, 10, 2), 777), (5000, datetime(2026, 3, 1), datetime(2026, 10, 2), 888)]
    want = merge_monotonic(wh.stage(wh.read(ORDERS), "old").df, rows_of(spark, back), TABLES[ORDERS].key)
    assert upsert.upsert(wh, ORDERS, rows_of(spark, back)).updated == 2
    assert table_diff(wh.read(ORDERS), want).isEmpty()
    held = wh.stage(wh.read(ORDERS), "held").df
    assert wh.compact(ORDERS, ["2026-07"]) == ["2026-07"]
    assert table_diff(wh.read(ORDERS), held).isEmpty()
    wh.compact(ORDERS)
    at = wh.version(ORDERS)
    assert not any(x.deltas for x in at.parts.values()) and all(len(x) == 1 for x in at.index.layers.values())
    assert table_diff(wh.read(ORDERS), held).isEmpty()
    assert upsert.upsert(wh, ORDERS, rows_of(spark, back)).ignored == 2  # the index still knows
    assert wh.expire(ORDERS, keep=1) > 0 and table_diff(wh.read(ORDERS), held).isEmpty()


def test_a_small_merge_reads_index_buckets_and_no_period(spark, wh):
    upsert.upsert(wh, ORDERS, year(spark))
    at = wh.index(ORDERS, wh.version(ORDERS))
    spec = TABLES[ORDERS]
    rows = rows_of(spark, CHANGES[:2]).withColumn("_bucket", wh.bucket(spec, at.index.buckets))
    sizes = {r["_bucket"]: r["count"] for r in rows.groupBy("_bucket").count().collect()}
    changes, _ = upsert.planned_delta(wh, ORDERS, rows.drop("_bucket"), sizes, False, at)
    files = plan_files(changes)
    assert at.index.buckets == 16 and 1 <= len(sizes) <= 2
    assert [f.rsplit("bucket=")[-1] for f in files] == [str(b) for b in sorted(sizes)] and all("_index/" in f for f in files)


def test_deltas_are_made_a_base_when_they_grow(spark, wh, monkeypatch):
    monkeypatch.setattr(tables, "MOST_DELTAS", 2)
    upsert.upsert(wh, ORDERS, year(spark))
    for n in range(4):
        upsert.upsert(wh, ORDERS, rows_of(spark, [(1, datetime(2026, 2, 2), datetime(2026, 10, 1 + n), n)]))
    part = wh.version(ORDERS).parts["2026-02"]
    assert len(part.deltas) == 1 and wh.read(ORDERS).where("order_id = 'C00001'").first().order_amount_cents == 3
    assert wh.read(ORDERS).count() == 1200


def test_a_delta_that_was_overtaken_is_decided_again(spark, wh, monkeypatch):
    upsert.upsert(wh, ORDERS, year(spark))
    once, put = [], wh.put_delta

    def overtaken(name, changes, at, before=None):
        if not once:
            once.append(name)
            upsert.upsert(wh, ORDERS, rows_of(spark, [(3, datetime(2026, 4, 4), datetime(2026, 10, 5), 99)]))
        return put(name, changes, at, before)

    monkeypatch.setattr(wh, "put_delta", overtaken)
    counts = upsert.upsert(wh, ORDERS, rows_of(spark, [(3, datetime(2026, 4, 4), datetime(2026, 10, 4), 1)]))
    assert counts.ignored == 1 and wh.read(ORDERS).where("order_id = 'C00003'").first().order_amount_cents == 99


# ---- appends ------------------------------------------------------------------------------


def alerts_of(spark, first, n=1):
    return spark.range(first, first + n).select(
        F.col("id").cast("string").alias("title"), wall(datetime(2026, 9, 1)).alias("created_at")
    )


def test_appends_of_many_writers_lose_nothing(spark, wh):
    def write(writer: int) -> None:
        own = Warehouse(spark, wh.root)
        for n in range(6):
            own.append(state.ALERTS, alerts_of(spark, 10 * writer + n))

    with ThreadPoolExecutor(5) as pool:
        writers = [pool.submit(write, w) for w in range(4)]
        merges = pool.submit(lambda: [wh.merge_log(state.ALERTS) for _ in range(3)])
        for done in (*writers, merges):
            done.result()
    want = sorted(str(10 * w + n) for w in range(4) for n in range(6))
    assert column(wh.read_log(state.ALERTS), "title") == want
    wh.merge_log(state.ALERTS)
    assert wh.entries(state.ALERTS).appends == {} and wh.expire(state.ALERTS) > 0
    assert column(wh.read_log(state.ALERTS), "title") == want


def test_a_named_append_happens_once(spark, wh):
    assert wh.append(state.ALERTS, alerts_of(spark, 1), once="stream-1")
    assert not wh.append(state.ALERTS, alerts_of(spark, 1), once="stream-1")
    wh.merge_log(state.ALERTS)
    wh.expire(state.ALERTS)
    assert not wh.append(state.ALERTS, alerts_of(spark, 1), once="stream-1")
    assert wh.read_log(state.ALERTS).count() == 1


def test_an_append_that_fails_leaves_nothing(spark, wh):
    wh.append(state.ALERTS, alerts_of(spark, 1))
    broken = alerts_of(spark, 2, 50).withColumn("text", F.when(F.col("title") == "30", F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        wh.append(state.ALERTS, broken)
    assert column(wh.read_log(state.ALERTS), "title") == ["1"]


def test_only_the_wanted_periods_of_a_log_are_listed(spark, wh):
    old = alerts_of(spark, 1).withColumn("created_at", wall(datetime(2026, 7, 1)))
    wh.append(state.ALERTS, old)
    wh.append(state.ALERTS, alerts_of(spark, 2))
    assert column(wh.read_log(state.ALERTS, since=date(2026, 9, 1)), "title") == ["2"]
    assert len(wh.read_log(state.ALERTS, since=date(2026, 9, 1)).inputFiles()) == 1
