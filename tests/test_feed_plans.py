"""Plans of the feed steps: every text parsed once, no method too long for the JVM's compiler."""

from __future__ import annotations

import json
import re
from datetime import datetime

from feed_messages import item, messages, order
from pyspark.sql import functions as F

from shopstrata.functions import to_cents
from shopstrata.operators import contracts, feed
from shopstrata.sources import sample

#: Bytes of a method beyond which the JVM interprets it for good.
COMPILED_BYTES = 8000


def _said(spark, df, mode: str) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def _mapped(spark, *rows):
    return feed.map_messages(feed.newest_messages(feed.message_keys(messages(spark, rows))), "b")


def test_keys_of_messages_make_methods_that_are_compiled(spark):
    keyed = feed.message_keys(messages(spark, [order(1)])).where("message_time IS NULL OR message_time > '2026-01-01'")
    for df in (keyed, feed.newest_messages(keyed)):
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(-?\d+)", _said(spark, df, "codegen"))]
        assert all(0 <= n < COMPILED_BYTES for n in sizes), sizes


def test_texts_are_parsed_once(spark):
    mapped = _mapped(spark, order(1))
    marked = feed.mark_messages(mapped)
    shapes = {
        "mapped orders": feed.mapped_orders(mapped), "mapped items": feed.mapped_items(mapped),
        "accepted orders": feed.accepted_orders(marked), "accepted items": feed.accepted_items(marked),
    }
    for name, df in shapes.items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        # keys, order and, where asked for, items
        assert plan.count("from_json(") == (3 if "items" in name else 2), name
        assert not re.search(r"Filter [^\n]*(from_json|RLIKE|order_error|item_error)", plan), name


def test_rows_of_readable_and_unreadable_messages(spark):
    mapped = _mapped(
        spark, order(1, items=[item("a", "P1"), item("b", "P2")]), order(2, order_amount="abc"), order(3, items=[]),
        order(4, items=[item("c", "P3", price="free"), item("d", "P4")]), order(5, updated_at="never"), "no message",
        order(6, drop=("items",)), order(7, items=None),
    )
    assert sorted(r.order_id for r in feed.mapped_orders(mapped).collect()) == ["C0001", "C0003", "C0004", "C0006", "C0007"]
    assert sorted((r.order_id, r.item_id) for r in feed.mapped_items(mapped).collect()) == [
        ("C0001", "a"), ("C0001", "b"), ("C0002", "201"),
    ]
    marked = feed.mark_messages(mapped)
    assert sorted(r.order_id for r in feed.accepted_orders(marked).collect()) == ["C0001", "C0003", "C0004", "C0006", "C0007"]


def test_reasons_are_written_only_where_something_is_set_aside(spark):
    plan = feed.mark_messages(_mapped(spark, order(1)))._jdf.queryExecution().optimizedPlan().toString()
    judged = [line for line in plan.splitlines() if re.search(r"AS judged#", line)]
    assert judged and all(re.search(r"CASE WHEN some#\d+ THEN transform\(", line) for line in judged)


def test_messages_with_and_without_something_to_set_aside(spark):
    mapped = _mapped(
        spark, order(1, items=[item("a", "P1"), item("b", "P2", quantity=0), item("c", "P3", price="-1.00")]),
        order(2), order(3, order_amount="-5.00"), order(4, items=[item("", "P1")]), order(5, items=[]),
    )
    marked = feed.mark_messages(mapped)
    assert sorted((r.order_id, r.item_id) for r in feed.accepted_items(marked).collect()) == [("C0001", "a"), ("C0002", "201")]
    letters = feed.letters_of(marked).select(
        F.get_json_object("raw_row", "$.order_id"), F.get_json_object("raw_row", "$.item_id"), "error_type", "error_msg"
    )
    assert sorted(map(tuple, letters.collect()), key=str) == sorted([
        ("C0001", "b", "schema_mismatch", "quantity: more than 0, got 0"),
        ("C0001", "c", "schema_mismatch", "price_cents: at least 0, got -100"),
        ("C0003", None, "schema_mismatch", "order_amount_cents: at least 0, got -500"),
        ("C0003", "301", "parent_rejected", "order rejected: order_amount_cents: at least 0, got -500"),
        ("C0004", "", "schema_mismatch", "item_id: at least 1 character, got "),
    ], key=str)


def test_a_broken_contract_is_known_without_its_messages(spark):
    rows = spark.createDataFrame(
        [("a", 1), ("", 1), (None, 1), ("a", 0), ("a", None), (None, None), ("a", 7)], "name string, n int"
    )
    checks = (
        contracts.Check("name", "some", lambda c: F.length(c) > 0),
        contracts.Check("n", "more than 0, 7 unknown", lambda c: F.when(c != 7, c > 0)),
    )
    for columns in (["name", "n"], ["name"], ["name", "n", "more"]):
        both = rows.withColumn("more", F.lit(1)).select(
            contracts.contract_errors(columns, checks).isNotNull(), contracts.breaks_contract(columns, checks)
        ).collect()
        assert all(told == known for told, known in both), columns


def test_plain_amounts_and_quantities_are_read_like_all_others(spark):
    texts = ["12.34", "0.05", "00.50", "12.34\n", " 12.34", "+1.00", "-1.00", "12.345", "12.3", "1e2", ".50", "1.", "",
             "1234567890123456.78", "12345678901234567.89", "abc", "1,00", "\u0661.\u0661\u0661", None]
    amounts = spark.createDataFrame([(t,) for t in texts], "t string")
    exact = (F.bround(F.col("t").try_cast("decimal(38,18)"), 2) * 100).try_cast("bigint")
    assert all(a == b for a, b in amounts.select(to_cents(F.col("t")), exact).collect())
    asked = [(3, 3), ("4", 4), (2.7, 2), ("2.7", None), (" 5 ", 5), ("", 0), (None, 0), (-1, -1), (999999999, 999999999),
             (2147483647, 2147483647), (2147483648, None), ("007", 7), ("6\n", 6)]
    mapped = _mapped(spark, *[order(i, items=[item("a", "P", quantity=q)]) for i, (q, _) in enumerate(asked)])
    got = mapped.select("order_row.order_id", F.col("item_rows")[0]["quantity"]).collect()
    assert [q for _, q in sorted(map(tuple, got))] == [want for _, want in asked]


def _tables(spark, path):
    """Two shops; order 1 with a repeated item, 317 and 337 with faults, 3 without items."""
    day = datetime(2000, 1, 1)
    rows = {
        "nation": ([(1, 0), (2, 1)], "n_nationkey int, n_regionkey int"),
        "customer": ([(1, "one", 1), (2, "two", 2)], "c_custkey long, c_name string, c_nationkey int"),
        "part": ([(1, "nut"), (2, "bolt")], "p_partkey long, p_name string"),
        "orders": (
            [(k, k % 2 + 1, "O", 10.0, day, "5-LOW") for k in (1, 2, 3, 317, 337)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        ),
        "lineitem": (
            [(1, 1, 2, 5.0, 1.5, "N", day), (1, 2, 1, 6.0, 2.5, "N", day), (1, 2, 2, 7.0, 3.5, "N", day.replace(day=2)),
             (2, 1, 1, 1.0, 1.0, "R", day), (317, 1, 1, 2.0, 1.0, "R", day), (317, 1, 2, 3.0, 1.0, "R", day), (337, 1, 1, 4.0, 1.0, "R", day)],
            "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
        ),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_items_of_the_sample_feed_are_dealt_once_and_listed_without_an_aggregation(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent = sample.feed_messages(spark, _tables(spark, tmp_path))
        plan = sent._jdf.queryExecution().executedPlan().toString()
        found = [json.loads(r.value) for r in sent.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert "REPARTITION" not in plan and plan.count("Exchange hashpartitioning(l_orderkey") == 1
    items = {m["order_id"]: [(x["item_id"], x["product_id"], x["quantity"], x["price"]) for x in m.get("items", [])] for m in found}
    assert items == {
        "1": [("1", "P00002", 6, "2.50"), ("2", "P00002", 7, "3.50")], "2": [("1", "P00001", 1, "1.00")], "3": [],
        "317": [("1", "P00001", 0, "1.00"), ("2", "P00001", 3, "1.00")], "337": [("1", "P00001", 4, "free")],
    }
