"""Data-quality rules: verdicts, scopes, configuration."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shopstrata.operators import quality
from shopstrata.operators.quality import Rule
from shopstrata.sources import config_files

NOW = datetime(2026, 9, 2)
ROWS = "shop_id bigint, order_id string, platform string, buyer_nick string, amount bigint, updated_at timestamp_ntz"


def rows(spark, *values):
    return spark.createDataFrame([(1, o, "p", b, a, t) for o, b, a, t in values], ROWS)


def windows(spark, *shops, start=datetime(2026, 8, 25), end=datetime(2026, 9, 1, 23, 55)):
    return spark.createDataFrame(
        [(s, "p", start, end) for s in shops or (1,)],
        "shop_id bigint, platform string, window_start timestamp_ntz, window_end timestamp_ntz",
    )


def check(df, *rules, **more):
    found = quality.run_checks({"t": df, **more.pop("tables", {})}, rules, now=NOW, **more).collect()
    return [(r.rule_type, r.shop_id, r.passed, r.actual_value) for r in found]


IN = datetime(2026, 9, 1)
OUT = datetime(2026, 9, 1, 23, 55)


def test_null_rate_counts_only_the_window_and_skips_empty_shops(spark):
    df = rows(spark, ("a", None, 1, IN), ("b", "x", 1, IN), ("c", None, 1, OUT))
    rule = Rule("t", "null_rate", {"column": "buyer_nick", "max_rate": 0.5})
    got = check(df, rule, windows=windows(spark, 1, 2))
    assert sorted(got, key=lambda x: x[1]) == [("null_rate", 1, 1, "0.5000"), ("null_rate", 2, 1, "-")]
    assert check(df, Rule("t", "null_rate", {"column": "buyer_nick", "max_rate": 0.5, "scope": "table"})) == [
        ("null_rate", None, 0, "0.6667")
    ]


def test_range_and_freshness(spark):
    df = rows(spark, ("a", "x", -5, IN), ("b", "x", 10, IN))
    span = {"windows": windows(spark)}
    assert check(df, Rule("t", "range", {"column": "amount", "min": -5, "max": 10}), **span)[0][2:] == (1, "[-5, 10]")
    assert check(df, Rule("t", "range", {"column": "amount", "min": 0, "max": 10}), **span)[0][2] == 0
    assert check(df, Rule("t", "freshness", {"max_age_minutes": 1440}), **span)[0][2:] == (1, "1440 minutes")
    assert check(df, Rule("t", "freshness", {"max_age_minutes": 1439}), **span)[0][2] == 0
    nulls = rows(spark, ("a", "x", None, IN))
    assert check(nulls, Rule("t", "range", {"column": "amount", "min": 0, "max": 1}), **span)[0][2:] == (1, "-")


def test_unique_treats_nulls_as_equal(spark):
    df = rows(spark, ("a", None, 1, IN), ("b", None, 1, IN), ("c", "x", 1, IN))
    assert check(df, Rule("t", "unique", {"columns": ["order_id"]}))[0][2] == 1
    assert check(df, Rule("t", "unique", {"columns": ["buyer_nick"]}))[0][2:] == (0, "1 duplicate groups")


def test_references(spark):
    child = rows(spark, ("a", "x", 1, IN), ("a", "x", 2, IN), ("zz", "x", 1, IN), (None, "x", 1, IN))
    parent = rows(spark, ("a", "x", 1, IN))
    rule = Rule("t", "referential", {"child_column": "order_id", "parent_table": "dw.p", "parent_column": "order_id"})
    assert check(child, rule, tables={"dw.p": parent})[0][2:] == (0, "2 orphan rows")
    paired = Rule("t", "referential", {**rule.params, "child_shop_column": "shop_id", "parent_shop_column": "shop_id"})
    other_shop = parent.withColumn("shop_id", F.lit(2).cast("bigint"))
    assert check(child, paired, tables={"dw.p": other_shop})[0][3] == "4 orphan rows"


def test_row_count_deviation(spark):
    ledger = spark.createDataFrame(
        [(f"b{n}", "t", 1, "p", "incremental", "success", 100, datetime(2026, 9, 1, n)) for n in range(3)],
        "batch_id string, table_name string, shop_id bigint, platform string, run_type string, status string, "
        "rows_read bigint, started_at timestamp_ntz",
    )
    rule = Rule("t", "row_count_delta", {"max_deviation": 0.5, "lookback_batches": 5})
    df = rows(spark)

    def run(n, **more):
        batch = spark.createDataFrame([(1, "p", n)], "shop_id bigint, platform string, rows_read bigint")
        return check(df, rule, ledger=more.pop("ledger", ledger), batch_rows=batch, **more)[0][2:]

    assert run(300) == (0, "300 rows, average 100")
    assert run(150) == (1, "150 rows, average 100") and run(49)[0] == 0
    assert run(300, ledger=ledger.limit(1)) == (1, "300")
    assert run(300, run_type="backfill") == (1, "-")


def test_a_rule_that_cannot_run_fails(spark):
    df = rows(spark, ("a", "x", 1, IN))
    bad = [
        Rule("t", "null_rate", {"column": "nope", "max_rate": 0, "scope": "table"}),
        Rule("t", "null_rate", {"column": "amount; --", "max_rate": 0, "scope": "table"}),
        Rule("t", "range", {"column": "amount", "min": 0, "scope": "table"}),
        Rule("t", "range", {"column": "amount", "min": 0, "max": 1}),
        Rule("t", "range", {"column": "amount", "min": 0, "max": 1, "scope": "galaxy"}),
        Rule("t", "unique", {"columns": []}),
        Rule("t", "row_count_delta", {"max_deviation": 1}),
        Rule("t", "referential", {"child_column": "order_id", "parent_table": "x", "parent_column": "order_id"}),
    ]
    assert [x[2:] for x in check(df, *bad)] == [(0, "error")] * len(bad)


def test_rules_of_one_scope_share_one_scan(spark):
    df = rows(spark, ("a", "x", 1, IN))
    rules = [
        Rule("t", "null_rate", {"column": "buyer_nick", "max_rate": 0}), Rule("t", "range", {"column": "amount", "min": 0, "max": 9}),
        Rule("t", "freshness", {"max_age_minutes": 99999}),
    ]
    verdicts = quality.run_checks({"t": df}, rules, now=NOW, windows=windows(spark))
    assert verdicts.count() == 3
    plan = verdicts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_rule_files(tmp_path, spark):
    good = [{"table_name": "dw.t", "rule_type": "unique", "params": {"columns": ["a"]}, "severity": "block"}]
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(good), encoding="utf-8")
    rules = config_files.parse_rules(config_files.load_document(path))
    assert rules[0].severity == "block" and config_files.rules_frame(spark, rules).count() == 1
    for broken in (
        {"a": 1}, ["x"], [{"table_name": "t"}], [{**good[0], "more": 1}], [{**good[0], "rule_type": "custom_sql"}],
        [{**good[0], "severity": "fatal"}], [{**good[0], "table_name": "t; drop"}],
    ):
        with pytest.raises(ValueError):
            config_files.parse_rules(broken)


def test_registry_files(tmp_path, spark):
    pytest.importorskip("yaml")
    path = tmp_path / "shops.yaml"
    path.write_text("shops:\n  - {shop_id: 1, platform: mock, shop_name: 店}\n", encoding="utf-8")
    shops = config_files.parse_registry(config_files.load_document(path))
    assert shops == [{"shop_id": 1, "platform": "mock", "shop_name": "店", "status": "active"}]
    assert config_files.registry_frame(spark, shops).first().shop_name == "店"
    for broken in (None, {"shops": []}, {"shops": ["x"]}, {"shops": [{"shop_id": 1}]}, {"shops": [{**shops[0], "status": "ghost"}]},
                   {"shops": [{**shops[0], "shop_id": "x"}]}):
        with pytest.raises(ValueError):
            config_files.parse_registry(broken)
