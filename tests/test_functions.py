"""Column helpers: money, rates, times, text."""

from __future__ import annotations

from datetime import datetime
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopstrata.functions import canonical_json, exact_ratio, int_div, minutes_between, parse_iso, to_cents
from shopstrata.functions.joins import join_lookup


def values(spark, texts, fn, source="string"):
    df = spark.createDataFrame([(t,) for t in texts], f"v {source}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_yuan_to_cents(spark):
    texts = ["12.34", "0.05", "100", "0", "12.345", "12.355", "0.0050000001", " 3.1 ", "1e2", "-5.00", "abc", "", None, "NaN"]
    want = [1234, 5, 10000, 0, 1234, 1236, 1, 310, 10000, -500, None, None, None, None]
    assert values(spark, texts, to_cents) == want


@settings(max_examples=3, deadline=None)
@given(st.lists(st.decimals(min_value=-10**9, max_value=10**9, places=4), min_size=50, max_size=200))
def test_cents_round_half_to_even(spark, amounts):
    want = [int((a * 100).quantize(Decimal(1), ROUND_HALF_EVEN)) for a in amounts]
    assert values(spark, [str(a) for a in amounts], to_cents) == want


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(-10**12, 10**12)), min_size=50, max_size=200))
def test_ratio_is_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = [r[0] for r in df.select(exact_ratio(F.col("n"), F.col("d"), unit=100)).collect()]
    for (n, d), value in zip(pairs, got):
        if d == 0:
            assert value is None
        else:
            steps = (Decimal(n) * 1_000_000 / Decimal(d)).quantize(Decimal(1), ROUND_HALF_UP)
            assert value == float(steps) / 10_000.0


def test_ratio_beyond_a_bigint_of_steps_does_not_wrap(spark):
    pairs = [(9_223_372_036_855, 1), (20_000_000_000_000, 1), (-(2**63), 1), (2**63 - 1, -3), (18_446_744_073_710, 1)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = [r[0] for r in df.select(exact_ratio(F.col("n"), F.col("d"), unit=100)).collect()]
    for (n, d), value in zip(pairs, got, strict=True):
        assert value == float((Decimal(n) * 1_000_000 / Decimal(d)).quantize(Decimal(1), ROUND_HALF_UP)) / 10_000.0
    # the last one, wrapped to 64 bits, would have been a percentage that its column can hold
    fits = df.where("n = 18446744073710").select(exact_ratio(F.col("n"), F.col("d"), unit=100).try_cast("decimal(12,4)"))
    assert fits.first()[0] is None


def test_int_div_truncates_and_guards_zero(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (7, 0)], "a bigint, b bigint")
    assert [r[0] for r in df.select(int_div(F.col("a"), F.col("b"))).collect()] == [3, -3, None]


def test_iso_times_become_business_time(spark):
    texts = [
        "2026-09-01T08:00:00", "2026-09-01 08:00", "2026-09-01", "2026-09-01T08:00:00.123", "2026-09-01T00:00:00Z",
        "2026-03-08T02:30:00-05:00", "2026-11-01T05:30:00Z", "2026-9-1", "2026", "tomorrow", "2026-13-01", None,
    ]
    want = [
        datetime(2026, 9, 1, 8), datetime(2026, 9, 1, 8), datetime(2026, 9, 1), datetime(2026, 9, 1, 8, 0, 0, 123000),
        datetime(2026, 9, 1, 8), datetime(2026, 3, 8, 15, 30), datetime(2026, 11, 1, 13, 30), None, None, None, None, None,
    ]
    assert values(spark, texts, parse_iso) == want


def test_other_iso_shapes(spark):
    wanted = {
        "20260901": datetime(2026, 9, 1), "20260901T080102": datetime(2026, 9, 1, 8, 1, 2),
        "2026-09-01T08": datetime(2026, 9, 1, 8), "2026-09-01T0801": datetime(2026, 9, 1, 8, 1),
        "2026-09-01T08:01:02,5": datetime(2026, 9, 1, 8, 1, 2, 500000),
        "2026-09-01T08:01:02.123456789": datetime(2026, 9, 1, 8, 1, 2, 123456),
        "2026-09-01T08+05": datetime(2026, 9, 1, 11), "20260901T080102Z": datetime(2026, 9, 1, 16, 1, 2),
        "2026-09-01T08:01:02.1234567-0130": datetime(2026, 9, 1, 17, 31, 2, 123456),
        "2026-0901": None, "202609-01": None, "2026-09-01T08:0102": None, "2026-09-01T25": None, "20261301": None,
        "2026-09-01T08:01:02.": None, "2026-09-01Z": None, "20260901T08:01+5": None, "2026090108": None, "": None,
    }
    assert dict(zip(wanted, values(spark, list(wanted), parse_iso))) == wanted


def test_minutes_and_canonical_json(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2026-01-01 00:00:00' a, TIMESTAMP_NTZ'2026-01-01 00:02:59' b")
    assert df.select(minutes_between(F.col("a"), F.col("b"))).first()[0] == 2
    assert df.select(minutes_between(F.col("b"), F.col("a"))).first()[0] == -2
    same = values(spark, ['{"b": 1, "a": [1, {"z": 0, "y": null}]}', '{"a":[1,{"y":null,"z":0}],"b":1}'], canonical_json)
    assert same[0] == same[1]


def test_lookup_join_gives_the_same_rows_broadcast_or_salted(spark):
    big = spark.range(2000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    lookup = spark.createDataFrame([(1, "a"), (3, "b"), (9, "c")], "k bigint, name string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        small = join_lookup(big, lookup, ["k"], "v", how)
        salted = join_lookup(big, lookup, ["k"], "v", how, max_rows=1, salts=4)
        plain = join_lookup(big, lookup, ["k"], "v", how, max_rows=1, salts=1)
        columns = small.columns
        assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, salted.select(*columns).collect()), key=repr)
        assert small.count() == plain.count()
