"""Data-quality rules as configuration, evaluated with few table scans.

Rules that need only aggregates of one row scope (null rate, range, freshness) are folded
into a single aggregation per scope.  Uniqueness and references need a shuffle of their key
columns; both count keys before they shuffle, so a very frequent key is one row per task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import canonical_json, clip, exact_ratio, int_div, wall
from ..functions.joins import join_lookup
from ..functions.text import VALUE_TEXT_LIMIT

# Rule types, severities, and the names a rule may mention.
RULE_TYPES = ("null_rate", "unique", "range", "freshness", "row_count_delta", "referential")
SEVERITIES = ("warn", "block")
_COLUMN_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")
_TABLE_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")
DEFAULT_LOOKBACK = 10
MIN_HISTORY = 2

VERDICT_COLUMNS = [
    "check_id", "table_name", "rule_type", "severity", "shop_id", "platform",
    "passed", "actual_value", "expected_value", "detail",
]


@dataclass(frozen=True)
class Rule:
    """One configured check of a table."""

    table_name: str
    rule_type: str
    params: Mapping[str, Any] = field(default_factory=dict)
    severity: str = "warn"
    check_id: int = 0

    def validated(self) -> Rule:
        if not _TABLE_NAME.match(self.table_name):
            raise ValueError(f"invalid table name {self.table_name!r}")
        if self.rule_type not in RULE_TYPES:
            raise ValueError(f"unknown rule type {self.rule_type!r}, expected one of {RULE_TYPES}")
        if self.severity not in SEVERITIES:
            raise ValueError(f"invalid severity {self.severity!r}, expected one of {SEVERITIES}")
        return self

    def param(self, name: str) -> Any:
        if name not in self.params:
            raise ValueError(f"rule needs parameter {name!r}")
        return self.params[name]

    def column(self, df: DataFrame, name: str, default: str | None = None) -> str:
        """The column named by a parameter; only plain existing column names are accepted."""
        value = str(self.params.get(name, default) if default is not None else self.param(name))
        return known_column(df, value)

    @property
    def scope(self) -> str:
        scope = str(self.params.get("scope", "window"))
        if scope not in ("window", "table"):
            raise ValueError(f"invalid scope {scope!r}, expected window or table")
        return scope


def known_column(df: DataFrame, name: str) -> str:
    if not _COLUMN_NAME.match(name):
        raise ValueError(f"invalid column name {name!r}")
    if name not in df.columns:
        raise ValueError(f"no column {name!r}")
    return name


# ---- rules over one row scope ------------------------------------------------------------


@dataclass(frozen=True)
class _ScopeRule:
    """Aggregates a rule needs, and its verdict as a struct over those aggregates."""

    rule: Rule
    aggregates: list[Column]
    verdict: Column


def _verdict(rule: Rule, passed: Column, actual: Column, expected: str, detail: Column | None = None) -> Column:
    return F.struct(
        F.lit(rule.check_id).cast("bigint").alias("check_id"),
        F.lit(rule.table_name).alias("table_name"),
        F.lit(rule.rule_type).alias("rule_type"),
        F.lit(rule.severity).alias("severity"),
        F.when(passed, 1).otherwise(0).alias("passed"),
        clip(actual, VALUE_TEXT_LIMIT).alias("actual_value"),
        F.lit(expected[:VALUE_TEXT_LIMIT]).alias("expected_value"),
        clip(F.lit(None).cast("string") if detail is None else detail).alias("detail"),
    )


def _skippable(rule: Rule, empty: Column, why: str, passed: Column, actual: Column, expected: str,
               detail: Column | None = None) -> Column:
    """A verdict that passes with a note when there is nothing to check."""
    note = F.when(empty, F.lit(f"skipped: {why}")).otherwise(F.lit(None) if detail is None else detail)
    return _verdict(rule, empty | passed, F.when(empty, F.lit("-")).otherwise(actual), expected, note)


def _null_rate(df: DataFrame, rule: Rule, tag: str, now: datetime) -> _ScopeRule:
    column, limit = rule.column(df, "column"), float(rule.param("max_rate"))
    rows, nulls = F.col(f"{tag}_rows"), F.col(f"{tag}_nulls")
    passed = F.try_divide(nulls.cast("double"), rows) <= F.lit(limit)
    return _ScopeRule(
        rule,
        [F.count(F.lit(1)).alias(f"{tag}_rows"), F.count_if(F.col(column).isNull()).alias(f"{tag}_nulls")],
        _skippable(
            rule, F.coalesce(rows, F.lit(0)) == 0, "no rows", passed,
            F.format_string("%.4f", exact_ratio(nulls, rows)), f"<= {limit}",
            F.when(~passed, F.concat(nulls.cast("string"), F.lit(" of "), rows.cast("string"), F.lit(" are NULL"))),
        ),
    )


def _range(df: DataFrame, rule: Rule, tag: str, now: datetime) -> _ScopeRule:
    column, low, high = rule.column(df, "column"), rule.param("min"), rule.param("max")
    least, most = F.col(f"{tag}_min"), F.col(f"{tag}_max")
    text = F.concat(F.lit("["), least.cast("string"), F.lit(", "), most.cast("string"), F.lit("]"))
    return _ScopeRule(
        rule,
        [F.min(column).alias(f"{tag}_min"), F.max(column).alias(f"{tag}_max")],
        _skippable(
            rule, least.isNull() & most.isNull(), "all values are NULL",
            (least >= F.lit(low)) & (most <= F.lit(high)), text, f"[{low}, {high}]",
        ),
    )


def _freshness(df: DataFrame, rule: Rule, tag: str, now: datetime) -> _ScopeRule:
    column, limit = rule.column(df, "column", "updated_at"), int(rule.param("max_age_minutes"))
    newest = F.col(f"{tag}_newest")
    seconds = F.timestamp_diff("MICROSECOND", newest, wall(now)) / F.lit(1_000_000.0)
    text = F.concat(F.round(seconds / 60).cast("bigint").cast("string"), F.lit(" minutes"))
    return _ScopeRule(
        rule,
        [F.max(F.col(column).cast("timestamp_ntz")).alias(f"{tag}_newest")],
        _skippable(rule, newest.isNull(), "no rows", seconds / 60 <= limit, text, f"<= {limit} minutes"),
    )


_SCOPE_RULES = {"null_rate": _null_rate, "range": _range, "freshness": _freshness}


def _explode_verdicts(per_scope: DataFrame, rules: Sequence[_ScopeRule]) -> DataFrame:
    return per_scope.select("shop_id", "platform", F.inline(F.array(*[r.verdict for r in rules]))).select(
        *VERDICT_COLUMNS
    )


def _table_scope(df: DataFrame, rules: Sequence[_ScopeRule]) -> DataFrame:
    totals = df.agg(*[a for r in rules for a in r.aggregates])
    nobody = totals.select("*", F.lit(None).cast("bigint").alias("shop_id"), F.lit(None).cast("string").alias("platform"))
    return _explode_verdicts(nobody, rules)


def _window_scope(
    df: DataFrame, rules: Sequence[_ScopeRule], windows: DataFrame, bounds: tuple[datetime, datetime] | None
) -> DataFrame:
    """One pass over the rows of every shop's window; shops without rows still get verdicts.

    ``bounds`` are the outermost window limits: as literals they reach the scan, where
    files of other periods are skipped by their statistics.
    """
    spans = windows.select("shop_id", "platform", "window_start", "window_end")
    used = {c for r in rules for c in r.rule.params.values() if isinstance(c, str) and c in df.columns}
    needed = sorted({"shop_id", "platform", "updated_at"} | used)
    inside = (F.col("updated_at") >= F.col("window_start")) & (F.col("updated_at") < F.col("window_end"))
    rows = df.select(*needed)
    if bounds is not None:
        rows = rows.where((F.col("updated_at") >= wall(bounds[0])) & (F.col("updated_at") < wall(bounds[1])))
    per_shop = (
        join_lookup(rows, spans, ["shop_id", "platform"], needed)
        .where(inside)
        .groupBy("shop_id", "platform")
        .agg(*[a for r in rules for a in r.aggregates])
    )
    return _explode_verdicts(spans.join(per_shop, ["shop_id", "platform"], "left"), rules)


# ---- rules that need their own shuffle ---------------------------------------------------


def _one_verdict(totals: DataFrame, rule: Rule, verdict: Column) -> DataFrame:
    return totals.select(
        F.lit(None).cast("bigint").alias("shop_id"), F.lit(None).cast("string").alias("platform"),
        F.inline(F.array(verdict)),
    ).select(*VERDICT_COLUMNS)


def duplicate_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once; NULLs are equal to each other."""
    return (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").agg(F.count(F.lit(1)).alias("dup_groups"))
    )


def _unique(df: DataFrame, rule: Rule) -> DataFrame:
    columns = rule.param("columns")
    if not isinstance(columns, list) or not columns:
        raise ValueError("unique needs a non-empty list of columns")
    groups = duplicate_groups(df, [known_column(df, str(c)) for c in columns])
    n = F.col("dup_groups")
    return _one_verdict(groups, rule, _verdict(rule, n == 0, F.concat(n.cast("string"), F.lit(" duplicate groups")), "0"))


def orphan_keys(child: DataFrame, parent: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Child keys without a parent and how many child rows carry each; a NULL key is an orphan.

    Child rows are counted per key before they are matched: an order with very many items
    is a single row by then, and the counts are already partitioned for the join.
    """
    counted = child.groupBy(*[F.col(c) for c, _ in pairs]).agg(F.count(F.lit(1)).alias("child_rows"))
    known = parent.select(*[F.col(p).alias(c) for c, p in pairs])
    return counted.join(known, [c for c, _ in pairs], "left_anti")


def _referential(df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame]) -> DataFrame:
    parent_name = str(rule.param("parent_table"))
    if not _TABLE_NAME.match(parent_name) or parent_name not in tables:
        raise ValueError(f"unknown parent table {parent_name!r}")
    parent = tables[parent_name]
    pairs = [(rule.column(df, "child_column"), known_column(parent, str(rule.param("parent_column"))))]
    shop_pair = (rule.params.get("child_shop_column"), rule.params.get("parent_shop_column"))
    if (shop_pair[0] is None) != (shop_pair[1] is None):
        raise ValueError("the two shop columns of a reference come as a pair")
    if shop_pair[0] is not None:
        pairs.append((known_column(df, str(shop_pair[0])), known_column(parent, str(shop_pair[1]))))
    total = orphan_keys(df, parent, pairs).agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("orphans"))
    n = F.col("orphans")
    return _one_verdict(total, rule, _verdict(rule, n == 0, F.concat(n.cast("string"), F.lit(" orphan rows")), "0"))


def batch_averages(ledger: DataFrame, lookback: int) -> DataFrame:
    """Sum and number of rows read by the last successful, non-empty incremental batches.

    One row per table, shop and platform; the row limit is applied in each map task first.
    """
    newest = Window.partitionBy("table_name", "shop_id", "platform").orderBy(
        F.col("started_at").desc(), F.col("batch_id").desc()
    )
    return (
        ledger.where("run_type = 'incremental' AND status = 'success' AND rows_read > 0")
        .select("table_name", "shop_id", "platform", "rows_read", F.row_number().over(newest).alias("_nth"))
        .where(F.col("_nth") <= lookback)
        .groupBy("table_name", "shop_id", "platform")
        .agg(F.sum("rows_read").alias("history_rows"), F.count(F.lit(1)).alias("history_batches"))
    )


def _row_count_delta(rule: Rule, ledger: DataFrame, batch_rows: DataFrame, run_type: str) -> DataFrame:
    limit = float(rule.param("max_deviation"))
    lookback = int(rule.params.get("lookback_batches", DEFAULT_LOOKBACK))
    if "table_name" in batch_rows.columns:
        batch_rows = batch_rows.where(F.col("table_name") == rule.table_name)
    current = batch_rows.select("shop_id", "platform", "rows_read")
    if run_type != "incremental":
        skipped = _verdict(rule, F.lit(True), F.lit("-"), "-", F.lit(f"skipped: run type {run_type}"))
        return current.select("shop_id", "platform", F.inline(F.array(skipped))).select(*VERDICT_COLUMNS)
    history = batch_averages(ledger.where(F.col("table_name") == rule.table_name), lookback).drop("table_name")
    total, batches, rows = F.col("history_rows"), F.col("history_batches"), F.col("rows_read")
    # |rows - total/batches| / (total/batches), kept in integers up to the comparison
    off = F.abs(rows * batches - total)
    passed = off.cast("double") / total.cast("double") <= F.lit(limit)
    short = F.coalesce(batches, F.lit(0)) < MIN_HISTORY
    average = int_div(total * 2 + batches, batches * 2)
    actual = F.concat(rows.cast("string"), F.lit(" rows, average "), average.cast("string"))
    verdict = _verdict(
        rule, short | passed, F.when(short, rows.cast("string")).otherwise(actual), f"deviation <= {limit}",
        F.when(short, F.lit("skipped: too few earlier batches")).when(
            ~passed, F.concat(F.lit("deviation "), exact_ratio(off, total).cast("string"))
        ),
    )
    return (
        current.join(history, ["shop_id", "platform"], "left")
        .select("shop_id", "platform", F.inline(F.array(verdict)))
        .select(*VERDICT_COLUMNS)
    )


# ---- running a rule set ------------------------------------------------------------------


def _failed(any_df: DataFrame, rule: Rule, why: str) -> DataFrame:
    """A rule that cannot be evaluated counts as failed."""
    spark = any_df.sparkSession
    verdict = _verdict(rule, F.lit(False), F.lit("error"), "-", F.lit(f"rule failed: {why}"))
    return _one_verdict(spark.range(1), rule, verdict)


def run_checks(
    tables: Mapping[str, DataFrame],
    rules: Iterable[Rule],
    *,
    now: datetime,
    windows: DataFrame | None = None,
    ledger: DataFrame | None = None,
    batch_rows: DataFrame | None = None,
    run_type: str = "incremental",
    bounds: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """Verdicts of all rules. ``batch_rows`` holds for all tables, or names the table of each row.

    Verdicts over a window carry the shop and platform; verdicts over a whole table carry
    NULL there and apply to every shop.
    """
    parts: list[DataFrame] = []
    grouped: dict[tuple[str, str], list[_ScopeRule]] = {}
    for n, rule in enumerate(rules):
        df = tables[rule.table_name]
        try:
            if rule.rule_type in _SCOPE_RULES:
                if rule.scope == "window" and windows is None:
                    raise ValueError("a rule over a window needs the window")
                prepared = _SCOPE_RULES[rule.rule_type](df, rule, f"_r{n}", now)
                grouped.setdefault((rule.table_name, rule.scope), []).append(prepared)
            elif rule.rule_type == "unique":
                parts.append(_unique(df, rule))
            elif rule.rule_type == "referential":
                parts.append(_referential(df, rule, tables))
            elif ledger is None or batch_rows is None:
                raise ValueError("a row-count rule needs the batch ledger and the batch's row counts")
            else:
                parts.append(_row_count_delta(rule, ledger, batch_rows, run_type))
        except ValueError as problem:
            parts.append(_failed(df, rule, str(problem)))
    for (table, scope), members in grouped.items():
        if scope == "table":
            parts.append(_table_scope(tables[table], members))
        else:
            parts.append(_window_scope(tables[table], members, windows, bounds))
    if not parts:
        raise ValueError("no rules to run")
    return reduce(DataFrame.unionByName, parts)


def failures_by_severity(verdicts: DataFrame) -> DataFrame:
    """Failed verdicts counted per severity; ``blocked`` is 1 where they stop a batch."""
    return (
        verdicts.where("passed = 0")
        .groupBy("severity")
        .agg(F.count(F.lit(1)).alias("failures"))
        .withColumn("blocked", F.when(F.col("severity") == "block", 1).otherwise(0))
    )


def sync_rules(defs: DataFrame, specs: DataFrame) -> DataFrame:
    """Configured rules that are not registered yet, each once.

    Rules are the same when table, type and parameters are, whatever the order of the
    parameters; a changed severity alone is no new rule, and nothing is ever removed.
    """
    keys = ["table_name", "rule_type", "params"]
    known = defs.select("table_name", "rule_type", canonical_json(F.col("params")).alias("params"))
    wanted = specs.select("table_name", "rule_type", canonical_json(F.col("params")).alias("params"), "severity")
    return wanted.join(known, keys, "left_anti").groupBy(*keys).agg(F.min("severity").alias("severity"))
