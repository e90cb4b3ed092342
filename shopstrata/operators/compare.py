"""Reconciliation of tables after a load, a replay or a restore."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: ``table_name, row_cnt``."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_cnt")).select(F.lit(name).alias("table_name"), "row_cnt")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def table_diff(left: DataFrame, right: DataFrame, *, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows whose number of copies differs, with ``left_cnt`` and ``right_cnt``.

    Both directions come out of one aggregation; copies are counted before the shuffle,
    so a row repeated very often costs no more than any other.
    """
    columns = [c for c in left.columns if c not in set(ignore)]
    both = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return (
        both.groupBy(*columns)
        .agg(F.sum("_l").alias("left_cnt"), F.sum("_r").alias("right_cnt"))
        .where("left_cnt <> right_cnt")
    )
