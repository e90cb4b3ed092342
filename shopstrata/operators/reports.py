"""Report layer: shop overview and platform KPI."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact_ratio, int_div
from .daily import distinct_with_null
from .facts import paid_orders


def _day_over_day(column: str, by: tuple[str, ...]) -> Column:
    """Change in percent against the previous row of the group, 4 decimals.

    Groups are shops or platforms with one row a day, so a window partition holds at most
    one row per calendar day.
    """
    before = F.lag(column).over(Window.partitionBy(*by).orderBy("stat_date"))
    return exact_ratio(F.col(column) - before, before, unit=100)


def _guarded_rate(num: str, den: str) -> Column:
    return F.when(F.col(den) > 0, exact_ratio(F.col(num), F.col(den))).otherwise(F.lit(0.0))


def _look_back(daily: DataFrame, since: date | None) -> DataFrame:
    """The rows of the window plus one day, which only serves as the first comparison."""
    return daily if since is None else daily.where(F.col("stat_date") >= F.lit(since - timedelta(days=1)))


def _from_window_start(df: DataFrame, since: date | None) -> DataFrame:
    return df if since is None else df.where(F.col("stat_date") >= F.lit(since))


def with_next_day(days: DataFrame, rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """``days`` (columns ``by`` and ``stat_date``), and for each the next day that its group has a row for.

    A changed day changes its own report and the comparison of the row after it.
    """
    known = rows.select(*by, F.col("stat_date").alias("_after")).distinct()
    later = days.join(known, list(by)).where(F.col("_after") > F.col("stat_date"))
    following = later.groupBy(*by, "stat_date").agg(F.min("_after").alias("_after"))
    return days.unionByName(following.select(*by, F.col("_after").alias("stat_date"))).distinct()


def shop_overview(
    shop_days: DataFrame, product_days: DataFrame, products: DataFrame, since: date | None = None
) -> DataFrame:
    """Shop report per day: change against the day before, refund rate and sell-through.

    Shop days and product counts are both grouped by day and shop, so their join reuses the
    partitioning of the aggregations.
    """
    active = (
        _from_window_start(product_days, since)
        .groupBy("stat_date", "shop_id", "platform")
        .agg(F.count(F.lit(1)).cast("int").alias("active_product_cnt"))
    )
    catalogue = products.groupBy("shop_id").agg(F.count(F.lit(1)).cast("int").alias("product_total_cnt"))
    by_shop = ("platform", "shop_id")
    wide = (
        _look_back(shop_days, since)
        .join(active, ["stat_date", "shop_id", "platform"], "left")
        .join(catalogue, "shop_id", "left")
        .withColumns(
            {
                "active_product_cnt": F.coalesce("active_product_cnt", F.lit(0)),
                "product_total_cnt": F.coalesce("product_total_cnt", F.lit(0)),
                "refund_rate": _guarded_rate("refund_cents", "gmv_cents"),
                "gmv_dod_pct": _day_over_day("gmv_cents", by_shop),
                "order_dod_pct": _day_over_day("order_cnt", by_shop),
            }
        )
        .withColumn("sell_through_rate", _guarded_rate("active_product_cnt", "product_total_cnt"))
    )
    return _from_window_start(wide, since).select(
        "stat_date", "shop_id", "platform", "gmv_cents", "order_cnt", "buyer_cnt", "refund_cents",
        "avg_order_cents", "refund_rate", "gmv_dod_pct", "order_dod_pct",
        "active_product_cnt", "product_total_cnt", "sell_through_rate",
    )


def daily_kpi(shop_days: DataFrame, since: date | None = None) -> DataFrame:
    """Platform report per day; buyers are summed over the shops of the platform."""
    totals = (
        _look_back(shop_days, since)
        .groupBy("stat_date", "platform")
        .agg(
            F.sum("gmv_cents").alias("gmv_cents"),
            F.sum("order_cnt").cast("int").alias("order_cnt"),
            F.sum("buyer_cnt").cast("int").alias("buyer_cnt"),
            F.sum("refund_cents").alias("refund_cents"),
            F.count(F.lit(1)).cast("int").alias("shop_cnt"),
        )
        .withColumn("avg_order_cents", F.coalesce(int_div(F.col("gmv_cents"), F.col("order_cnt")), F.lit(0)))
        .withColumn("gmv_dod_pct", _day_over_day("gmv_cents", ("platform",)))
    )
    return _from_window_start(totals, since).select(
        "stat_date", "platform", "gmv_cents", "order_cnt", "buyer_cnt", "refund_cents",
        "avg_order_cents", "shop_cnt", "gmv_dod_pct",
    )


def kpi_distinct_buyers(dwd: DataFrame) -> DataFrame:
    """Buyers per day and platform, each counted once however many shops they bought from."""
    return (
        paid_orders(dwd)
        .groupBy("stat_date", "platform")
        .agg(distinct_with_null("buyer_nick").cast("int").alias("buyer_cnt"))
    )
