"""The report queries behind the dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Row limits of time series, detail tables and shares.
SERIES_ROWS, DETAIL_ROWS, SHARE_ROWS = 10_000, 1_000, 100

SHOP_DETAIL = (
    "stat_date", "gmv_cents", "order_cnt", "buyer_cnt", "refund_cents", "avg_order_cents",
    "refund_rate", "gmv_dod_pct", "active_product_cnt", "sell_through_rate",
)
ORDER_DETAIL = (
    "stat_date", "order_id", "status_norm", "buyer_nick", "payment_amount_cents",
    "refund_amount_cents", "created_at",
)


def sum_by_day(report: DataFrame, column: str) -> DataFrame:
    """Total of a column per day."""
    series = report.groupBy("stat_date").agg(F.sum(column).cast("bigint").alias(column))
    return series.orderBy("stat_date").limit(SERIES_ROWS)


def mean_by_day(report: DataFrame, column: str, *, scale: int = 1) -> DataFrame:
    """Unweighted mean of a column with ``1/scale`` steps per day.

    The sum is taken over integers so that it does not depend on the order of the rows.
    """
    steps = F.round(F.col(column) * scale).cast("bigint")
    mean = F.sum(steps).cast("double") / (F.count(column) * F.lit(float(scale)))
    return report.groupBy("stat_date").agg(mean.alias(column)).orderBy("stat_date").limit(SERIES_ROWS)


def total(report: DataFrame, column: str) -> DataFrame:
    """Total of a column over the whole report."""
    return report.agg(F.sum(column).cast("bigint").alias(column))


def status_share(orders: DataFrame) -> DataFrame:
    """Number of orders per status, most frequent first."""
    share = orders.groupBy("status_norm").agg(F.count(F.lit(1)).alias("order_cnt"))
    return share.orderBy(F.col("order_cnt").desc(), "status_norm").limit(SHARE_ROWS)


def orders_by_day(orders: DataFrame) -> DataFrame:
    """Number of orders of any status per day."""
    series = orders.groupBy("stat_date").agg(F.count(F.lit(1)).alias("order_cnt"))
    return series.orderBy("stat_date").limit(SERIES_ROWS)


def shop_detail(overview: DataFrame) -> DataFrame:
    """Shop report rows, newest day first."""
    order = [F.col("stat_date").desc(), F.col("shop_id")]
    return overview.orderBy(*order).limit(DETAIL_ROWS).select(*SHOP_DETAIL)


def order_detail(orders: DataFrame) -> DataFrame:
    """Order rows, newest day first."""
    order = [F.col("stat_date").desc(), F.col("shop_id"), F.col("order_id")]
    return orders.orderBy(*order).limit(DETAIL_ROWS).select(*ORDER_DETAIL)


#: Chart name -> (report table, query over it).
CHARTS = {
    "gmv_trend": ("dw.ads_shop_overview", lambda df: sum_by_day(df, "gmv_cents")),
    "order_trend": ("dw.ads_shop_overview", lambda df: sum_by_day(df, "order_cnt")),
    "refund_rate_trend": ("dw.ads_shop_overview", lambda df: mean_by_day(df, "refund_rate", scale=10_000)),
    "avg_order_trend": ("dw.ads_shop_overview", lambda df: mean_by_day(df, "avg_order_cents")),
    "shop_detail": ("dw.ads_shop_overview", shop_detail),
    "gmv_total": ("dw.ads_daily_kpi", lambda df: total(df, "gmv_cents")),
    "order_total": ("dw.ads_daily_kpi", lambda df: total(df, "order_cnt")),
    "kpi_gmv_trend": ("dw.ads_daily_kpi", lambda df: sum_by_day(df, "gmv_cents")),
    "kpi_order_trend": ("dw.ads_daily_kpi", lambda df: sum_by_day(df, "order_cnt")),
    "status_share": ("dw.dwd_orders", status_share),
    "daily_orders": ("dw.dwd_orders", orders_by_day),
    "order_detail": ("dw.dwd_orders", order_detail),
}
