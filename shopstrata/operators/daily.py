"""Daily summaries per shop and per product.

A shop is identified by its id and platform.  The platform is part of the grouping rather
than picked by an aggregate: all buffers are then fixed-width numbers, which keeps the
aggregations on the hash path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import int_div
from .facts import paid_orders


def distinct_with_null(column: str) -> Column:
    """Number of different values where a missing value counts as one value."""
    return F.count_distinct(F.col(column)) + F.max(F.col(column).isNull().cast("int"))


def _total(column: str) -> Column:
    return F.sum(F.coalesce(F.col(column), F.lit(0)))


def shop_daily(dwd: DataFrame) -> DataFrame:
    """Paid-scope orders summed by day and shop.

    The distinct buyer count is planned as two aggregations with map-side combining, so a
    shop that holds a large share of all rows is spread over its buyers first.
    """
    return (
        paid_orders(dwd)
        .groupBy("stat_date", "shop_id", "platform")
        .agg(
            _total("payment_amount_cents").alias("gmv_cents"),
            F.count(F.lit(1)).cast("int").alias("order_cnt"),
            distinct_with_null("buyer_nick").cast("int").alias("buyer_cnt"),
            _total("refund_amount_cents").alias("refund_cents"),
        )
        .withColumn("avg_order_cents", int_div(F.col("gmv_cents"), F.col("order_cnt")))
    )


def product_daily(dwd: DataFrame, items: DataFrame) -> DataFrame:
    """Items of paid-scope orders summed by day, shop and product."""
    paid = paid_orders(dwd).select("shop_id", "order_id", "stat_date", "platform")
    lines = items.select("shop_id", "order_id", "product_id", "quantity", "amount_cents")
    return (
        paid.join(lines, ["shop_id", "order_id"])
        .groupBy("stat_date", "shop_id", "product_id", "platform")
        .agg(
            _total("quantity").cast("int").alias("sold_qty"),
            _total("amount_cents").alias("sales_cents"),
        )
    )
