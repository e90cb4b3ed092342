"""Detail layer: cleaned order and item facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import PAID_SCOPE, business_date, status_norm
from ..functions.status import StatusMap


def business_window(orders: DataFrame, since: date, end: date) -> DataFrame:
    """Orders whose business date lies in the closed range ``[since, end]``."""
    day = business_date(F.col("created_at"), F.col("updated_at"))
    return orders.where(day.between(F.lit(since), F.lit(end)))


def dwd_orders(ods_orders: DataFrame, batch_id: str, mapping: StatusMap | None = None) -> DataFrame:
    """ODS orders -> order facts with normalised status and business date."""
    norm = status_norm(
        F.col("platform"), F.col("order_status"), F.col("refund_amount_cents"), F.col("payment_amount_cents"), mapping
    )
    return ods_orders.select(
        "shop_id", "order_id", "platform",
        F.col("order_status").alias("status_raw"), norm.alias("status_norm"),
        "buyer_nick", "order_amount_cents", "payment_amount_cents", "refund_amount_cents",
        "is_deleted", "created_at", "updated_at",
        business_date(F.col("created_at"), F.col("updated_at")).alias("stat_date"),
        F.lit(batch_id).alias("etl_batch_id"),
    )


def dwd_items(ods_items: DataFrame, batch_id: str) -> DataFrame:
    """ODS items -> item facts; the line amount is NULL when quantity or price is, or when it is no BIGINT."""
    return ods_items.select(
        "shop_id", "order_id", "item_id", "platform", "product_id", "product_name", "quantity", "price_cents",
        F.try_multiply(F.col("quantity").cast("bigint"), F.col("price_cents")).alias("amount_cents"),
        "updated_at", F.lit(batch_id).alias("etl_batch_id"),
    )


def items_of_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items whose order is in ``orders``."""
    return items.join(orders.select("shop_id", "order_id"), ["shop_id", "order_id"], "left_semi")


def paid_orders(dwd: DataFrame) -> DataFrame:
    """Orders that count as business: a paid-scope status and not deleted at the source."""
    in_scope = F.col("status_norm").isin(*PAID_SCOPE) & (F.coalesce("is_deleted", F.lit(0)) == 0)
    return dwd.where(in_scope).select(
        "shop_id", "order_id", "platform",
        business_date(F.col("created_at"), F.col("updated_at")).alias("stat_date"),
        "buyer_nick", "payment_amount_cents", "refund_amount_cents",
    )
