"""The given star-schema tables seen as a commerce feed, its ledger and its dimensions.

Every view is derived from whole tables; nothing is sampled or made up.  Faults (unknown
codes, missing values, repeats, bad amounts) are injected by order number so that each
operator meets them at every scale.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import to_cents

#: The clock of the order data and of the event data.
ORDERS_NOW = datetime(2001, 8, 1)
EVENTS_NOW = datetime(2024, 1, 31)
ITEM_TIES = ("product_id", "quantity", "price_cents")
ITEM_KEY = ("shop_id", "order_id", "item_id")
ORDER_KEY = ("shop_id", "order_id")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _cents(money: Column) -> Column:
    return F.round(money * 100).cast("bigint")


def _seconds(n: Column) -> Column:
    return F.make_dt_interval(secs=n.cast("decimal(18,6)"))


def order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order number with shop and platform; a shop is a region."""
    orders = read(spark, sf_dir, "orders")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return orders.join(
        customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")),
        F.col("o_custkey") == F.col("c_custkey"),
    ).withColumns(
        {
            "shop_id": (F.col("n_regionkey") + 1).cast("bigint"),
            "platform": F.when(F.col("n_regionkey") % 2 == 0, "alpha").otherwise("beta"),
        }
    )


def ods_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    paid = _cents(F.col("o_totalprice"))
    offset = k * 37 % 86400
    return order_heads(spark, sf_dir).select(
        "shop_id",
        k.cast("string").alias("order_id"),
        "platform",
        F.when(k % 211 == 0, None)
        .when(k % 17 == 0, "TRADE_MYSTERY")
        .when((status == "F") & (k % 10 == 0), "cancelled")
        .when(status == "F", "completed")
        .when((status == "O") & urgent, "shipped")
        .when(status == "O", "paid")
        .otherwise("pending")
        .alias("order_status"),
        F.when(k % 97 != 0, F.col("c_name")).alias("buyer_nick"),
        paid.alias("order_amount_cents"),
        paid.alias("payment_amount_cents"),
        F.when(k % 19 == 0, paid).otherwise(F.lit(0).cast("bigint")).alias("refund_amount_cents"),
        F.when(k % 53 == 0, 1).otherwise(0).alias("is_deleted"),
        F.when(k % 101 != 0, F.col("o_orderdate") + _seconds(offset)).alias("created_at"),
        (F.col("o_orderdate") + _seconds(offset + k * 7919 % 36000)).alias("updated_at"),
    )


def product_id(part: Column) -> Column:
    """``P`` and at least five digits; longer numbers stay whole."""
    text = part.cast("string")
    return F.concat(F.lit("P"), F.lpad(text, F.greatest(F.lit(5), F.length(text)), "0"))


def ods_items_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as they arrive, with repeated keys."""
    return _numbered_items(spark, sf_dir).drop("number")


def _numbered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the ``number`` of their order; the join with orders is the last, so rows are dealt by it."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    heads = order_heads(spark, sf_dir).select("o_orderkey", "shop_id", "platform")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        heads, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select(
        F.col("l_orderkey").alias("number"),
        "shop_id",
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("item_id"),
        "platform",
        product_id(F.col("l_partkey")).alias("product_id"),
        F.concat_ws(" ", "p_name", "l_returnflag").alias("product_name"),
        F.when(F.col("l_orderkey") % 89 != 0, F.col("l_quantity").cast("int")).alias("quantity"),
        _cents(F.col("l_extendedprice")).alias("price_cents"),
        F.col("l_shipdate").alias("updated_at"),
    )


def ods_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as a table: the newest row per key."""
    from ..operators.merge import latest_by_key

    return latest_by_key(ods_items_feed(spark, sf_dir), ITEM_KEY, "updated_at", ITEM_TIES)


# ---- an earlier load and a re-read, for merges -------------------------------------------

EARLIER_LOAD_UNTIL = datetime(2000, 1, 1)


def merge_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier run had loaded: all orders updated before 2000."""
    return ods_orders(spark, sf_dir).where(F.col("updated_at") < F.lit(EARLIER_LOAD_UNTIL.isoformat(" ")).cast("timestamp_ntz"))


def merge_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A re-read of every order with corrected payment; times moved on, back or not at all."""
    k = F.col("order_id").cast("bigint")
    shift = F.when(k % 10 == 0, 0).when(k % 4 == 0, 3600).when(k % 4 == 2, -3600).otherwise(60)
    return ods_orders(spark, sf_dir).withColumns(
        {
            "payment_amount_cents": F.col("payment_amount_cents") + 1,
            "updated_at": F.col("updated_at") + _seconds(shift),
        }
    )


# ---- feed messages -----------------------------------------------------------------------


def dated_anew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incoming rows of the merge, every seventh with a creation time three days later."""
    later = F.col("created_at") + F.make_dt_interval(F.lit(3))
    return merge_incoming(spark, sf_dir).withColumn(
        "created_at", F.when(F.col("order_id").cast("bigint") % 7 == 0, later).otherwise(F.col("created_at"))
    )


def feed_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Files of a feed, one for each shop and day of orders, and the ledger of those read before.

    Those of the first two weeks of a month were read; some have grown since.
    """
    day = F.to_date("updated_at")
    files = ods_orders(spark, sf_dir).groupBy(
        F.concat(F.lit("shop_id="), F.col("shop_id").cast("string"), F.lit("/"), day.cast("string"), F.lit(".json")).alias("path"),
        day.alias("day"),
    ).agg(
        F.sum("order_amount_cents").alias("bytes"), F.max(F.col("updated_at")).alias("last_time"),
    ).withColumn("modified_at", F.col("last_time"))
    grown = F.when(F.dayofmonth("day") % 5 == 0, F.col("bytes") - 1).otherwise(F.col("bytes"))
    return files.select("path", "bytes", "modified_at"), files.where(F.dayofmonth("day") <= 14).select(
        "path", grown.alias("bytes"), "modified_at", "last_time"
    )


def _yuan(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") / 100).cast("decimal(20,2)").cast("string")


def _iso(ts: Column, zoned: Column) -> Column:
    text = F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))  # date_format would go through the session zone
    return F.when(zoned, F.concat(text, F.lit("+08:00"))).otherwise(text)


def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages as JSON text with their items, faults included.

    By order number k > 0: % 307 unreadable amount, % 311 negative amount, % 313 no order
    id, % 317 first item without quantity, % 337 first item with an unreadable price,
    % 331 sent twice, the second time an hour later with one yuan more paid.
    """
    def fault(every: int) -> Column:
        return (F.col("k") > 0) & (F.col("k") % every == 0)

    from ..operators.merge import latest_by_key

    # Rows stay dealt and sorted by the number of their order from the join on; an aggregation of lists would sort them twice more.
    latest = latest_by_key(_numbered_items(spark, sf_dir), ITEM_KEY, "updated_at", ITEM_TIES, lead="number")
    of_order = Window.partitionBy("number").orderBy(*ITEM_KEY)
    all_rows = of_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    each = F.struct("item_id", "product_id", "product_name", "quantity", _yuan(F.col("price_cents")).alias("price"))
    listed = latest.select("number", *ITEM_KEY, each.alias("line")).select(
        "number", F.collect_list("line").over(all_rows).alias("lines"), F.row_number().over(of_order).alias("nth")
    )
    items = listed.where("nth = 1").select("number", F.sort_array("lines").alias("lines"))
    faulty = F.transform(
        "lines",
        lambda x, i: F.struct(
            x["item_id"].alias("item_id"),
            x["product_id"].alias("product_id"),
            x["product_name"].alias("product_name"),
            F.when(fault(317) & (i == 0), 0).otherwise(x["quantity"]).alias("quantity"),
            F.when(fault(337) & (i == 0), "free").otherwise(x["price"]).alias("price"),
        ),
    )
    line = F.when(fault(317) | fault(337), faulty).otherwise(F.col("lines"))
    copies = F.when(fault(331), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    zoned = F.col("k") % 7 == 0
    message = F.struct(
        F.when(~fault(313), F.col("order_id")).alias("order_id"),
        "shop_id",
        F.col("order_status").alias("status"),
        "buyer_nick",
        F.when(fault(307), "abc").when(fault(311), "-5.00").otherwise(_yuan(F.col("order_amount_cents"))).alias("order_amount"),
        _yuan(F.col("payment_amount_cents") + F.col("copy") * 100).alias("payment_amount"),
        F.when(F.col("refund_amount_cents") > 0, _yuan(F.col("refund_amount_cents"))).alias("refund_amount"),
        F.when(F.col("is_deleted") == 1, True).alias("is_deleted"),
        _iso(F.col("created_at"), zoned).alias("created_at"),
        _iso(F.col("updated_at") + _seconds(F.col("copy") * 3600), zoned).alias("updated_at"),
        line.alias("items"),
    )
    return (
        ods_orders(spark, sf_dir)
        .withColumn("k", F.col("order_id").cast("bigint"))
        .join(items, F.col("k") == F.col("number"), "left")
        .withColumn("copy", F.explode(copies))
        .select("platform", F.col("shop_id").alias("source_shop_id"), F.to_json(message).alias("value"))
    )


# ---- ledger and metrics ------------------------------------------------------------------


def _minutes(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def etl_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = F.col("user_id") % 5
    return read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("batch_id"),
        F.when(F.col("event_id") % 2 == 0, "dw.ods_orders").otherwise("dw.ods_order_items").alias("table_name"),
        (shop + 1).alias("shop_id"),
        F.when(shop % 2 == 0, "alpha").otherwise("beta").alias("platform"),
        F.when(F.col("event_type") == "signup", "backfill").otherwise("incremental").alias("run_type"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.round("value").cast("bigint").alias("rows_read"),
        (F.col("ts") - _minutes(5)).alias("window_end"),
        F.col("ts").alias("started_at"),
    )


def etl_task_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.concat(F.lit("dag_"), (F.col("user_id") % 3).cast("string")).alias("dag_id"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.round(F.col("value") * 100).cast("bigint").alias("duration_ms"),
        F.col("ts").alias("started_at"),
    )


def dq_check_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("result_id"),
        (F.col("user_id") % 7 + 1).alias("check_id"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("passed"),
        F.col("ts").alias("evaluated_at"),
    )


def etl_load_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").where("event_type = 'error'").select(
        F.col("event_id").alias("error_id"),
        F.col("event_id").cast("string").alias("batch_id"),
        F.when(F.col("event_id") % 3 == 0, "schema_mismatch").otherwise("mapper_error").alias("error_type"),
        F.col("ts").alias("created_at"),
    )


def etl_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = etl_batch(spark, sf_dir).where("status = 'success' AND run_type = 'incremental'")
    return done.groupBy("table_name", "shop_id", "platform").agg(F.max("window_end").alias("watermark_value"))


# ---- shops: one per customer, so that the dimension grows with the data ------------------


def _customer_shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("shop_id"),
        F.when(F.col("c_nationkey") % 2 == 0, "alpha").otherwise("beta").alias("platform"),
        F.col("c_name").alias("shop_name"),
        "c_nationkey", "c_mktsegment", "c_acctbal",
    )


def shop_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop dimension before a sync: every nation but 7; segment BUILDING has a closed version."""
    shops = _customer_shops(spark, sf_dir).where("c_nationkey <> 7")
    current = shops.select(
        (F.col("shop_id") * 2).alias("shop_key"), "shop_id", "platform", "shop_name", F.lit("active").alias("status"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(date(2001, 8, 1))).otherwise(F.lit(date(2000, 1, 1))).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"), F.lit(1).alias("is_current"),
    )
    closed = shops.where("c_mktsegment = 'BUILDING'").select(
        (F.col("shop_id") * 2 + 1).alias("shop_key"), "shop_id", "platform",
        F.concat(F.lit("OLD "), F.col("shop_name")).alias("shop_name"), F.lit("active").alias("status"),
        F.lit(date(1999, 1, 1)).alias("valid_from"), F.lit(date(2000, 1, 1)).alias("valid_to"), F.lit(0).alias("is_current"),
    )
    return current.unionByName(closed)


def shop_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered shops: every nation but 3; AUTOMOBILE renamed, negative balance disabled."""
    return _customer_shops(spark, sf_dir).where("c_nationkey <> 3").select(
        "shop_id", "platform",
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat("shop_name", F.lit(" NEW"))).otherwise(F.col("shop_name")).alias("shop_name"),
        F.when(F.col("c_acctbal") < 0, "disabled").otherwise("active").alias("status"),
    )


# ---- rules: one price limit per part ------------------------------------------------------


def rule_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured rules: a price limit per part, parameters in reading order."""
    params = F.concat(
        F.lit('{"column": "price_cents", "min": 0, "max": '), _cents(F.col("p_retailprice")).cast("string"),
        F.lit(', "part": "'), F.col("p_partkey").cast("string"), F.lit('"}'),
    )
    return read(spark, sf_dir, "part").select(
        F.lit("dw.ods_order_items").alias("table_name"), F.lit("range").alias("rule_type"), params.alias("params"),
        F.when(F.col("p_size") > 25, "block").otherwise("warn").alias("severity"),
    )


def rule_defs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered rules: those of parts up to size 30, parameters in another order."""
    params = F.concat(
        F.lit('{"part":"'), F.col("p_partkey").cast("string"), F.lit('","max":'),
        _cents(F.col("p_retailprice")).cast("string"), F.lit(',"min":0,"column":"price_cents"}'),
    )
    return read(spark, sf_dir, "part").where("p_size <= 30").select(
        F.col("p_partkey").alias("check_id"), F.lit("dw.ods_order_items").alias("table_name"),
        F.lit("range").alias("rule_type"), params.alias("params"), F.lit("warn").alias("severity"),
    )


def yuan_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as text per line, with thousandths and some that are no amounts."""
    k = F.col("l_orderkey")
    thousandths = (_cents(F.col("l_extendedprice")) * 10 + F.col("l_linenumber")).cast("decimal(20,0)")
    text = (thousandths / 1000).cast("decimal(20,3)").cast("string")
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(k % 307 == 0, "abc").when(k % 313 == 0, None).when(k % 311 == 0, F.concat(F.lit("-"), text)).otherwise(text).alias("yuan"),
    )


def cents_of_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yuan_texts(spark, sf_dir).select("l_orderkey", "l_linenumber", "yuan", to_cents(F.col("yuan")).alias("cents"))


def view(name: str):
    """A view by name as ``(spark, sf_dir) -> DataFrame``."""
    return partial(globals()[name])
