"""From feed messages to accepted rows and dead letters.

A feed row is ``platform, source_shop_id, value``: one order message as JSON text with its
nested items.  The work is two passes over text and one shuffle:

1. ``newest_messages`` reads only the key and time of each message, keeps those of the
   window and shuffles the plain text once to drop repeats;
2. ``mark_messages`` parses each remaining message fully and decides, in the same row, what
   is accepted and what is set aside, so no join is needed to tell items of rejected orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clip, join_messages, parse_iso, to_cents
from .contracts import ITEM_CHECKS, ORDER_CHECKS, breaks_contract, contract_errors
from .deadletters import COUNTED, MAPPER_ERROR, PARENT_REJECTED, SCHEMA_MISMATCH

ORDERS_TABLE, ITEMS_TABLE = "dw.ods_orders", "dw.ods_order_items"

# Scalars are read as text so that "5" and 5 are the same id; the flag keeps its JSON form.
# Items are read twice: as text, kept as the original, and by their known fields.
SOURCE_FILE, KNOWN = "source_file", "known"
KEY_FIELDS = "shop_id string, order_id string, updated_at string"
FEED_FIELDS = (
    "shop_id string, order_id string, status string, buyer_nick string, order_amount string, "
    "payment_amount string, refund_amount string, created_at string, updated_at string, "
    "is_deleted variant, items array<string>, broken string"
)
ITEM_FIELDS = (
    "items array<struct<item_id: string, product_id: string, product_name: string, quantity: string, price: string>>"
)
ORDER_COLUMNS = [
    "shop_id", "order_id", "platform", "order_status", "buyer_nick", "order_amount_cents",
    "payment_amount_cents", "refund_amount_cents", "raw_json", "is_deleted", "created_at",
    "updated_at", "etl_batch_id",
]
ITEM_COLUMNS = [
    "shop_id", "order_id", "item_id", "platform", "product_id", "product_name", "quantity",
    "price_cents", "raw_json", "updated_at", "etl_batch_id",
]


def message_keys(feed: DataFrame) -> DataFrame:
    """Shop, order and update time of each message beside its text.

    ``shop_id`` is the shop a message is counted under: the shop it was fetched for, else
    the one it names.  ``inline(array(...))`` makes the fields generator output, so a
    filter on them is not pushed below the parse and each text is read once.
    """
    key = F.from_json("value", KEY_FIELDS)
    more = [c for c in (SOURCE_FILE, KNOWN) if c in feed.columns]
    return feed.select("platform", "source_shop_id", "value", *more, F.inline(F.array(key))).select(
        "platform",
        F.coalesce("source_shop_id", F.col("shop_id").try_cast("bigint")).alias("shop_id"),
        F.col("shop_id").alias("message_shop"),
        "order_id",
        parse_iso(F.col("updated_at")).alias("message_time"),
        "value", *more,
    )


def file_times(messages: DataFrame) -> DataFrame:
    """Number of messages, first and last update time of each ``source_file``."""
    time = F.col("message_time")
    keyed = message_keys(messages)
    return keyed.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("messages"), F.min(time).alias("first_time"), F.max(time).alias("last_time")
    )


def files_to_read(listing: DataFrame, ledger: DataFrame, since: Column | None) -> DataFrame:
    """``path, known``: files that a run has to read.

    ``ledger`` has one row per file that was read before, as it was then.  Files it does not know, or
    that changed since, are new.  Of the others only those with messages from ``since`` on may hold
    something for the run; without ``since`` all of them do.
    """
    before = ledger.select("path", "bytes", "modified_at", "last_time", F.lit(True).alias("known"))
    met = listing.join(before, ["path", "bytes", "modified_at"], "left")
    late = F.lit(True) if since is None else F.col("last_time") >= since
    return met.where(F.col("known").isNull() | late).select("path", F.coalesce("known", F.lit(False)).alias("known"))


def in_window(start: Column, end: Column) -> Column:
    """Half-open window test; a message without a readable time stays in, to be set aside later."""
    time = F.col("message_time")
    return time.isNull() | ((time >= start) & (time < end))


def newest_messages(keyed: DataFrame) -> DataFrame:
    """One message per order, the newest, with the number of ``copies`` that were read.

    An aggregation rather than a sort of each group: however often one order is repeated,
    every map task sends one row for it.  A message without a complete key cannot repeat an
    order; it stands for itself, only exact copies of its text are one.
    """
    keyless = F.when(F.col("message_shop").isNull() | F.col("order_id").isNull(), F.col("value"))
    newest = F.struct("message_time", F.xxhash64("value"), "value")
    return (
        keyed.groupBy("platform", "shop_id", "message_shop", "order_id", keyless.alias("_keyless"))
        .agg(F.max(newest).alias("_newest"), F.count(F.lit(1)).alias("copies"))
        .select("platform", "shop_id", "copies", F.col("_newest.value").alias("value"))
    )


def _or_default(text: Column, default: str = "") -> Column:
    return F.coalesce(text, F.lit(default))


def _required(name: str, text: Column, mapped: Column) -> Column:
    """Message for a required field that is absent or unreadable, else NULL."""
    return F.when(text.isNull(), F.lit(f"{name}: missing")).when(
        mapped.isNull(), F.concat(F.lit(f"{name}: invalid value "), text)
    )


def _flag(json_value: Column) -> Column:
    """0/1 by the truth of a JSON value: null, false, 0, "" and empty containers are 0."""
    text = F.coalesce(F.to_json(json_value), F.lit("null"))
    empty = text.isin("null", "false", '""', "[]", "{}") | (F.coalesce(text.try_cast("double"), F.lit(1.0)) == 0)
    return F.when(empty, 0).otherwise(1)


def _typed_item(fields: Column, position: Column, batch_id: str) -> Column:
    return F.struct(
        F.col("_shop").alias("shop_id"),
        F.col("order_id").alias("order_id"),
        fields["item_id"].alias("item_id"),
        F.col("platform").alias("platform"),
        _or_default(fields["product_id"]).alias("product_id"),
        _or_default(fields["product_name"]).alias("product_name"),
        _quantity(fields["quantity"], F.get("items", position)).alias("quantity"),
        to_cents(fields["price"]).alias("price_cents"),
        F.get("items", position).alias("raw_json"),
        F.col("_updated").alias("updated_at"),
        F.lit(batch_id).alias("etl_batch_id"),
    )


def _quantity(text: Column, item: Column) -> Column:
    """Whole number; a JSON number with a fraction is truncated, text with one is none.

    Absent or empty is 0, anything unreadable NULL.  Number and text look alike once parsed, so the
    item's own text is asked where it matters.
    """
    whole = text.rlike(r"^\s*[+-]?[0-9]+\s*$")
    number = F.when(whole | ~item.rlike(r'"quantity"\s*:\s*"'), text.try_cast("decimal(20,6)").try_cast("int"))
    return (
        F.when(text.rlike(r"^[0-9]{1,9}\z"), text.try_cast("int"))  # nearly all of them, without a decimal
        .when(F.coalesce(text, F.lit("")) == "", F.lit(0))
        .otherwise(number)
    )


def map_messages(messages: DataFrame, batch_id: str) -> DataFrame:
    """Full parse and typing of each message.

    Adds ``order_row`` (ODS order columns), ``order_error``, ``item_rows`` (ODS item
    columns) and ``item_error``; an error is NULL when there is none.  One bad item is an
    error of all items of its order; an order may have no items.
    """
    parsed = messages.withColumnRenamed("shop_id", "counted_shop").select(
        "platform", "counted_shop", "copies", "value", F.from_json("value", ITEM_FIELDS)["items"].alias("lines"),
        F.inline(F.array(F.from_json("value", FEED_FIELDS, {"columnNameOfCorruptRecord": "broken"}))),
    )
    typed = parsed.withColumns(
        {
            "_shop": F.col("shop_id").try_cast("bigint"),
            "_created": parse_iso(F.col("created_at")),
            "_updated": parse_iso(F.col("updated_at")),
            "_amount": to_cents(F.col("order_amount")),
            "_paid": to_cents(F.col("payment_amount")),
            "_refund_text": F.nullif(F.col("refund_amount"), F.lit("")),
            "_unreadable": F.col("broken").isNotNull() & F.col("order_id").isNull() & F.col("shop_id").isNull(),
        }
    ).withColumns(
        {
            "_refund": F.when(F.col("_refund_text").isNull(), F.lit(0).cast("bigint")).otherwise(
                to_cents(F.col("_refund_text"))
            ),
            "item_rows": F.transform("lines", lambda line, i: _typed_item(line, i, batch_id)),
        }
    )
    key_errors = [
        F.when(F.col("_unreadable"), F.lit("message: not a readable object")),
        _required("shop_id", F.col("shop_id"), F.col("_shop")),
        _required("order_id", F.col("order_id"), F.col("order_id")),
    ]
    time_error = _required("updated_at", F.col("updated_at"), F.col("_updated"))
    order_error = join_messages(
        *key_errors,
        _required("order_amount", F.col("order_amount"), F.col("_amount")),
        _required("payment_amount", F.col("payment_amount"), F.col("_paid")),
        F.when(F.col("_refund").isNull(), F.concat(F.lit("refund_amount: invalid value "), F.col("_refund_text"))),
        _required("created_at", F.col("created_at"), F.col("_created")),
        time_error,
    )
    bad_item = F.exists(
        "item_rows", lambda i: i["item_id"].isNull() | i["quantity"].isNull() | i["price_cents"].isNull()
    )
    item_error = join_messages(
        *key_errors,
        time_error,
        F.when(
            (F.col("broken").isNotNull() & ~F.col("_unreadable"))
            | (F.col("items").isNotNull() & (F.col("lines").isNull() | F.exists("lines", lambda x: x.isNull()))),
            F.lit("items: not a list of objects"),
        ),
        F.when(F.coalesce(bad_item, F.lit(False)), F.lit("items: an item lacks its id or has an invalid number")),
    )
    order_row = F.struct(
        F.col("_shop").alias("shop_id"),
        F.col("order_id").alias("order_id"),
        F.col("platform").alias("platform"),
        _or_default(F.col("status")).alias("order_status"),
        _or_default(F.col("buyer_nick")).alias("buyer_nick"),
        F.col("_amount").alias("order_amount_cents"),
        F.col("_paid").alias("payment_amount_cents"),
        F.col("_refund").alias("refund_amount_cents"),
        F.col("value").alias("raw_json"),
        _flag(F.col("is_deleted")).alias("is_deleted"),
        F.col("_created").alias("created_at"),
        F.col("_updated").alias("updated_at"),
        F.lit(batch_id).alias("etl_batch_id"),
    )
    return typed.select(
        F.col("counted_shop").alias("shop_id"), "platform", "copies", "value",
        order_row.alias("order_row"), order_error.alias("order_error"),
        F.coalesce("item_rows", F.array()).alias("item_rows"), item_error.alias("item_error"),
    )


def _letter(table: str, raw: Column, kind: Column | str, message: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        raw.alias("raw_row"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("error_type"),
        clip(message).alias("error_msg"),
    )


def mark_messages(mapped: DataFrame) -> DataFrame:
    """Accepted rows and dead letters of each message, side by side in one row.

    ``order_row`` is NULL when the order is rejected, ``item_rows`` holds accepted items
    only.  Items of a rejected order are set aside as well, each with its parent's reason.
    Reasons are written, item by item, only in messages that have something to set aside.
    """
    breach = contract_errors(ORDER_COLUMNS, ORDER_CHECKS, value=lambda c: F.col("order_row")[c])
    checked = mapped.withColumn("order_breach", F.when(F.col("order_error").isNull(), breach)).withColumn(
        "rejected", F.coalesce("order_error", "order_breach")
    )
    order_ok, items_ok = F.col("rejected").isNull(), F.col("item_error").isNull()
    broken = F.exists("item_rows", lambda i: breaks_contract(ITEM_COLUMNS, ITEM_CHECKS, value=lambda c: i[c]))
    some = F.col("some")

    def judged(item: Column) -> Column:
        breach = contract_errors(ITEM_COLUMNS, ITEM_CHECKS, value=lambda c: item[c])
        return F.struct(item.alias("row"), breach.alias("breach"))

    def item_letter(item: Column) -> Column:
        row, breach = item["row"], item["breach"]
        return F.when(
            F.col("rejected").isNotNull(),
            _letter(ITEMS_TABLE, F.to_json(row), PARENT_REJECTED, F.concat(F.lit("order rejected: "), F.col("rejected"))),
        ).when(breach.isNotNull(), _letter(ITEMS_TABLE, F.to_json(row), SCHEMA_MISMATCH, breach))

    order_letter = F.when(
        F.col("order_error").isNotNull(),
        _letter(ORDERS_TABLE, F.col("value"), MAPPER_ERROR, F.col("order_error")),
    ).when(
        F.col("order_breach").isNotNull(),
        _letter(ORDERS_TABLE, F.to_json("order_row"), SCHEMA_MISMATCH, F.col("order_breach")),
    )
    items_letter = F.when(~items_ok, _letter(ITEMS_TABLE, F.col("value"), MAPPER_ERROR, F.col("item_error")))
    item_letters = F.when(items_ok, F.transform("judged", item_letter)).otherwise(F.array(items_letter))
    good = F.filter("judged", lambda i: i["breach"].isNull())
    return checked.withColumn("some", ~order_ok | ~items_ok | broken).withColumn(
        "judged", F.when(some, F.transform("item_rows", judged))
    ).select(
        "shop_id", "platform", "copies",
        F.when(order_ok, F.col("order_row")).alias("order_row"),
        F.when(~some, F.col("item_rows"))
        .when(order_ok & items_ok, F.transform(good, lambda i: i["row"]))
        .otherwise(F.slice("item_rows", 1, 0)).alias("item_rows"),
        F.when(some, F.array_compact(F.concat(F.array(order_letter), item_letters))).otherwise(F.array()).alias("letters"),
    )


def _elements(marked: DataFrame, column: str, *beside: str) -> DataFrame:
    """One row per struct of an array column.

    The outer form, with its empty rows filtered after it: from the plain one the optimizer infers a
    filter on the array's size, and computes the array once more for it right after the parse.
    """
    rows = marked.select(*beside, F.explode_outer(column).alias("_element"))
    return rows.where(F.col("_element").isNotNull()).select(*beside, "_element.*")


def _single(frame: DataFrame, row: Column) -> DataFrame:
    """The struct of each row that has one. A filter before it would be pushed below the parse, with a second copy of all that it asks for."""
    return _elements(frame.select(F.array(row).alias("_rows")), "_rows")


def mapped_orders(mapped: DataFrame) -> DataFrame:
    """Order rows of the messages that could be read, before their contract."""
    return _single(mapped, F.when(F.col("order_error").isNull(), F.col("order_row")))


def mapped_items(mapped: DataFrame) -> DataFrame:
    """Item rows of the messages whose items could all be read, before their contract."""
    return _elements(mapped.select(F.when(F.col("item_error").isNull(), F.col("item_rows")).alias("item_rows")), "item_rows")


def accepted_orders(marked: DataFrame) -> DataFrame:
    return _single(marked, F.col("order_row"))


def accepted_items(marked: DataFrame) -> DataFrame:
    return _elements(marked, "item_rows")


def letters_of(marked: DataFrame) -> DataFrame:
    """One row per dead letter, with the shop and platform it is counted under."""
    return _elements(marked, "letters", "shop_id", "platform")


def dead_letter_rates(marked: DataFrame, limit: float) -> DataFrame:
    """Per shop: messages read, counted dead letters, their rate and whether it exceeds ``limit``.

    Item failures count over the number of orders, so a rate may exceed 1; items of rejected
    orders are not counted.  A limit of 0 or less switches the gate off.
    """
    counted = F.size(F.filter("letters", lambda x: x["error_type"].isin(*COUNTED)))
    return (
        marked.groupBy("shop_id", "platform")
        .agg(F.sum("copies").alias("rows_read"), F.sum(counted).alias("dead_letters"))
        .withColumn("dead_rate", F.col("dead_letters").cast("double") / F.col("rows_read"))
        .withColumn(
            "over_limit", F.when(F.lit(limit > 0) & (F.col("dead_rate") > F.lit(float(limit))), 1).otherwise(0)
        )
    )
