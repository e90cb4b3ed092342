"""Product, calendar and shop dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import wall

# Days without a sale after which a product is inactive, the statutory
# holidays with their names, and the calendar columns a refresh may change.
PRODUCT_ACTIVE_DAYS = 90
HOLIDAYS: dict[date, str] = {
    date(2026, 1, 1): "元旦",
    date(2026, 5, 1): "劳动节",
    date(2026, 10, 1): "国庆节",
    date(2026, 10, 2): "国庆节",
    date(2026, 10, 3): "国庆节",
}
REFRESHED_DATE_COLUMNS = ("is_weekend", "is_holiday", "holiday_name")
SHOP_ATTRIBUTES = ("shop_name", "status")


def product_sightings(items: DataFrame, *more: str) -> DataFrame:
    """First and last sighting of every name of a product, by shop and ``more`` columns.

    Plain min/max on the hash path, combined before the shuffle.  Sightings of any split of the
    items can be put together by ``product_dimension_of``, so those of a period that did not change
    need not be made again.
    """
    return items.groupBy("shop_id", "product_id", "product_name", *more).agg(
        F.min("updated_at").alias("first_seen_at"), F.max("updated_at").alias("last_seen_at")
    )


def product_dimension(items: DataFrame, now: datetime) -> DataFrame:
    """Latest name, first and last sighting and active flag per shop and product."""
    return product_dimension_of(product_sightings(items), now)


def product_dimension_of(sightings: DataFrame, now: datetime) -> DataFrame:
    """The product dimension of sightings; only this small input is compared by name."""
    return (
        sightings.groupBy("shop_id", "product_id")
        .agg(
            F.max_by("product_name", F.struct("last_seen_at", "product_name")).alias("product_name"),
            F.min("first_seen_at").alias("first_seen_at"),
            F.max("last_seen_at").alias("last_seen_at"),
        )
        .withColumn(
            "is_active",
            F.when(F.col("last_seen_at") >= wall(now) - F.make_dt_interval(F.lit(PRODUCT_ACTIVE_DAYS)), 1).otherwise(0),
        )
    )


def calendar(bounds: DataFrame, holidays: Mapping[date, str] | None = None) -> DataFrame:
    """One row per day of the closed ranges in ``bounds`` (columns ``first_day, last_day``)."""
    named = HOLIDAYS if holidays is None else holidays
    names = F.lit(None).cast("string")
    if named:
        table = F.create_map(*[x for d in sorted(named) for x in (F.lit(d), F.lit(named[d]))])
        names = F.try_element_at(table, F.col("stat_date"))
    day = F.col("stat_date")
    weekday = F.weekday(day) + 1
    return (
        bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("stat_date"))
        .distinct()
        .select(
            F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
            day,
            F.year(day).alias("year_num"),
            F.quarter(day).alias("quarter_num"),
            F.month(day).alias("month_num"),
            F.dayofmonth(day).alias("day_num"),
            F.weekofyear(day).alias("week_of_year"),
            weekday.alias("day_of_week"),
            F.when(weekday >= 6, 1).otherwise(0).alias("is_weekend"),
            F.when(names.isNotNull(), 1).otherwise(0).alias("is_holiday"),
            names.alias("holiday_name"),
        )
    )


def shop_changes(
    registry: DataFrame, versions: DataFrame, effective: date, attributes: Sequence[str] = SHOP_ATTRIBUTES
) -> DataFrame:
    """Compare registered shops with the current versions of the shop dimension.

    One row per change: ``open`` a version for a new or changed shop, ``close`` the current
    version of a changed or removed one.  Equal shops give no row.
    """
    keys = ["shop_id", "platform"]
    current = versions.where("is_current = 1").select(
        *keys, "shop_key", *[F.col(a).alias(f"_cur_{a}") for a in attributes], F.lit(True).alias("_known")
    )
    wanted = registry.select(*keys, *attributes, F.lit(True).alias("_listed"))
    same = F.lit(True)
    for a in attributes:
        same &= F.col(a).eqNullSafe(F.col(f"_cur_{a}"))
    listed, known = F.col("_listed").isNotNull(), F.col("_known").isNotNull()
    actions = F.array_compact(
        F.array(
            F.when(known & ~(listed & same), F.lit("close")),
            F.when(listed & ~(known & same), F.lit("open")),
        )
    )
    opening = F.col("change") == "open"
    return (
        wanted.join(current, keys, "full_outer")
        .withColumn("change", F.explode(actions))
        .select(
            "change", *keys,
            *[F.when(opening, F.col(a)).otherwise(F.col(f"_cur_{a}")).alias(a) for a in attributes],
            F.when(~opening, F.col("shop_key")).alias("shop_key"),
            F.when(opening, F.lit(effective)).alias("valid_from"),
            F.when(~opening, F.lit(effective)).alias("valid_to"),
            F.when(opening, 1).otherwise(0).alias("is_current"),
        )
    )


def apply_shop_changes(versions: DataFrame, changes: DataFrame) -> DataFrame:
    """The shop dimension after ``changes``: old versions closed, new ones added.

    A shop that changes twice on one day keeps a single version for that day: the earlier
    one is replaced instead of being closed with an empty validity.
    """
    closes = changes.where("change = 'close'").select("shop_key", F.col("valid_to").alias("_closed_on"))
    opens = changes.where("change = 'open'")
    reopened = opens.select("shop_id", "platform", F.col("valid_from").alias("_reopened_on"))
    kept = (
        versions.join(closes, "shop_key", "left")
        .join(reopened, ["shop_id", "platform"], "left")
        .withColumn("_closing", F.col("_closed_on").isNotNull())
        .where(~(F.col("_closing") & F.coalesce(F.col("valid_from") == F.col("_reopened_on"), F.lit(False))))
        .select(
            "shop_key", "shop_id", "platform", "shop_name", "status", "valid_from",
            F.when(F.col("_closing"), F.col("_closed_on")).otherwise(F.col("valid_to")).alias("valid_to"),
            F.when(F.col("_closing"), 0).otherwise(F.col("is_current")).alias("is_current"),
        )
    )
    fresh = opens.select(
        F.xxhash64("shop_id", "platform", "valid_from").alias("shop_key"),
        "shop_id", "platform", "shop_name", "status", "valid_from",
        F.lit(None).cast("date").alias("valid_to"), "is_current",
    )
    return kept.unionByName(fresh)
