"""Table definitions of the warehouse: columns, keys and physical partitioning.

Money is always whole cents in a BIGINT, times are wall-clock values without a zone,
flags are 0/1 integers.  Every table is read with the schema below, never inferred.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG, INT, STR, DATE, TS = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.TimestampNTZType()
RATE = T.DecimalType(9, 4)
PCT = T.DecimalType(12, 4)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


ODS_ORDERS = _schema(
    shop_id=LONG, order_id=STR, platform=STR, order_status=STR, buyer_nick=STR,
    order_amount_cents=LONG, payment_amount_cents=LONG, refund_amount_cents=LONG,
    raw_json=STR, is_deleted=INT, created_at=TS, updated_at=TS, etl_batch_id=STR,
)
ODS_ITEMS = _schema(
    shop_id=LONG, order_id=STR, item_id=STR, platform=STR, product_id=STR, product_name=STR,
    quantity=INT, price_cents=LONG, raw_json=STR, updated_at=TS, etl_batch_id=STR,
)
DWD_ORDERS = _schema(
    shop_id=LONG, order_id=STR, platform=STR, status_raw=STR, status_norm=STR, buyer_nick=STR,
    order_amount_cents=LONG, payment_amount_cents=LONG, refund_amount_cents=LONG,
    is_deleted=INT, created_at=TS, updated_at=TS, stat_date=DATE, etl_batch_id=STR,
)
DWD_ITEMS = _schema(
    shop_id=LONG, order_id=STR, item_id=STR, platform=STR, product_id=STR, product_name=STR,
    quantity=INT, price_cents=LONG, amount_cents=LONG, updated_at=TS, etl_batch_id=STR,
)
DIM_SHOP = _schema(
    shop_key=LONG, shop_id=LONG, platform=STR, shop_name=STR, status=STR,
    valid_from=DATE, valid_to=DATE, is_current=INT,
)
DIM_DATE = _schema(
    date_key=INT, stat_date=DATE, year_num=INT, quarter_num=INT, month_num=INT, day_num=INT,
    week_of_year=INT, day_of_week=INT, is_weekend=INT, is_holiday=INT, holiday_name=STR,
)
DIM_PRODUCT = _schema(
    product_key=LONG, shop_id=LONG, product_id=STR, product_name=STR,
    first_seen_at=TS, last_seen_at=TS, is_active=INT,
)
DWS_SHOP_DAILY = _schema(
    stat_date=DATE, shop_id=LONG, platform=STR, gmv_cents=LONG, order_cnt=INT, buyer_cnt=INT,
    refund_cents=LONG, avg_order_cents=LONG,
)
DWS_PRODUCT_DAILY = _schema(
    stat_date=DATE, shop_id=LONG, product_id=STR, platform=STR, sold_qty=INT, sales_cents=LONG,
)
ADS_SHOP_OVERVIEW = _schema(
    stat_date=DATE, shop_id=LONG, platform=STR, gmv_cents=LONG, order_cnt=INT, buyer_cnt=INT,
    refund_cents=LONG, avg_order_cents=LONG, refund_rate=RATE, gmv_dod_pct=PCT, order_dod_pct=PCT,
    active_product_cnt=INT, product_total_cnt=INT, sell_through_rate=RATE,
)
ADS_DAILY_KPI = _schema(
    stat_date=DATE, platform=STR, gmv_cents=LONG, order_cnt=INT, buyer_cnt=INT, refund_cents=LONG,
    avg_order_cents=LONG, shop_cnt=INT, gmv_dod_pct=PCT,
)
WATERMARK = _schema(
    table_name=STR, shop_id=LONG, platform=STR, watermark_value=TS, watermark_type=STR, updated_at=TS,
)
BATCH_EVENT = _schema(
    batch_id=STR, table_name=STR, shop_id=LONG, platform=STR, run_type=STR,
    window_start=TS, window_end=TS, status=STR, rows_read=LONG, rows_written=LONG,
    error_msg=STR, started_at=TS, ended_at=TS, event_seq=INT,
)
TASK_RUN = _schema(
    run_id=STR, dag_id=STR, task_id=STR, data_interval_start=TS, data_interval_end=TS,
    status=STR, error=STR, duration_ms=LONG, started_at=TS, ended_at=TS,
)
LOAD_ERROR = _schema(
    error_key=LONG, batch_id=STR, table_name=STR, shop_id=LONG, platform=STR, raw_row=STR,
    error_type=STR, error_msg=STR, created_at=TS,
)
DQ_DEF = _schema(
    check_id=LONG, table_name=STR, rule_type=STR, params=STR, severity=STR, enabled=INT, created_at=TS,
)
DQ_RESULT = _schema(
    check_id=LONG, batch_id=STR, shop_id=LONG, platform=STR, stat_date=DATE, actual_value=STR,
    expected_value=STR, passed=INT, detail=STR, evaluated_at=TS,
)
MOVED_DAY = _schema(shop_id=LONG, platform=STR, stat_date=DATE, recorded_at=TS)
PRODUCT_SIGHTING = _schema(
    shop_id=LONG, platform=STR, product_id=STR, product_name=STR, first_seen_at=TS, last_seen_at=TS, period=STR,
)
FEED_FILE = _schema(
    path=STR, bytes=LONG, modified_at=TS, messages=LONG, first_time=TS, last_time=TS, batch_id=STR, read_at=TS,
)
ALERT = _schema(batch_id=STR, title=STR, text=STR, level=STR, created_at=TS)


@dataclass(frozen=True)
class TableSpec:
    """One stored table.

    ``dated_by`` names the columns whose first non-null value is the date a row is
    physically filed under; an empty tuple means a small, unpartitioned table.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    dated_by: tuple[str, ...] = ()
    #: First columns of the key that an index is filed by (0: all), so that they can be looked up alone.
    bucketed: int = 0
    #: A column that names the period itself.
    filed_as: str = ""

    @property
    def bucket_key(self) -> tuple[str, ...]:
        return self.key[: self.bucketed] if self.bucketed else self.key

    @property
    def merged_by_key(self) -> bool:
        """Whether rows are merged by key and update time, in small merges as deltas."""
        return bool(self.key and self.dated_by) and "updated_at" in self.schema.fieldNames()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def filing_date(self) -> Column:
        return F.to_date(F.coalesce(*[F.col(c).cast("timestamp_ntz") for c in self.dated_by]))


TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec("dw.ods_orders", ODS_ORDERS, ("shop_id", "order_id"), ("created_at", "updated_at")),
        TableSpec("dw.ods_order_items", ODS_ITEMS, ("shop_id", "order_id", "item_id"), ("updated_at",), bucketed=2),
        TableSpec("dw.dwd_orders", DWD_ORDERS, ("shop_id", "order_id"), ("stat_date",)),
        TableSpec("dw.dwd_order_items", DWD_ITEMS, ("shop_id", "order_id", "item_id"), ("updated_at",)),
        TableSpec("dw.dim_shop", DIM_SHOP, ("shop_key",)),
        TableSpec("dw.dim_date", DIM_DATE, ("date_key",)),
        TableSpec("dw.dim_product", DIM_PRODUCT, ("shop_id", "product_id")),
        TableSpec("dw.dws_shop_daily", DWS_SHOP_DAILY, ("stat_date", "shop_id"), ("stat_date",)),
        TableSpec("dw.dws_product_daily", DWS_PRODUCT_DAILY, ("stat_date", "shop_id", "product_id"), ("stat_date",)),
        TableSpec("dw.ads_shop_overview", ADS_SHOP_OVERVIEW, ("stat_date", "shop_id"), ("stat_date",)),
        TableSpec("dw.ads_daily_kpi", ADS_DAILY_KPI, ("stat_date", "platform"), ("stat_date",)),
        TableSpec("dw.dim_product_sighting", PRODUCT_SIGHTING, (), filed_as="period"),
        TableSpec("etl_meta.moved_day", MOVED_DAY, ("shop_id", "platform", "stat_date")),
        TableSpec("etl_meta.etl_feed_file", FEED_FILE, ("path",), ("read_at",)),
        TableSpec("etl_meta.etl_watermark", WATERMARK, ("table_name", "shop_id", "platform")),
        TableSpec("etl_meta.etl_batch", BATCH_EVENT, ("batch_id",), ("started_at",)),
        TableSpec("etl_meta.etl_task_run", TASK_RUN, ("run_id",), ("started_at",)),
        TableSpec("etl_meta.etl_load_error", LOAD_ERROR, ("error_key",), ("created_at",)),
        TableSpec("etl_meta.dq_check_def", DQ_DEF, ("check_id",)),
        TableSpec("etl_meta.dq_check_result", DQ_RESULT, (), ("evaluated_at",)),
        TableSpec("etl_meta.alert", ALERT, (), ("created_at",)),
    )
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: absent columns become NULL, unknown ones are dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
