"""Headline timings on one node; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores) and BENCH_RUNS
(default 3) set data, cores and warm runs per query, BENCH_ROOT the folder of the warehouse.
A query is timed to its last row (a ``noop`` sink); jobs are timed on stored tables in a
temporary warehouse.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from datetime import date, datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shopstrata.plans import build, ingest, upsert  # noqa: E402
from shopstrata.plans.queries import QUERIES  # noqa: E402
from shopstrata.sources import sample  # noqa: E402
from shopstrata.sources.tables import Warehouse  # noqa: E402

NAMES = (
    "shop_daily", "product_daily", "dim_product", "shop_overview", "daily_kpi", "dedup_latest", "merge_monotonic",
    "scd2_apply", "dead_letters", "dq_run_all", "dq_unique", "dq_referential", "ops_duration_p95",
)
SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return time.perf_counter() - started


def query_seconds(spark: SparkSession, name: str) -> float:
    def run() -> None:
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    run()
    return statistics.median(timed(run) for _ in range(RUNS))


def job_seconds(spark: SparkSession) -> tuple[dict[str, float], int]:
    """Bulk load of orders and items, the same load again, and a full build on top."""
    root = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("BENCH_ROOT"))
    wh = Warehouse(spark, root, grain="year")
    extra = {"raw_json": F.lit("{}"), "etl_batch_id": F.lit("bench")}
    orders = wh.stage(sample.ods_orders(spark, SF_DIR).withColumns(extra), "orders").df
    items = wh.stage(sample.ods_items(spark, SF_DIR).withColumns(extra), "items").df
    rows = orders.count() + items.count()

    def load() -> None:
        upsert.upsert(wh, "dw.ods_orders", orders)
        upsert.upsert(wh, "dw.ods_order_items", items)

    shops = [
        {"shop_id": r.shop_id, "platform": r.platform, "shop_name": f"shop {r.shop_id}", "status": "active"}
        for r in orders.select("shop_id", "platform").distinct().collect()
    ]

    def full_build() -> None:
        build.build_warehouse(wh, shops, since=date(1995, 1, 1), now=datetime(2001, 8, 1))

    def rebuild() -> None:
        build.build_warehouse(wh, shops, since=date(2001, 7, 30), now=datetime(2001, 8, 1))

    out = {"bulk_load_insert": timed(load), "bulk_load_rerun": timed(load)}
    out["full_build_first"] = timed(full_build)
    out["full_build"] = statistics.median(timed(full_build) for _ in range(max(1, RUNS - 1)))
    out["rebuild_3_days"] = timed(rebuild)
    feed_wh = Warehouse(spark, f"{root}/feed", grain="year")
    messages = sample.feed_messages(spark, SF_DIR)
    given = {"now": datetime(2001, 8, 1), "settings": ingest.IngestSettings(dead_letter_limit=0.0)}
    out["ingest_batch"] = timed(lambda: ingest.ingest_batch(feed_wh, messages, run_type="full", **given))
    out["ingest_stream_batch"] = timed(lambda: ingest.ingest_batch(feed_wh, messages, run_type=ingest.STREAM, **given))
    return out, rows


def main() -> None:
    spark = session()
    seconds = {name: round(query_seconds(spark, name), 3) for name in NAMES}
    jobs, rows = job_seconds(spark)
    seconds.update({name: round(s, 3) for name, s in jobs.items()})
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "ods_rows": rows,
                "rows_per_second": {
                    "bulk_load": round(rows / seconds["bulk_load_insert"]),
                    "full_build": round(rows / seconds["full_build"]),
                },
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
