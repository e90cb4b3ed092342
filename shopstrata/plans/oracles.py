"""SQL twins of the named queries, written independently of the operators.

``CTES`` are the building blocks; ``SQL`` is the final SELECT of each query.  ``oracle``
puts the blocks a query needs in front of it.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}
SQL: dict[str, str] = {}

# ---- sample views ------------------------------------------------------------------------

CTES["ods_orders"] = """
SELECT CAST(n.n_regionkey + 1 AS BIGINT) AS shop_id,
       CAST(o.o_orderkey AS VARCHAR) AS order_id,
       CASE WHEN n.n_regionkey % 2 = 0 THEN 'alpha' ELSE 'beta' END AS platform,
       CASE WHEN o.o_orderkey % 211 = 0 THEN NULL
            WHEN o.o_orderkey % 17 = 0 THEN 'TRADE_MYSTERY'
            WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 10 = 0 THEN 'cancelled'
            WHEN o.o_orderstatus = 'F' THEN 'completed'
            WHEN o.o_orderstatus = 'O' AND o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'shipped'
            WHEN o.o_orderstatus = 'O' THEN 'paid'
            ELSE 'pending' END AS order_status,
       CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE c.c_name END AS buyer_nick,
       CAST(ROUND(o.o_totalprice * 100) AS BIGINT) AS order_amount_cents,
       CAST(ROUND(o.o_totalprice * 100) AS BIGINT) AS payment_amount_cents,
       CASE WHEN o.o_orderkey % 19 = 0 THEN CAST(ROUND(o.o_totalprice * 100) AS BIGINT)
            ELSE CAST(0 AS BIGINT) END AS refund_amount_cents,
       CASE WHEN o.o_orderkey % 53 = 0 THEN 1 ELSE 0 END AS is_deleted,
       CASE WHEN o.o_orderkey % 101 = 0 THEN NULL
            ELSE o.o_orderdate + INTERVAL '1' SECOND * (o.o_orderkey * 37 % 86400) END AS created_at,
       o.o_orderdate + INTERVAL '1' SECOND * (o.o_orderkey * 37 % 86400 + o.o_orderkey * 7919 % 36000) AS updated_at
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey"""

CTES["items_feed"] = """
SELECT h.shop_id, h.order_id, CAST(l.l_linenumber AS VARCHAR) AS item_id, h.platform,
       'P' || LPAD(CAST(l.l_partkey AS VARCHAR), GREATEST(5, LENGTH(CAST(l.l_partkey AS VARCHAR)))::INT, '0') AS product_id,
       p.p_name || ' ' || l.l_returnflag AS product_name,
       CASE WHEN l.l_orderkey % 89 = 0 THEN NULL ELSE CAST(l.l_quantity AS INT) END AS quantity,
       CAST(ROUND(l.l_extendedprice * 100) AS BIGINT) AS price_cents,
       l.l_shipdate AS updated_at
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
     JOIN ods_orders h ON h.order_id = CAST(l.l_orderkey AS VARCHAR)"""

CTES["ods_items"] = """
SELECT shop_id, order_id, item_id, platform, product_id, product_name, quantity, price_cents, updated_at
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY shop_id, order_id, item_id
             ORDER BY updated_at DESC NULLS LAST, product_id DESC NULLS LAST, quantity DESC NULLS LAST,
                      price_cents DESC NULLS LAST) AS nth FROM items_feed) WHERE nth = 1"""

CTES["existing"] = "SELECT * FROM ods_orders WHERE updated_at < TIMESTAMP '2000-01-01 00:00:00'"

CTES["incoming"] = """
SELECT shop_id, order_id, platform, order_status, buyer_nick, order_amount_cents,
       payment_amount_cents + 1 AS payment_amount_cents, refund_amount_cents, is_deleted, created_at,
       updated_at + INTERVAL '1' SECOND * (CASE WHEN CAST(order_id AS BIGINT) % 10 = 0 THEN 0
            WHEN CAST(order_id AS BIGINT) % 4 = 0 THEN 3600 WHEN CAST(order_id AS BIGINT) % 4 = 2 THEN -3600
            ELSE 60 END) AS updated_at
FROM ods_orders"""

CTES["etl_batch"] = """
SELECT CAST(event_id AS VARCHAR) AS batch_id,
       CASE WHEN event_id % 2 = 0 THEN 'dw.ods_orders' ELSE 'dw.ods_order_items' END AS table_name,
       user_id % 5 + 1 AS shop_id,
       CASE WHEN user_id % 5 % 2 = 0 THEN 'alpha' ELSE 'beta' END AS platform,
       CASE WHEN event_type = 'signup' THEN 'backfill' ELSE 'incremental' END AS run_type,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
       CAST(ROUND(value) AS BIGINT) AS rows_read,
       ts - INTERVAL '5' MINUTE AS window_end, ts AS started_at
FROM events"""

CTES["etl_watermark"] = """
SELECT table_name, shop_id, platform, MAX(window_end) AS watermark_value FROM etl_batch
WHERE status = 'success' AND run_type = 'incremental' GROUP BY table_name, shop_id, platform"""

# ---- feed: what the messages must turn into, computed from the rows they were made of -----

_FAULT = "(k > 0 AND k % {0} = 0)".format

CTES["feed"] = f"""
SELECT o.*, copy, k,
       CASE WHEN {_FAULT(313)} THEN NULL ELSE order_id END AS message_order,
       payment_amount_cents + copy * 100 AS paid_cents,
       updated_at + INTERVAL '1' HOUR * copy AS message_time
FROM (SELECT *, CAST(order_id AS BIGINT) AS k FROM ods_orders) o
     JOIN (SELECT 0 AS copy UNION ALL SELECT 1) c ON copy = 0 OR {_FAULT(331)}"""

CTES["newest"] = """
SELECT * FROM feed f WHERE message_order IS NULL
   OR copy = (SELECT MAX(g.copy) FROM feed g WHERE g.order_id = f.order_id)"""

CTES["feed_items"] = f"""
SELECT n.k, n.message_order, n.copy, i.shop_id, i.order_id, i.item_id, i.platform, i.product_id, i.product_name,
       CASE WHEN (n.k > 0 AND n.k % 317 = 0) AND first_item THEN 0 ELSE COALESCE(i.quantity, 0) END AS quantity,
       CASE WHEN (n.k > 0 AND n.k % 337 = 0) AND first_item THEN NULL ELSE i.price_cents END AS price_cents,
       n.message_time AS updated_at
FROM newest n JOIN (SELECT *, item_id = MIN(item_id) OVER (PARTITION BY order_id) AS first_item FROM ods_items) i
     ON i.order_id = n.order_id"""

CTES["message_state"] = f"""
SELECT n.*,
       NULLIF(CONCAT_WS('; ', CASE WHEN message_order IS NULL THEN 'order_id: missing' END,
                 CASE WHEN {_FAULT(307)} THEN 'order_amount: invalid value abc' END,
                 CASE WHEN created_at IS NULL THEN 'created_at: missing' END), '') AS order_error,
       CASE WHEN {_FAULT(311)} THEN 'order_amount_cents: at least 0, got -500' END AS order_breach,
       NULLIF(CONCAT_WS('; ', CASE WHEN message_order IS NULL THEN 'order_id: missing' END,
                 CASE WHEN EXISTS (SELECT 1 FROM feed_items i WHERE i.k = n.k AND i.price_cents IS NULL)
                      THEN 'items: an item lacks its id or has an invalid number' END), '') AS item_error
FROM newest n"""

CTES["letters"] = """
SELECT 'dw.ods_orders' AS table_name, shop_id, platform, 'mapper_error' AS error_type, order_error AS error_msg,
       message_order AS order_id
FROM message_state WHERE order_error IS NOT NULL
UNION ALL
SELECT 'dw.ods_orders', shop_id, platform, 'schema_mismatch', order_breach, message_order
FROM message_state WHERE order_error IS NULL AND order_breach IS NOT NULL
UNION ALL
SELECT 'dw.ods_order_items', shop_id, platform, 'mapper_error', item_error, message_order
FROM message_state WHERE item_error IS NOT NULL
UNION ALL
SELECT 'dw.ods_order_items', i.shop_id, i.platform,
       CASE WHEN COALESCE(m.order_error, m.order_breach) IS NOT NULL THEN 'parent_rejected' ELSE 'schema_mismatch' END,
       COALESCE('order rejected: ' || COALESCE(m.order_error, m.order_breach),
                'quantity: more than 0, got ' || i.quantity), i.order_id
FROM feed_items i JOIN message_state m ON m.k = i.k AND m.copy = i.copy
WHERE m.item_error IS NULL
  AND (COALESCE(m.order_error, m.order_breach) IS NOT NULL OR i.quantity <= 0)"""

SQL["scan_update_window"] = """
SELECT platform, shop_id, message_order AS order_id, message_time FROM feed
WHERE message_time >= TIMESTAMP '1996-01-01 00:00:00' AND message_time < TIMESTAMP '2001-07-01 00:00:00'"""

SQL["scan_new_files"] = """
SELECT path, known FROM (
    SELECT 'shop_id=' || shop_id || '/' || CAST(CAST(updated_at AS DATE) AS VARCHAR) || '.json' AS path,
           CAST(day(CAST(updated_at AS DATE)) <= 14 AND day(CAST(updated_at AS DATE)) % 5 <> 0 AS INT) AS known,
           MAX(updated_at) AS last_time
    FROM ods_orders GROUP BY 1, 2)
WHERE known = 0 OR last_time >= TIMESTAMP '1999-06-01 00:00:00'"""
SQL["scan_business_window"] = """
SELECT shop_id, order_id, order_status, buyer_nick, order_amount_cents, payment_amount_cents, refund_amount_cents,
       is_deleted, created_at, updated_at
FROM ods_orders WHERE CAST(COALESCE(created_at, updated_at) AS DATE) BETWEEN DATE '1998-01-01' AND DATE '2001-08-01'"""

# Half to even on exact thousandths: the text has three decimals.
SQL["yuan_to_cents"] = """
SELECT l_orderkey, l_linenumber, yuan,
       CASE WHEN yuan IS NULL OR yuan = 'abc' THEN NULL ELSE
            (CASE WHEN l_orderkey % 311 = 0 THEN -1 ELSE 1 END) * (t // 10 + CASE
              WHEN t % 10 > 5 THEN 1 WHEN t % 10 = 5 AND (t // 10) % 2 = 1 THEN 1 ELSE 0 END) END AS cents
FROM (SELECT l_orderkey, l_linenumber, t,
             CASE WHEN l_orderkey % 307 = 0 THEN 'abc' WHEN l_orderkey % 313 = 0 THEN NULL
                  WHEN l_orderkey % 311 = 0 THEN '-' || txt ELSE txt END AS yuan
      FROM (SELECT *, CAST(t // 1000 AS VARCHAR) || '.' || LPAD(CAST(t % 1000 AS VARCHAR), 3, '0') AS txt
            FROM (SELECT *, CAST(ROUND(l_extendedprice * 100) AS BIGINT) * 10 + l_linenumber AS t FROM lineitem)))"""

_MESSAGE_ORDER = """shop_id, message_order AS order_id, platform, COALESCE(order_status, '') AS order_status,
       COALESCE(buyer_nick, '') AS buyer_nick,
       CASE WHEN k > 0 AND k % 311 = 0 THEN -500 ELSE order_amount_cents END AS order_amount_cents,
       paid_cents AS payment_amount_cents, refund_amount_cents, is_deleted, created_at, message_time AS updated_at"""
_MESSAGE_ITEM = """i.shop_id, i.order_id, i.item_id, i.platform, i.product_id, i.product_name, i.quantity,
       i.price_cents, i.updated_at"""

SQL["map_orders"] = f"SELECT {_MESSAGE_ORDER} FROM message_state WHERE order_error IS NULL"
SQL["explode_items"] = f"""
SELECT {_MESSAGE_ITEM} FROM feed_items i JOIN message_state m ON m.k = i.k AND m.copy = i.copy
WHERE m.item_error IS NULL"""
SQL["accepted_orders"] = f"""
SELECT {_MESSAGE_ORDER} FROM message_state WHERE order_error IS NULL AND order_breach IS NULL"""
SQL["accepted_items"] = f"""
SELECT {_MESSAGE_ITEM} FROM feed_items i JOIN message_state m ON m.k = i.k AND m.copy = i.copy
WHERE m.item_error IS NULL AND m.order_error IS NULL AND m.order_breach IS NULL AND i.quantity > 0"""
SQL["dead_letters"] = "SELECT table_name, shop_id, platform, error_type, error_msg, order_id FROM letters"
SQL["dead_letter_rate"] = """
SELECT r.shop_id, r.platform, rows_read, COALESCE(dead, 0) AS dead_letters,
       CAST(COALESCE(dead, 0) AS DOUBLE) / rows_read AS dead_rate,
       CASE WHEN CAST(COALESCE(dead, 0) AS DOUBLE) / rows_read > 0.01 THEN 1 ELSE 0 END AS over_limit
FROM (SELECT shop_id, platform, COUNT(*) AS rows_read FROM feed GROUP BY shop_id, platform) r
     LEFT JOIN (SELECT shop_id, platform, COUNT(*) AS dead FROM letters
                WHERE error_type <> 'parent_rejected' GROUP BY shop_id, platform) x
     ON x.shop_id = r.shop_id AND x.platform = r.platform"""

CTES["order_rows"] = """
SELECT shop_id, order_id, order_status, buyer_nick, created_at,
       CASE WHEN CAST(order_id AS BIGINT) % 23 = 0 THEN -order_amount_cents ELSE order_amount_cents END AS amount
FROM ods_orders"""
CTES["checked_orders"] = """
SELECT shop_id, order_id, amount, NULLIF(CONCAT_WS('; ',
         CASE WHEN order_status IS NULL THEN 'order_status: not null' END,
         CASE WHEN buyer_nick IS NULL THEN 'buyer_nick: not null' END,
         CASE WHEN amount < 0 THEN 'order_amount_cents: at least 0, got ' || amount END,
         CASE WHEN created_at IS NULL THEN 'created_at: not null' END), '') AS error_msg
FROM order_rows"""
SQL["contract_orders"] = "SELECT shop_id, order_id, error_msg FROM checked_orders"
SQL["contract_split"] = """
SELECT CASE WHEN error_msg IS NULL THEN 'good' ELSE 'bad' END AS side, shop_id, order_id,
       amount AS order_amount_cents, error_msg FROM checked_orders"""
SQL["contract_items"] = """
SELECT shop_id, order_id, item_id, NULLIF(CONCAT_WS('; ',
         CASE WHEN q IS NULL THEN 'quantity: not null' WHEN q <= 0 THEN 'quantity: more than 0, got ' || q END,
         CASE WHEN p < 0 THEN 'price_cents: at least 0, got ' || p END), '') AS error_msg
FROM (SELECT *, CASE WHEN price_cents % 29 = 0 THEN 0 ELSE quantity END AS q,
             CASE WHEN item_id = '7' THEN -price_cents ELSE price_cents END AS p FROM ods_items)"""

# ---- merges ------------------------------------------------------------------------------

_ORDER_COLS = [
    "platform", "order_status", "buyer_nick", "order_amount_cents", "payment_amount_cents", "refund_amount_cents",
    "is_deleted", "created_at", "updated_at",
]
CTES["merged"] = """
SELECT COALESCE(n.shop_id, e.shop_id) AS shop_id, COALESCE(n.order_id, e.order_id) AS order_id, {cols},
       CASE WHEN e.order_id IS NULL THEN 'inserted' WHEN n.order_id IS NULL THEN 'kept'
            WHEN n.updated_at > e.updated_at THEN 'updated' ELSE 'ignored' END AS merge_action
FROM existing e FULL OUTER JOIN incoming n ON n.shop_id = e.shop_id AND n.order_id = e.order_id""".format(
    cols=", ".join(
        f"CASE WHEN e.order_id IS NULL OR n.updated_at > e.updated_at THEN n.{c} ELSE e.{c} END AS {c}"
        for c in _ORDER_COLS
    )
)
SQL["dedup_latest"] = "SELECT * FROM ods_items"
SQL["merge_decisions"] = """
SELECT i.shop_id, i.order_id, e.updated_at AS known_at, i.updated_at,
       CASE WHEN e.order_id IS NULL THEN 'inserted' WHEN i.updated_at > e.updated_at THEN 'updated' ELSE 'ignored' END AS merge_action
FROM incoming i LEFT JOIN existing e ON e.shop_id = i.shop_id AND e.order_id = i.order_id"""

SQL["merge_monotonic"] = "SELECT * FROM merged"
SQL["merge_replace"] = """
SELECT * FROM existing UNION ALL
SELECT n.* FROM incoming n WHERE NOT EXISTS (
  SELECT 1 FROM existing e WHERE e.shop_id = n.shop_id AND e.order_id = n.order_id)"""
SQL["table_diff"] = """
SELECT shop_id, order_id, {cols}, CAST(SUM(l) AS BIGINT) AS left_cnt, CAST(SUM(r) AS BIGINT) AS right_cnt
FROM (SELECT shop_id, order_id, {cols}, 1 AS l, 0 AS r FROM ods_orders UNION ALL
      SELECT shop_id, order_id, {cols}, 0, 1 FROM merged)
GROUP BY ALL HAVING SUM(l) <> SUM(r)""".format(cols=", ".join(_ORDER_COLS[:-1]))

# ---- detail, summaries, reports ----------------------------------------------------------


def _dwd(source: str) -> str:
    return f"""
SELECT shop_id, order_id, platform, order_status AS status_raw,
       CASE WHEN order_status IS NULL OR order_status NOT IN ('pending', 'paid', 'shipped', 'completed', 'cancelled',
                 'refunded', 'unknown') THEN 'unknown'
            WHEN order_status IN ('shipped', 'completed') AND refund_amount_cents > 0 AND payment_amount_cents > 0
                 THEN 'refunded' ELSE order_status END AS status_norm,
       buyer_nick, order_amount_cents, payment_amount_cents, refund_amount_cents, is_deleted, created_at, updated_at,
       CAST(COALESCE(created_at, updated_at) AS DATE) AS stat_date, 'b1' AS etl_batch_id
FROM {source}"""


def _shop_days(source: str) -> str:
    return f"""
SELECT stat_date, shop_id, MIN(platform) AS platform, CAST(SUM(payment_amount_cents) AS BIGINT) AS gmv_cents,
       CAST(COUNT(*) AS INT) AS order_cnt,
       CAST(COUNT(DISTINCT buyer_nick) + MAX(CASE WHEN buyer_nick IS NULL THEN 1 ELSE 0 END) AS INT) AS buyer_cnt,
       CAST(SUM(refund_amount_cents) AS BIGINT) AS refund_cents,
       CAST(SUM(payment_amount_cents) // COUNT(*) AS BIGINT) AS avg_order_cents
FROM {source} GROUP BY stat_date, shop_id"""


_PAID = "status_norm IN ('paid', 'shipped', 'completed', 'refunded') AND is_deleted = 0"
CTES["dwd"] = _dwd("ods_orders")
CTES["dwd_corrected"] = _dwd("incoming")
CTES["paid"] = f"SELECT * FROM dwd WHERE {_PAID}"
CTES["shop_days"] = _shop_days("paid")
CTES["product_days"] = """
SELECT p.stat_date, p.shop_id, i.product_id, MIN(p.platform) AS platform,
       CAST(SUM(COALESCE(i.quantity, 0)) AS INT) AS sold_qty,
       CAST(SUM(COALESCE(i.quantity * i.price_cents, 0)) AS BIGINT) AS sales_cents
FROM paid p JOIN ods_items i ON i.shop_id = p.shop_id AND i.order_id = p.order_id
GROUP BY p.stat_date, p.shop_id, i.product_id"""

CTES["dated_anew"] = """
SELECT * REPLACE (CASE WHEN CAST(order_id AS BIGINT) % 7 = 0 THEN created_at + INTERVAL '3' DAY ELSE created_at END AS created_at)
FROM incoming"""
CTES["moves"] = """
SELECT o.shop_id, o.platform, CAST(COALESCE(o.created_at, o.updated_at) AS DATE) AS was, n.platform AS new_platform,
       CAST(COALESCE(n.created_at, n.updated_at) AS DATE) AS now
FROM existing o JOIN dated_anew n ON n.shop_id = o.shop_id AND n.order_id = o.order_id WHERE n.updated_at > o.updated_at"""
SQL["moved_days"] = """
SELECT shop_id, platform, was AS stat_date FROM moves WHERE was <> now
UNION
SELECT shop_id, new_platform, now FROM moves WHERE was <> now"""
CTES["after_moves"] = """
SELECT * FROM dated_anew n WHERE NOT EXISTS (SELECT 1 FROM existing o WHERE o.shop_id = n.shop_id AND o.order_id = n.order_id
                                             AND o.updated_at >= n.updated_at)
UNION ALL
SELECT * FROM existing o WHERE NOT EXISTS (SELECT 1 FROM dated_anew n WHERE n.shop_id = o.shop_id AND n.order_id = o.order_id
                                           AND n.updated_at > o.updated_at)"""
CTES["dwd_before_moves"] = _dwd("existing")
CTES["dwd_after_moves"] = _dwd("after_moves")
SQL["moved_shop_days"] = "\nUNION ALL\n".join(
    _shop_days(f"(SELECT * FROM {t} d WHERE {_PAID} AND {no} EXISTS (SELECT 1 FROM moves m WHERE m.was <> m.now AND m.shop_id = d.shop_id "
               "AND ((m.platform = d.platform AND m.was = d.stat_date) OR (m.new_platform = d.platform AND m.now = d.stat_date))))")
    for t, no in (("dwd_before_moves", "NOT"), ("dwd_after_moves", ""))
)


def _ratio(n: str, d: str, scale: int, unit: int = 1) -> str:
    big = f"CAST({n} AS HUGEINT)"
    return (
        f"(CASE WHEN {n} < 0 THEN -1 ELSE 1 END * CAST((2 * {scale * unit} * ABS({big}) + {d}) // (2 * {d}) AS BIGINT))"
        f" / {float(scale)}"
    )


def _dod(col: str, by: str) -> str:
    prev = f"NULLIF(LAG({col}) OVER (PARTITION BY {by} ORDER BY stat_date), 0)"
    return _ratio(f"({col} - {prev})", prev, 10_000, 100)


def _overview(days: str, products: str) -> str:
    return f"""
SELECT w.*, CASE WHEN gmv_cents > 0 THEN {_ratio('refund_cents', 'gmv_cents', 10_000)} ELSE 0.0 END AS refund_rate,
       {_dod('gmv_cents', 'platform, shop_id')} AS gmv_dod_pct,
       {_dod('order_cnt', 'platform, shop_id')} AS order_dod_pct,
       CASE WHEN product_total_cnt > 0
            THEN {_ratio('active_product_cnt', 'product_total_cnt', 10_000)} ELSE 0.0 END AS sell_through_rate
FROM (SELECT s.*, CAST(COALESCE(a.n, 0) AS INT) AS active_product_cnt, CAST(COALESCE(t.n, 0) AS INT) AS product_total_cnt
      FROM ({days}) s
      LEFT JOIN (SELECT stat_date, shop_id, COUNT(*) AS n FROM ({products}) GROUP BY stat_date, shop_id) a
           ON a.stat_date = s.stat_date AND a.shop_id = s.shop_id
      LEFT JOIN (SELECT shop_id, COUNT(DISTINCT product_id) AS n FROM ods_items GROUP BY shop_id) t
           ON t.shop_id = s.shop_id) w"""


CTES["overview"] = _overview("SELECT * FROM shop_days", "SELECT * FROM product_days")
CTES["kpi"] = f"""
SELECT *, {_dod('gmv_cents', 'platform')} AS gmv_dod_pct
FROM (SELECT stat_date, platform, CAST(SUM(gmv_cents) AS BIGINT) AS gmv_cents, CAST(SUM(order_cnt) AS INT) AS order_cnt,
             CAST(SUM(buyer_cnt) AS INT) AS buyer_cnt, CAST(SUM(refund_cents) AS BIGINT) AS refund_cents,
             CAST(SUM(gmv_cents) // SUM(order_cnt) AS BIGINT) AS avg_order_cents, CAST(COUNT(*) AS INT) AS shop_cnt
      FROM shop_days GROUP BY stat_date, platform)"""

SQL["normalize_status"] = """
SELECT shop_id, order_id, platform, status_raw, status_norm,
       CASE WHEN platform = 'beta' AND status_raw = 'TRADE_MYSTERY'
            THEN CASE WHEN refund_amount_cents > 0 AND payment_amount_cents > 0 THEN 'refunded' ELSE 'completed' END
            ELSE status_norm END AS status_mapped FROM dwd"""
SQL["dwd_orders"] = "SELECT * FROM dwd"
SQL["dwd_order_items"] = """
SELECT shop_id, order_id, item_id, platform, product_id, product_name, quantity, price_cents,
       CAST(quantity AS BIGINT) * price_cents AS amount_cents, updated_at, 'b1' AS etl_batch_id FROM ods_items"""
SQL["window_items"] = """
SELECT * FROM ods_items WHERE order_id IN (SELECT order_id FROM dwd
  WHERE stat_date BETWEEN DATE '1998-01-01' AND DATE '2001-08-01')"""
SQL["paid_orders"] = """
SELECT shop_id, order_id, platform, stat_date, buyer_nick, payment_amount_cents, refund_amount_cents FROM paid"""
SQL["shop_daily"] = "SELECT * FROM shop_days"
SQL["product_daily"] = "SELECT * FROM product_days"
SQL["overwrite_window"] = f"""
SELECT * FROM shop_days
WHERE NOT (platform = 'alpha' AND stat_date BETWEEN DATE '1998-01-01' AND DATE '2001-08-01')
UNION ALL SELECT * FROM ({_shop_days('dwd_corrected')
    .replace('GROUP BY', f"WHERE {_PAID} AND platform = 'alpha' AND shop_id <> 3 AND stat_date BETWEEN DATE '1998-01-01' AND DATE '2001-08-01' GROUP BY")})"""
SQL["dim_product"] = """
SELECT shop_id, product_id, ARG_MAX(product_name, (updated_at, product_name)) AS product_name,
       MIN(updated_at) AS first_seen_at, MAX(updated_at) AS last_seen_at,
       CASE WHEN MAX(updated_at) >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL '90' DAY THEN 1 ELSE 0 END AS is_active
FROM ods_items GROUP BY shop_id, product_id"""
SQL["dim_product_of_sightings"] = SQL["dim_product"]
SQL["product_sightings"] = """
SELECT shop_id, product_id, product_name, platform, strftime(updated_at, '%Y-%m') AS period,
       MIN(updated_at) AS first_seen_at, MAX(updated_at) AS last_seen_at
FROM ods_items GROUP BY ALL"""
SQL["shop_overview"] = "SELECT * FROM overview"
SQL["shop_overview_window"] = f"""
SELECT * FROM ({_overview("SELECT * FROM shop_days WHERE stat_date >= DATE '1997-12-31'",
                          "SELECT * FROM product_days WHERE stat_date >= DATE '1998-01-01'")})
WHERE stat_date >= DATE '1998-01-01'"""
SQL["daily_kpi"] = "SELECT * FROM kpi"
SQL["daily_kpi_distinct_buyers"] = """
SELECT stat_date, platform,
       CAST(COUNT(DISTINCT buyer_nick) + MAX(CASE WHEN buyer_nick IS NULL THEN 1 ELSE 0 END) AS INT) AS buyer_cnt
FROM paid GROUP BY stat_date, platform"""

# ---- dimensions --------------------------------------------------------------------------

_HOLIDAYS = (
    "(DATE '2026-01-01', '元旦'), (DATE '2026-05-01', '劳动节'), (DATE '2026-10-01', '国庆节'), "
    "(DATE '2026-10-02', '国庆节'), (DATE '2026-10-03', '国庆节'), (DATE '1999-10-01', '国庆节'), "
    "(DATE '2000-01-01', '元旦'), (DATE '2001-05-01', '劳动节')"
)
_CALENDAR = """
SELECT CAST(STRFTIME(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS stat_date, CAST(YEAR(d) AS INT) AS year_num,
       CAST(QUARTER(d) AS INT) AS quarter_num, CAST(MONTH(d) AS INT) AS month_num, CAST(DAY(d) AS INT) AS day_num,
       {week} AS week_of_year, CAST(ISODOW(d) AS INT) AS day_of_week,
       CASE WHEN ISODOW(d) >= 6 THEN 1 ELSE 0 END AS is_weekend, {flag} AS is_holiday, {name} AS holiday_name
FROM (SELECT UNNEST(GENERATE_SERIES(MIN(stat_date) - {before}, MAX(stat_date) + {after}, INTERVAL 1 DAY)) AS d FROM dwd)
     LEFT JOIN (VALUES {holidays}) h(day, name) ON h.day = CAST(d AS DATE)"""
CTES["calendar"] = _CALENDAR.format(
    week="CAST(WEEKOFYEAR(d) AS INT)", flag="CASE WHEN h.name IS NULL THEN 0 ELSE 1 END", name="h.name",
    before=365, after=366, holidays=_HOLIDAYS,
)
CTES["old_calendar"] = _CALENDAR.format(
    week="0", flag="CASE WHEN DAY(d) = 1 THEN 1 ELSE 0 END", name="CASE WHEN DAY(d) = 1 THEN 'first' END",
    before=30, after=0, holidays=_HOLIDAYS,
)
SQL["dim_date"] = "SELECT * FROM calendar"
SQL["dim_date_refresh"] = """
SELECT c.date_key, c.stat_date, c.year_num, c.quarter_num, c.month_num, c.day_num,
       COALESCE(o.week_of_year, c.week_of_year) AS week_of_year, c.day_of_week, c.is_weekend, c.is_holiday, c.holiday_name
FROM calendar c LEFT JOIN old_calendar o ON o.date_key = c.date_key"""

CTES["shops"] = """
SELECT c_custkey AS shop_id, CASE WHEN c_nationkey % 2 = 0 THEN 'alpha' ELSE 'beta' END AS platform,
       c_name AS shop_name, c_nationkey, c_mktsegment, c_acctbal FROM customer"""
CTES["registry"] = """
SELECT shop_id, platform, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN shop_name || ' NEW' ELSE shop_name END AS shop_name,
       CASE WHEN c_acctbal < 0 THEN 'disabled' ELSE 'active' END AS status FROM shops WHERE c_nationkey <> 3"""
CTES["current_shops"] = """
SELECT shop_id * 2 AS shop_key, shop_id, platform, shop_name, 'active' AS status,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN DATE '2001-08-01' ELSE DATE '2000-01-01' END AS valid_from
FROM shops WHERE c_nationkey <> 7"""
CTES["shop_compare"] = """
SELECT r.shop_id AS r_id, r.shop_name AS r_name, r.status AS r_status, c.shop_id AS c_id, c.shop_name AS c_name,
       c.status AS c_status, c.shop_key, c.valid_from, COALESCE(r.shop_id, c.shop_id) AS shop_id,
       COALESCE(r.platform, c.platform) AS platform,
       r.shop_id IS NOT NULL AND c.shop_id IS NOT NULL AND r.shop_name = c.shop_name AND r.status = c.status AS same
FROM registry r FULL OUTER JOIN current_shops c ON c.shop_id = r.shop_id AND c.platform = r.platform"""
SQL["scd2_diff"] = """
SELECT 'open' AS change, shop_id, platform, r_name AS shop_name, r_status AS status, CAST(NULL AS BIGINT) AS shop_key,
       DATE '2001-08-01' AS valid_from, CAST(NULL AS DATE) AS valid_to, 1 AS is_current
FROM shop_compare WHERE NOT same AND r_id IS NOT NULL
UNION ALL
SELECT 'close', shop_id, platform, c_name, c_status, shop_key, NULL, DATE '2001-08-01', 0
FROM shop_compare WHERE NOT same AND c_id IS NOT NULL"""
SQL["scd2_apply"] = """
SELECT shop_id, platform, c_name AS shop_name, c_status AS status, valid_from,
       CASE WHEN same THEN NULL ELSE DATE '2001-08-01' END AS valid_to, CASE WHEN same THEN 1 ELSE 0 END AS is_current
FROM shop_compare WHERE c_id IS NOT NULL AND NOT (NOT same AND r_id IS NOT NULL AND valid_from = DATE '2001-08-01')
UNION ALL
SELECT shop_id, platform, r_name, r_status, DATE '2001-08-01', NULL, 1
FROM shop_compare WHERE r_id IS NOT NULL AND NOT same
UNION ALL
SELECT shop_id, platform, 'OLD ' || shop_name, 'active', DATE '1999-01-01', DATE '2000-01-01', 0
FROM shops WHERE c_nationkey <> 7 AND c_mktsegment = 'BUILDING'"""

# ---- state and rules ---------------------------------------------------------------------

SQL["watermark_advance"] = """
WITH reached AS (SELECT table_name, shop_id + CASE WHEN run_type = 'backfill' THEN 2 ELSE 0 END AS shop_id, platform,
                        MAX(window_end) AS v FROM etl_batch WHERE status = 'success' GROUP BY 1, 2, 3)
SELECT COALESCE(s.table_name, r.table_name) AS table_name, COALESCE(s.shop_id, r.shop_id) AS shop_id,
       COALESCE(s.platform, r.platform) AS platform,
       CASE WHEN s.watermark_value IS NULL OR r.v > s.watermark_value THEN r.v ELSE s.watermark_value END AS watermark_value,
       CASE WHEN r.v IS NOT NULL AND (s.watermark_value IS NULL OR r.v > s.watermark_value) THEN 1 ELSE 0 END AS moved
FROM etl_watermark s FULL OUTER JOIN reached r
     ON r.table_name = s.table_name AND r.shop_id = s.shop_id AND r.platform = s.platform"""
SQL["compute_windows"] = """
SELECT table_name, shop_id, platform, watermark_value - INTERVAL '1' HOUR AS window_start,
       TIMESTAMP '2024-01-31 00:00:00' - INTERVAL '5' MINUTE AS window_end FROM etl_watermark"""
SQL["window_row_counts"] = """
SELECT shop_id, platform, COUNT(*) AS rows_in_window FROM ods_orders
WHERE updated_at < TIMESTAMP '2001-07-31 23:55:00' GROUP BY shop_id, platform"""
CTES["own_windows"] = """
SELECT s.shop_id, s.platform,
       COALESCE(MIN(CASE WHEN o.updated_at >= s.floor THEN o.updated_at END), ANY_VALUE(s.floor)) AS window_start,
       COALESCE(MAX(CASE WHEN o.updated_at < s.ceiling THEN o.updated_at END), ANY_VALUE(s.ceiling)) AS window_end
FROM (SELECT CAST(r_regionkey + 1 AS BIGINT) AS shop_id, platform,
             MAKE_TIMESTAMP(1996, r_regionkey + 1, 1, 0, 0, 0) AS floor,
             MAKE_TIMESTAMP(1998, 1, r_regionkey + 1, 0, 0, 0) AS ceiling
      FROM region, (VALUES ('alpha'), ('beta')) p(platform)) s
LEFT JOIN ods_orders o ON o.shop_id = s.shop_id AND o.platform = s.platform
GROUP BY s.shop_id, s.platform"""
CTES["own_window_stats"] = """
SELECT w.shop_id, w.platform, COUNT(o.order_id) AS n, COUNT(o.order_id) - COUNT(o.buyer_nick) AS nulls,
       MIN(o.order_amount_cents) AS least, MAX(o.order_amount_cents) AS most, MAX(o.updated_at) AS newest
FROM own_windows w LEFT JOIN ods_orders o ON o.shop_id = w.shop_id AND o.platform = w.platform
     AND o.updated_at >= w.window_start AND o.updated_at < w.window_end
GROUP BY w.shop_id, w.platform"""
SQL["window_row_counts_own"] = "SELECT shop_id, platform, n AS rows_in_window FROM own_window_stats"
SQL["rule_sync"] = """
SELECT 'dw.ods_order_items' AS table_name, 'range' AS rule_type,
       '{"column":"price_cents","max":' || CAST(ROUND(p_retailprice * 100) AS BIGINT) || ',"min":0,"part":"'
       || p_partkey || '"}' AS params,
       CASE WHEN p_size > 25 THEN 'block' ELSE 'warn' END AS severity
FROM part WHERE p_size > 30"""

# ---- data quality ------------------------------------------------------------------------


def _verdict(
    check: int, table: str, rule: str, severity: str, passed: str, actual: str, expected: str,
    detail: str = "CAST(NULL AS VARCHAR)", shop: str = "CAST(NULL AS BIGINT)", platform: str = "CAST(NULL AS VARCHAR)",
) -> str:
    return (
        f"SELECT CAST({check} AS BIGINT) AS check_id, '{table}' AS table_name, '{rule}' AS rule_type, "
        f"'{severity}' AS severity, {shop} AS shop_id, {platform} AS platform, "
        f"CASE WHEN {passed} THEN 1 ELSE 0 END AS passed, {actual} AS actual_value, '{expected}' AS expected_value, "
        f"{detail} AS detail "
    )


def _null_rate(check: int, rate: float, **scope: str) -> str:
    return _verdict(
        check, "dw.ods_orders", "null_rate", "block", f"CAST(nulls AS DOUBLE) / n <= {rate}",
        "PRINTF('%.4f', (nulls * 20000 + n) // (2 * n) / 10000.0)", f"<= {rate}",
        f"CASE WHEN CAST(nulls AS DOUBLE) / n > {rate} THEN nulls || ' of ' || n || ' are NULL' END", **scope,
    )


def _range(check: int, table: str, severity: str, low: int, high: int, **scope: str) -> str:
    return _verdict(
        check, table, "range", severity, f"least >= {low} AND most <= {high}",
        "'[' || least || ', ' || most || ']'", f"[{low}, {high}]", **scope,
    )


def _freshness(check: int, severity: str, now: str, limit: int, **scope: str) -> str:
    seconds = f"DATE_DIFF('microsecond', newest, TIMESTAMP '{now}') / 1000000.0"
    return _verdict(
        check, "dw.ods_orders", "freshness", severity, f"{seconds} / 60 <= {limit}",
        f"CAST(ROUND({seconds} / 60) AS BIGINT) || ' minutes'", f"<= {limit} minutes", **scope,
    )


def _delta(check: int, table: str, limit: float) -> str:
    return _verdict(
        check, table, "row_count_delta", "warn",
        f"COALESCE(b, 0) < 2 OR CAST(ABS(cur * b - total) AS DOUBLE) / total <= {limit}",
        "CASE WHEN COALESCE(b, 0) < 2 THEN CAST(cur AS VARCHAR) ELSE cur || ' rows, average ' || (total * 2 + b) // (b * 2) END",
        f"deviation <= {limit}",
        "CASE WHEN COALESCE(b, 0) < 2 THEN 'skipped: too few earlier batches' "
        f"WHEN CAST(ABS(cur * b - total) AS DOUBLE) / total > {limit} "
        "THEN 'deviation ' || (ABS(cur * b - total) * 20000 + total) // (2 * total) / 10000.0 END",
        shop="c.shop_id", platform="c.platform",
    ) + f"""FROM {{current}} c LEFT JOIN (
  SELECT shop_id, platform, CAST(SUM(rows_read) AS BIGINT) AS total, COUNT(*) AS b FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY shop_id, platform ORDER BY started_at DESC, batch_id DESC) AS nth
    FROM etl_batch WHERE table_name = '{table}' AND run_type = 'incremental' AND status = 'success' AND rows_read > 0)
  WHERE nth <= 10 GROUP BY shop_id, platform) h ON h.shop_id = c.shop_id AND h.platform = c.platform"""


def _union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


_BUYERS = "FROM (SELECT COUNT(*) AS n, COUNT(*) - COUNT(buyer_nick) AS nulls FROM ods_orders)"
_AMOUNTS = "FROM (SELECT MIN(order_amount_cents) AS least, MAX(order_amount_cents) AS most FROM ods_orders)"
_TIMES = "FROM (SELECT MAX(updated_at) AS newest FROM ods_orders)"
SQL["dq_null_rate"] = _union(*[_null_rate(1, r) + _BUYERS for r in (0.0, 0.02)])
SQL["dq_range"] = _union(*[_range(1, "dw.ods_orders", "block", 0, h) + _AMOUNTS for h in (500000000, 1000000)])
SQL["dq_freshness"] = _union(*[_freshness(1, "block", "2001-08-02 12:00:00", m) + _TIMES for m in (2880, 100)])


def _unique(check: int, table: str, source: str, key: str) -> str:
    return _verdict(check, table, "unique", "block", "n = 0", "n || ' duplicate groups'", "0") + (
        f"FROM (SELECT COUNT(*) AS n FROM (SELECT 1 FROM {source} GROUP BY {key} HAVING COUNT(*) > 1))"
    )


def _referential(check: int, parent: str) -> str:
    return _verdict(check, "dw.ods_order_items", "referential", "block", "n = 0", "n || ' orphan rows'", "0") + (
        f"FROM (SELECT COUNT(*) AS n FROM ods_items i WHERE NOT EXISTS (SELECT 1 FROM {parent} p "
        "WHERE p.order_id = i.order_id AND p.shop_id = i.shop_id))"
    )


_ITEM_KEY = "shop_id, order_id, item_id"
SQL["dq_unique"] = _union(
    _unique(1, "dw.items_feed", "items_feed", _ITEM_KEY), _unique(1, "dw.ods_order_items", "ods_items", _ITEM_KEY)
)
SQL["dq_referential"] = _union(
    _referential(1, "ods_orders"), _referential(1, "(SELECT * FROM ods_orders WHERE is_deleted = 0)")
)
SQL["dq_row_count_delta"] = _union(
    *[
        _delta(1, t, 3.5).format(current="(SELECT shop_id, platform, MAX(rows_read) AS cur FROM etl_batch GROUP BY 1, 2)")
        for t in ("dw.ods_orders", "dw.ods_order_items")
    ]
)

_BY_SHOP = {"shop": "shop_id", "platform": "platform"}
_SPAN = "updated_at >= TIMESTAMP '1990-01-01' AND updated_at < TIMESTAMP '2001-08-01'"
CTES["orders_in_span"] = f"""
SELECT shop_id, platform, COUNT(*) AS n, COUNT(*) - COUNT(buyer_nick) AS nulls, MIN(order_amount_cents) AS least,
       MAX(order_amount_cents) AS most, MAX(updated_at) AS newest FROM ods_orders WHERE {_SPAN} GROUP BY 1, 2"""
CTES["items_in_span"] = f"""
SELECT shop_id, platform, MIN(quantity) AS least, MAX(quantity) AS most FROM ods_items WHERE {_SPAN} GROUP BY 1, 2"""
CTES["verdicts"] = _union(
    _null_rate(1, 0.0, **_BY_SHOP) + "FROM orders_in_span",
    _unique(2, "dw.ods_orders", "ods_orders", "shop_id, order_id"),
    _range(3, "dw.ods_orders", "warn", 0, 500000000, **_BY_SHOP) + "FROM orders_in_span",
    _freshness(4, "warn", "2001-08-01 00:00:00", 2880, **_BY_SHOP) + "FROM orders_in_span",
    _delta(5, "dw.ods_orders", 0.9).format(current="(SELECT shop_id, platform, COUNT(*) AS cur FROM ods_orders GROUP BY 1, 2)"),
    _range(6, "dw.ods_order_items", "warn", 1, 10000, **_BY_SHOP) + "FROM items_in_span",
    _referential(7, "ods_orders"),
)
_OWN = {"shop": "shop_id", "platform": "platform"}


def _own_windows(verdict: str, check: int, rule: str, severity: str, expected: str, why: str) -> str:
    """The verdicts of shops with rows, and passes with a note for those without."""
    empty = _verdict(check, "dw.ods_orders", rule, severity, "TRUE", "'-'", expected, f"'skipped: {why}'", **_OWN)
    return _union(verdict + "FROM own_window_stats WHERE n > 0", empty + "FROM own_window_stats WHERE n = 0")


SQL["dq_own_windows"] = _union(
    _own_windows(_null_rate(1, 0.01, **_OWN), 1, "null_rate", "block", "<= 0.01", "no rows"),
    _own_windows(
        _range(2, "dw.ods_orders", "warn", 0, 49900000, **_OWN), 2, "range", "warn", "[0, 49900000]", "all values are NULL"
    ),
    _own_windows(
        _freshness(3, "warn", "2001-08-01 00:00:00", 1882200, **_OWN), 3, "freshness", "warn", "<= 1882200 minutes", "no rows"
    ),
)
SQL["dq_run_all"] = "SELECT * FROM verdicts"
SQL["dq_failures_by_severity"] = """
SELECT severity, COUNT(*) AS failures, CASE WHEN severity = 'block' THEN 1 ELSE 0 END AS blocked
FROM verdicts WHERE passed = 0 GROUP BY severity"""
SQL["dq_alert_rows"] = """
SELECT CASE WHEN shop_id IS NULL THEN '' ELSE '[' || platform || '/shop=' || shop_id || '] ' END
         || 'data check failed: ' || table_name AS title,
       'rule ' || rule_type || ': actual=' || actual_value || ', expected=' || expected_value
         || CASE WHEN detail IS NULL THEN '' ELSE '; ' || detail END AS text,
       CASE WHEN severity = 'block' THEN 'error' ELSE 'warning' END AS level
FROM verdicts WHERE passed = 0"""
SQL["dq_results_with_defs"] = """
SELECT d.check_id, d.table_name, d.rule_type, d.severity, passed, COUNT(*) AS results
FROM (SELECT user_id % 7 + 1 AS check_id, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS passed FROM events) r
JOIN (VALUES (1, 'dw.ods_orders', 'null_rate', 'block'), (2, 'dw.ods_orders', 'unique', 'block'),
             (3, 'dw.ods_orders', 'range', 'warn'), (4, 'dw.ods_orders', 'freshness', 'warn'),
             (5, 'dw.ods_orders', 'row_count_delta', 'warn'), (6, 'dw.ods_order_items', 'range', 'warn'),
             (7, 'dw.ods_order_items', 'referential', 'block')) d(check_id, table_name, rule_type, severity)
     ON d.check_id = r.check_id
GROUP BY d.check_id, d.table_name, d.rule_type, d.severity, passed"""
SQL["dq_results_with_defs"] = SQL["dq_results_with_defs"].replace("SELECT d.check_id,", "SELECT CAST(d.check_id AS BIGINT) AS check_id,")

# ---- operations --------------------------------------------------------------------------

_RECENT = ">= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL '24' HOUR"
SQL["ops_success_rate"] = f"""
SELECT table_name, COUNT(*) AS batches, CAST(SUM(CASE WHEN status = 'success' THEN 1 ELSE 0 END) AS BIGINT) AS successes,
       CAST((20000 * SUM(CASE WHEN status = 'success' THEN 1 ELSE 0 END) + COUNT(*)) // (2 * COUNT(*)) AS BIGINT) / 10000.0 AS success_rate
FROM etl_batch WHERE started_at {_RECENT} GROUP BY table_name"""
SQL["ops_batch_delay"] = """
SELECT t.table_name, t.shop_id, t.platform,
       DATE_SUB('minute', MAX(t.window_end), TIMESTAMP '2024-01-31 00:00:00') AS delay_minutes
FROM etl_batch t JOIN (SELECT table_name, shop_id, platform, MAX(started_at) AS last_started FROM etl_batch
                       WHERE status = 'success' GROUP BY table_name, shop_id, platform) l
     ON l.table_name = t.table_name AND l.shop_id = t.shop_id AND l.platform = t.platform AND l.last_started = t.started_at
GROUP BY t.table_name, t.shop_id, t.platform"""
SQL["ops_duration_p95"] = f"""
SELECT dag_id, MAX(duration_ms) AS p95_ms FROM (
  SELECT 'dag_' || user_id % 3 AS dag_id, CAST(ROUND(value * 100) AS BIGINT) AS duration_ms,
         PERCENT_RANK() OVER (PARTITION BY user_id % 3 ORDER BY CAST(ROUND(value * 100) AS BIGINT)) AS pr
  FROM events WHERE ts {_RECENT}) WHERE pr <= 0.95 GROUP BY dag_id"""
SQL["ops_dq_failures"] = f"SELECT COUNT(*) AS dq_failures FROM events WHERE ts {_RECENT} AND event_type = 'error'"
SQL["ops_load_errors"] = f"SELECT COUNT(*) AS load_errors FROM events WHERE ts {_RECENT} AND event_type = 'error'"
SQL["ops_watermark_age"] = """
SELECT table_name, shop_id, platform,
       DATE_SUB('minute', watermark_value, TIMESTAMP '2024-01-31 00:00:00') AS age_minutes FROM etl_watermark"""

# ---- row counts, charts ------------------------------------------------------------------

SQL["table_row_counts"] = _union(
    *[
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_cnt FROM {source}"
        for name, source in (
            ("dw.ods_orders", "ods_orders"), ("dw.ods_order_items", "ods_items"), ("dw.dws_shop_daily", "shop_days"),
            ("dw.dws_product_daily", "product_days"), ("etl_meta.etl_batch", "events"),
        )
    ]
)


def _series(report: str, metric: str, alias: str) -> str:
    return f"SELECT stat_date, {metric} AS {alias} FROM {report} GROUP BY stat_date ORDER BY stat_date LIMIT 10000"


SQL["bi_gmv_trend"] = _series("overview", "CAST(SUM(gmv_cents) AS BIGINT)", "gmv_cents")
SQL["bi_order_trend"] = _series("overview", "CAST(SUM(order_cnt) AS BIGINT)", "order_cnt")
SQL["bi_refund_rate_trend"] = _series(
    "overview", "CAST(SUM(CAST(ROUND(refund_rate * 10000) AS BIGINT)) AS DOUBLE) / (COUNT(*) * 10000.0)", "refund_rate"
)
SQL["bi_avg_order_trend"] = _series("overview", "CAST(SUM(avg_order_cents) AS DOUBLE) / COUNT(*)", "avg_order_cents")
SQL["bi_shop_detail"] = """
SELECT stat_date, gmv_cents, order_cnt, buyer_cnt, refund_cents, avg_order_cents, refund_rate, gmv_dod_pct,
       active_product_cnt, sell_through_rate FROM overview ORDER BY stat_date DESC, shop_id LIMIT 1000"""
SQL["bi_gmv_total"] = "SELECT CAST(SUM(gmv_cents) AS BIGINT) AS gmv_cents FROM kpi"
SQL["bi_order_total"] = "SELECT CAST(SUM(order_cnt) AS BIGINT) AS order_cnt FROM kpi"
SQL["bi_kpi_gmv_trend"] = _series("kpi", "CAST(SUM(gmv_cents) AS BIGINT)", "gmv_cents")
SQL["bi_kpi_order_trend"] = _series("kpi", "CAST(SUM(order_cnt) AS BIGINT)", "order_cnt")
SQL["bi_status_share"] = """
SELECT status_norm, COUNT(*) AS order_cnt FROM dwd GROUP BY status_norm ORDER BY order_cnt DESC, status_norm LIMIT 100"""
SQL["bi_daily_orders"] = _series("dwd", "COUNT(*)", "order_cnt")
SQL["bi_order_detail"] = """
SELECT stat_date, order_id, status_norm, buyer_nick, payment_amount_cents, refund_amount_cents, created_at
FROM dwd ORDER BY stat_date DESC, shop_id, order_id LIMIT 1000"""


def _needs(text: str) -> list[str]:
    return [name for name in CTES if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text)]


def oracle(name: str) -> str:
    """The full SQL of a query: its building blocks in dependency order, then its SELECT."""
    order: list[str] = []

    def visit(text: str) -> None:
        for block in _needs(text):
            if block not in order:
                visit(CTES[block])
                order.append(block)

    text = SQL[name]
    visit(text)
    if not order:
        return text.strip()
    blocks = ",\n".join(f"{block} AS ({CTES[block]})" for block in order)
    if text.lstrip().startswith("WITH "):
        return f"WITH {blocks},\n{text.lstrip()[5:]}"
    return f"WITH {blocks}\n{text.strip()}"
