"""SQL for DuckDB that gives the result of each registered query from the given tables.

Written independently of the Spark plans: typed values are derived directly instead of by
landing and parsing text, windows and joins are the plain textbook ones. AS_OF is 2001-08-02.
"""

from __future__ import annotations

_LINES = """
numbered AS (
    SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                          l_shipdate, l_extendedprice) AS line_id,
           CAST(l_quantity AS BIGINT) AS qty,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
    FROM lineitem
),
lines AS (
    SELECT CAST(line_id AS BIGINT) AS order_item_id, l_orderkey AS order_id,
           l_partkey AS product_id, CAST(qty AS INTEGER) AS quantity,
           CAST((cents // qty) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS unit_price,
           CASE l_returnflag || l_linestatus
               WHEN 'RF' THEN 'RETURNED' WHEN 'RO' THEN 'CANCELLED'
               WHEN 'AF' THEN 'DELIVERED' WHEN 'NF' THEN 'DELIVERED'
               WHEN 'AO' THEN 'SHIPPED' ELSE 'PENDING' END AS line_status,
           l_shipdate AS status_updated_at
    FROM numbered
)"""

_FACT = """
fact AS (
    SELECT i.order_item_id, i.order_id, o.o_custkey AS customer_id, i.product_id,
           'SKU-' || lpad(CAST(i.product_id AS VARCHAR), 8, '0') AS sku,
           p.p_name AS product_name, p.p_type AS category, o.o_orderdate AS order_date,
           CAST(date_trunc('month', o.o_orderdate) AS DATE) AS order_month,
           i.quantity, i.unit_price, CAST(i.quantity * i.unit_price AS DECIMAL(18,2)) AS line_total,
           i.line_status, i.status_updated_at
    FROM {items} i JOIN orders o ON o.o_orderkey = i.order_id JOIN part p ON p.p_partkey = i.product_id
)"""

_STATUS = """
status AS (
    SELECT *, CASE WHEN delivered_count = total_line_items THEN 'COMPLETED'
                   WHEN cancelled_count = total_line_items THEN 'CANCELLED'
                   WHEN shipped_count + delivered_count > 0 THEN 'PARTIALLY_SHIPPED'
                   WHEN pending_count = total_line_items THEN 'PENDING'
                   ELSE 'IN_PROGRESS' END AS order_status
    FROM (
        SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, o.o_orderdate AS order_date,
               count(*) AS total_line_items,
               count(*) FILTER (WHERE line_status = 'DELIVERED') AS delivered_count,
               count(*) FILTER (WHERE line_status = 'SHIPPED') AS shipped_count,
               count(*) FILTER (WHERE line_status = 'PENDING') AS pending_count,
               count(*) FILTER (WHERE line_status = 'CANCELLED') AS cancelled_count,
               count(*) FILTER (WHERE line_status = 'RETURNED') AS returned_count
        FROM orders o JOIN lines i ON i.order_id = o.o_orderkey
        GROUP BY ALL
    )
)"""

# Dirt, by rule: resent copies one second later, corrections two seconds later.
_VERSIONS = """
versions AS (
    SELECT *, TIMESTAMP '2001-08-02 00:00:00' AS _updated_ts FROM lines
    UNION ALL
    SELECT *, TIMESTAMP '2001-08-02 00:00:01' FROM lines WHERE order_id % 7 = 0
    UNION ALL
    SELECT * REPLACE ('RETURNED' AS line_status), TIMESTAMP '2001-08-02 00:00:02'
    FROM lines WHERE order_id % 11 = 0
)"""

_LATEST = """
latest AS (
    SELECT * EXCLUDE (_updated_ts)
    FROM (
        SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY _updated_ts DESC) AS rn
        FROM versions
    ) WHERE rn = 1
)"""

_LANDED = """
first_lines AS (
    SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_item_id) = 1
),
raw AS (
    SELECT CAST(order_item_id AS VARCHAR) AS order_item_id, CAST(order_id AS VARCHAR) AS order_id,
           CAST(product_id AS VARCHAR) AS product_id, CAST(quantity AS VARCHAR) AS quantity,
           unit_price, line_status, status_updated_at, order_id AS n, 0 AS sec, FALSE AS bad,
           order_item_id AS item
    FROM lines
),
first_raw AS (
    SELECT r.* REPLACE (TRUE AS bad) FROM raw r JOIN first_lines f ON f.order_item_id = r.item
),
all_rows AS (
    SELECT * FROM raw
    UNION ALL SELECT * REPLACE (1 AS sec) FROM raw WHERE n % 7 = 0
    UNION ALL SELECT * REPLACE (2 AS sec, 'RETURNED' AS line_status, TRUE AS bad) FROM raw WHERE n % 11 = 0
    UNION ALL SELECT * REPLACE (CAST(item + 1000000000000000 AS VARCHAR) AS order_item_id,
                                'LOST' AS line_status) FROM first_raw WHERE n % 13 = 0
    UNION ALL SELECT * REPLACE (CAST(item + 2000000000000000 AS VARCHAR) AS order_item_id,
                                '-1' AS order_id) FROM first_raw WHERE n % 17 = 0
    UNION ALL SELECT * REPLACE (CAST(item + 3000000000000000 AS VARCHAR) AS order_item_id,
                                '-1' AS product_id) FROM first_raw WHERE n % 19 = 0
    UNION ALL SELECT * REPLACE (CAST(item + 4000000000000000 AS VARCHAR) AS order_item_id,
                                'n/a' AS quantity) FROM first_raw WHERE n % 23 = 0
    UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS order_item_id) FROM first_raw WHERE n % 29 = 0
),
landed AS (
    SELECT order_item_id, order_id, product_id, quantity,
           CAST(CAST(unit_price AS DECIMAL(10,2)) AS VARCHAR) AS unit_price,
           CASE WHEN n % 5 = 0 AND NOT bad THEN ' ' || lower(line_status) || ' '
                ELSE line_status END AS line_status,
           strftime(status_updated_at, '%Y-%m-%d %H:%M:%S') AS status_updated_at,
           TIMESTAMP '2001-08-02 00:00:00' + sec * INTERVAL 1 SECOND AS _ingest_ts
    FROM all_rows
)"""

_ITEM_COLUMNS = """order_item_id, order_id, product_id, quantity, unit_price,
       CAST(quantity * unit_price AS DECIMAL(18,2)) AS line_total, line_status, status_updated_at"""

_SOLD = "CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(line_total) AS DECIMAL(18,2)) AS revenue"
_JULY = """line_status = 'DELIVERED' AND order_date >= TIMESTAMP '2001-07-01 00:00:00'
      AND order_date < TIMESTAMP '2001-08-01 00:00:00'"""

_REJECTED = """
WITH ordered AS (SELECT DISTINCT l_orderkey AS n FROM lineitem),
rules AS (
    SELECT * FROM (VALUES (13, 'bad_status'), (17, 'orphan_order'),
        (19, 'orphan_product'), (23, 'bad_number'), (29, 'null_key')) r(k, reject_reason)
),
parents AS (
    SELECT 'customers' AS table_name, c_custkey AS n FROM customer
    UNION ALL SELECT 'products', p_partkey FROM part
    UNION ALL SELECT 'orders', o_orderkey FROM orders
)
SELECT 'order_items' AS table_name, reject_reason, count(*) AS n_rows
FROM ordered JOIN rules ON n % k = 0 GROUP BY ALL
UNION ALL
SELECT table_name, reject_reason, count(*) FROM parents
JOIN (VALUES (23, 'bad_number'), (29, 'null_key')) r(k, reject_reason) ON n % k = 0
GROUP BY ALL
UNION ALL
SELECT 'orders', 'orphan_customer', count(*) FROM orders WHERE o_orderkey % 17 = 0
HAVING count(*) > 0"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _mart(period: str, expression: str, items: str = "lines") -> str:
    units = ", ".join(
        f"CAST(sum(CASE WHEN line_status = '{s.upper()}' THEN quantity ELSE 0 END) AS BIGINT)"
        f" AS units_{s}"
        for s in ("delivered", "shipped", "pending", "cancelled", "returned")
    )
    return f"""
    SELECT product_id, sku, product_name, category, CAST({expression} AS DATE) AS {period}, {units},
           CAST(sum(CASE WHEN line_status = 'DELIVERED' THEN line_total ELSE 0 END)
                AS DECIMAL(18,2)) AS revenue_delivered,
           count(DISTINCT order_id) AS distinct_orders
    FROM fact GROUP BY ALL"""


def oracle_sql() -> dict[str, str]:
    lines = _LINES
    fact = _FACT.format(items="lines")
    on_fact = _with(lines, fact)
    on_status = _with(lines, _STATUS)
    daily = _mart("order_day", "order_date")
    weekly = _mart("week_start", "date_trunc('week', order_date)")
    monthly = _mart("month_start", "date_trunc('month', order_date)")
    served = "sku, product_name, category, units_delivered, revenue_delivered, distinct_orders"
    by_units = "ORDER BY units_delivered DESC, revenue_delivered DESC, sku"
    customer = """c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
        split_part(c_name, '#', 2) AS last_name"""
    product = """p_partkey AS product_id, 'SKU-' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS sku,
        p_name AS product_name, p_type AS category"""
    list_price = """CAST(CAST(round(p_retailprice * 100) AS BIGINT) * CAST(0.01 AS DECIMAL(3,2))
        AS DECIMAL(18,2))"""
    registered = "TIMESTAMP '1995-01-01 00:00:00'"
    order = "o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date"
    cleaned = _with(lines, _VERSIONS, _LATEST)
    on_moved = _with(
        lines,
        _VERSIONS,
        _LATEST,
        """
moved_orders AS (
    SELECT * REPLACE (CASE WHEN o_orderkey % 9 = 0 THEN o_orderdate + INTERVAL 40 DAY
                           ELSE o_orderdate END AS o_orderdate) FROM orders
)""",
        _FACT.format(items="latest").replace("JOIN orders o", "JOIN moved_orders o"),
    )
    # Every 50th order arrives last, when the others have moved the watermark to seven days before the newest line.
    dealt = _with(
        lines,
        fact,
        """
marks AS (
    SELECT max(order_date) FILTER (WHERE order_id % 50 <> 0) - INTERVAL 7 DAY AS before_late,
           max(order_date) - INTERVAL 7 DAY AS at_end FROM fact
),
dealt AS (
    SELECT fact.*, order_id % 50 = 0 AND date_trunc('week', order_date) + INTERVAL 7 DAY <= before_late AS late,
           date_trunc('week', order_date) + INTERVAL 7 DAY <= at_end AS closed FROM fact, marks
)""",
    )
    return {
        "silver_customers": f"""
            SELECT {customer}, lower(c_name) || '@mail.example' AS email,
                   CAST(NULL AS VARCHAR) AS phone, {registered} AS created_at FROM customer""",
        "silver_products": f"""
            SELECT {product}, {list_price} AS unit_price, {registered} AS created_at FROM part""",
        "silver_orders": f"SELECT {order}, o_orderpriority AS shipping_address FROM orders",
        "silver_order_items": _with(lines) + f"SELECT {_ITEM_COLUMNS} FROM lines",
        "collapse_exact_items": _with(lines, _VERSIONS)
        + f"SELECT {_ITEM_COLUMNS}, max(_updated_ts) AS _updated_ts FROM versions GROUP BY ALL",
        "latest_items_by_key": cleaned + f"SELECT {_ITEM_COLUMNS} FROM latest",
        "upsert_order_items": cleaned
        + f"""SELECT {_ITEM_COLUMNS} FROM latest
            UNION ALL
            SELECT {_ITEM_COLUMNS} FROM (
                SELECT * REPLACE (order_item_id + 5000000000000000 AS order_item_id) FROM lines
                WHERE order_id % 101 = 0)""",
        "dim_customer": f"""
            SELECT {customer}, split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2)
                       AS full_name,
                   lower(c_name) || '@mail.example' AS email, CAST(NULL AS VARCHAR) AS phone,
                   {registered} AS customer_since FROM customer""",
        "dim_product": f"""
            SELECT {product}, {list_price} AS current_list_price,
                   {registered} AS product_introduced_at FROM part""",
        "fact_order_items": on_fact + "SELECT * FROM fact",
        "fact_partitioned_month": on_fact
        + "SELECT * FROM fact WHERE order_month = DATE '2001-07-01'",
        "mart_daily": on_fact + daily,
        "mart_weekly": on_fact + weekly,
        "mart_monthly": on_fact + monthly,
        "order_status": on_status + "SELECT * FROM status",
        "dim_order": on_status
        + """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
                    o_orderpriority AS shipping_address, total_line_items, order_status
             FROM orders LEFT JOIN status ON status.order_id = o_orderkey""",
        "top_product_last_month_mart": on_fact
        + f"""SELECT product_id, sku, product_name, category, units_delivered AS units_sold,
                     revenue_delivered AS revenue, distinct_orders
              FROM ({monthly}) WHERE month_start = DATE '2001-07-01' {by_units} LIMIT 1""",
        "top_product_last_month_fact": on_fact
        + f"""SELECT product_id, sku, product_name, category, {_SOLD},
                     count(DISTINCT order_id) AS distinct_orders
              FROM fact WHERE {_JULY} GROUP BY ALL
              ORDER BY units_sold DESC, revenue DESC, sku LIMIT 1""",
        "top_product_last_week": on_fact
        + f"SELECT {served} FROM ({weekly}) WHERE week_start = DATE '2001-07-23' {by_units} LIMIT 1",
        "top_product_yesterday": on_fact
        + f"SELECT {served} FROM ({daily}) WHERE order_day = DATE '2001-08-01' {by_units} LIMIT 1",
        "top5_products_on_day": on_fact
        + f"""SELECT sku, product_name, units_delivered, revenue_delivered FROM ({daily})
              WHERE order_day = DATE '2001-07-26' {by_units} LIMIT 5""",
        "leaderboard_last_month": on_fact
        + f"""SELECT sku, product_name, category, {_SOLD} FROM fact WHERE {_JULY} GROUP BY ALL
              ORDER BY units_sold DESC, revenue DESC, sku""",
        "top_product_trailing_30d": on_fact
        + f"""SELECT sku, product_name, {_SOLD} FROM fact
              WHERE line_status = 'DELIVERED' AND order_date >= TIMESTAMP '2001-07-03 00:00:00'
              GROUP BY ALL ORDER BY units_sold DESC, revenue DESC, sku LIMIT 1""",
        "top_product_by_revenue": on_fact
        + f"""SELECT sku, product_name, {_SOLD} FROM fact WHERE {_JULY} GROUP BY ALL
              ORDER BY revenue DESC, units_sold DESC, sku LIMIT 1""",
        "order_status_distribution": on_status
        + """SELECT order_status, count(*) AS n_orders FROM status GROUP BY ALL
             ORDER BY n_orders DESC, order_status""",
        "completed_orders_sample": on_status
        + "SELECT * FROM status WHERE order_status = 'COMPLETED' ORDER BY order_id LIMIT 5",
        "partially_shipped_sample": on_status
        + "SELECT * FROM status WHERE order_status = 'PARTIALLY_SHIPPED' ORDER BY order_id LIMIT 5",
        "status_peek": on_status
        + """SELECT * FROM status WHERE order_status IN ('COMPLETED', 'PARTIALLY_SHIPPED')
             ORDER BY order_status, order_id LIMIT 10""",
        "check_mart_vs_fact": _with(lines, _VERSIONS, _LATEST)
        + f"""
            , before AS (WITH {fact} {monthly}),
              after AS (WITH {_FACT.format(items="latest")} {monthly})
            SELECT product_id, month_start,
                   b.units_delivered AS units_delivered_mart,
                   a.units_delivered AS units_delivered_fact,
                   b.revenue_delivered AS revenue_delivered_mart,
                   a.revenue_delivered AS revenue_delivered_fact
            FROM before b FULL JOIN after a USING (product_id, month_start)
            WHERE b.units_delivered IS DISTINCT FROM a.units_delivered
               OR b.revenue_delivered IS DISTINCT FROM a.revenue_delivered""",
        "check_orders_without_items": f"""
            SELECT {order} FROM orders
            WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
        "check_quarantine": _REJECTED,
        "rejects_by_load": _REJECTED,
        "silver_customers_dirty": f"""
            SELECT {customer},
                   'customer#' || lpad(CAST(c_custkey - CAST(c_custkey % 31 = 0 AND c_custkey > 0
                       AS INTEGER) AS VARCHAR), 9, '0') || '@mail.example' AS email,
                   CASE WHEN c_custkey % 11 = 0 THEN '555-' || c_custkey END AS phone,
                   {registered} AS created_at FROM customer""",
        "silver_products_dirty": f"""
            SELECT p_partkey AS product_id,
                   'SKU-' || lpad(CAST(p_partkey - CAST(p_partkey % 37 = 0 AND p_partkey > 0
                       AS INTEGER) AS VARCHAR), 8, '0') AS sku,
                   p_name AS product_name,
                   CASE WHEN p_partkey % 11 = 0 THEN 'RENEWED' ELSE p_type END AS category,
                   {list_price} AS unit_price, {registered} AS created_at FROM part""",
        "silver_orders_dirty": f"""
            SELECT {order}, CASE WHEN o_orderkey % 11 = 0 THEN 'moved ' ELSE '' END
                       || o_orderpriority AS shipping_address FROM orders""",
        "check_duplicate_natural_keys": """
            SELECT 'email' AS natural_key,
                   'customer#' || lpad(CAST(k AS VARCHAR), 9, '0') || '@mail.example' AS value,
                   count(*) AS n_rows
            FROM (SELECT c_custkey - CAST(c_custkey % 31 = 0 AND c_custkey > 0 AS INTEGER) AS k
                  FROM customer) GROUP BY k HAVING count(*) > 1
            UNION ALL
            SELECT 'sku', 'SKU-' || lpad(CAST(k AS VARCHAR), 8, '0'), count(*)
            FROM (SELECT p_partkey - CAST(p_partkey % 37 = 0 AND p_partkey > 0 AS INTEGER) AS k
                  FROM part) GROUP BY k HAVING count(*) > 1""",
        "csv_bronze_items": _with(lines, _LANDED)
        + """
            SELECT order_item_id, order_id, product_id, quantity, unit_price,
                   CASE WHEN TRY_CAST(order_id AS BIGINT) % 31 = 0
                        THEN line_status || ' "q", x' || chr(10) || 'y' ELSE line_status
                   END AS line_status, status_updated_at, FALSE AS misfit FROM landed
            UNION ALL
            SELECT CAST(item + 6000000000000000 AS VARCHAR), order_id, product_id, quantity,
                   CAST(CAST(unit_price AS DECIMAL(10,2)) AS VARCHAR), line_status,
                   strftime(status_updated_at, '%Y-%m-%d %H:%M:%S'), TRUE
            FROM first_raw WHERE n % 37 = 0
            UNION ALL
            SELECT CAST(item + 7000000000000000 AS VARCHAR), order_id, product_id, NULL, NULL, NULL,
                   NULL, TRUE FROM first_raw WHERE n % 37 = 0""",
        "land_batch_then_stream": _with(lines, _LANDED) + "SELECT * FROM landed",
        "late_parent_items": cleaned + f"SELECT {_ITEM_COLUMNS} FROM latest",
        "stream_mart_monthly_replayed": on_moved + monthly,
        "mart_daily_by_deltas": on_moved + daily,
        "mart_weekly_by_deltas": on_moved + weekly,
        "mart_monthly_by_deltas": on_moved + monthly,
        "weekly_windows_closed": dealt + weekly.replace("FROM fact", "FROM dealt WHERE closed AND NOT late"),
        "weekly_windows_late": dealt
        + """SELECT order_item_id, order_id, product_id, order_date, quantity, line_total, line_status,
                    'late' AS late_reason FROM dealt WHERE late""",
        "items_still_waiting": _with(lines)
        + """SELECT CAST(order_item_id AS VARCHAR) AS order_item_id, CAST(order_id AS VARCHAR) AS order_id,
                    CAST(product_id AS VARCHAR) AS product_id, 'orphan_order' AS reject_reason
             FROM lines WHERE order_id % 3 = 0""",
        "csv_mixed_headers": _with(lines)
        + """SELECT CAST(order_item_id AS VARCHAR) AS order_item_id, CAST(order_id AS VARCHAR) AS order_id,
                    CAST(product_id AS VARCHAR) AS product_id, CAST(quantity AS VARCHAR) AS quantity,
                    CAST(CAST(unit_price AS DECIMAL(10,2)) AS VARCHAR) AS unit_price,
                    CASE WHEN order_id % 5 = 0 THEN ' ' || lower(line_status) || ' ' ELSE line_status END
                        AS line_status,
                    CASE WHEN order_id % 3 <> 2 THEN strftime(status_updated_at, '%Y-%m-%d %H:%M:%S') END
                        AS status_updated_at,
                    CASE WHEN order_id % 3 = 1 THEN 'WEB' END AS channel
             FROM lines""",
        "stream_bronze_items": _with(lines, _LANDED) + "SELECT * FROM landed",
        "stream_silver_items": cleaned + f"SELECT {_ITEM_COLUMNS} FROM latest",
        "stream_mart_monthly": _with(lines, _VERSIONS, _LATEST, _FACT.format(items="latest"))
        + monthly,
    }
