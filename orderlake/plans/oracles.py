"""The expected result of each registered query, as SQL over the supplied tables.

The statements do not repeat the cleaners: the supplied columns say what the
clean value of each row must be. Money is counted in integer cents (line totals
in hundredths of a cent) and rounded half up by integer division, so both sides
are exact.
"""

from __future__ import annotations

# Whole cents of a fiftieth of the price.
CENTS = "CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 0.02, 2) * 100 AS BIGINT)"


def eur(cents: str) -> str:
    """Cents as a double amount."""
    return f"(CAST({cents} AS DOUBLE) / 100)"


def mean(cents: str, n: str) -> str:
    """Average of a non-negative sum, rounded half up to cents; null for no rows."""
    return f"(CASE WHEN {n} > 0 THEN CAST((2 * ({cents}) + {n}) // (2 * {n}) AS DOUBLE) / 100 END)"


def pct(part: str, whole: str) -> str:
    """Share in percent, rounded half up to two decimals."""
    return mean(f"10000 * ({part})", f"({whole})")


DIRTY_ORD = f"""dirty_ord AS (
  SELECT o_orderkey,
    CASE WHEN o_totalprice >= 12000 AND o_totalprice < 13000 THEN NULL ELSE o_orderkey END AS order_id,
    CASE WHEN o_totalprice >= 6000 THEN o_custkey END AS customer_id,
    CASE WHEN day(o_orderdate) = 31 OR (o_totalprice >= 6000 AND o_totalprice < 8000) THEN NULL
         ELSE CAST(o_orderdate AS DATE) END AS order_date,
    CASE WHEN o_totalprice >= 8000 AND o_totalprice < 9000 THEN 'unknown'
         WHEN o_orderstatus = 'F' THEN 'completed'
         WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' ELSE 'cancelled' END
         ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'pending' WHEN '2-HIGH' THEN 'shipped'
              WHEN '3-MEDIUM' THEN 'refunded' WHEN '4-NOT SPECIFIED' THEN 'failed' ELSE 'on hold' END
         END AS status,
    CASE WHEN o_totalprice >= 497500 OR (o_totalprice >= 9000 AND o_totalprice < 11000) THEN NULL
         WHEN o_totalprice >= 11000 AND o_totalprice < 12000 THEN 0
         ELSE {CENTS} END AS cents
  FROM orders)"""
ORD = f"""{DIRTY_ORD},
ord AS (
  SELECT *, year(order_date) AS order_year, month(order_date) AS order_month,
    CASE WHEN status = 'completed' THEN 1 ELSE 0 END AS is_completed,
    CASE WHEN order_date IS NOT NULL AND customer_id IS NOT NULL AND cents > 0 THEN 1 ELSE 0 END AS is_valid_order
  FROM dirty_ord),
valid AS (SELECT * FROM ord WHERE is_valid_order = 1)"""

# Customers once each; "cus_all" also holds the second copy of nation 5.
CUS = """cus AS (
  SELECT CASE WHEN c_nationkey <> 11 THEN c_custkey END AS customer_id,
    CASE WHEN c_nationkey IN (0, 1) THEN NULL
         WHEN c_mktsegment = 'BUILDING' THEN 'Ann ' || c_name ELSE c_name END AS name,
    CASE WHEN c_nationkey IN (2, 3, 6) THEN NULL
         ELSE 'user' || c_custkey || '@shop.com' END AS email,
    CASE WHEN c_nationkey IN (7, 8) THEN NULL
         ELSE CAST(DATE '1990-01-01' + CAST(floor(c_acctbal) AS INTEGER) AS DATE) END AS join_date,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Premium' WHEN 'BUILDING' THEN 'Regular'
         WHEN 'FURNITURE' THEN 'Bronze' WHEN 'HOUSEHOLD' THEN 'Churned' ELSE 'Unknown' END AS segment,
    CASE WHEN c_nationkey IN (9, 10) OR c_mktsegment = 'MACHINERY' THEN NULL
         ELSE '+1-555-' || lpad(CAST(c_nationkey AS VARCHAR), 3, '2') || '-' || right(c_name, 4) END AS phone,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN true WHEN 'BUILDING' THEN false
         WHEN 'FURNITURE' THEN true WHEN 'HOUSEHOLD' THEN false END AS opt_in,
    CAST(floor(c_acctbal / 80) AS INTEGER) AS age,
    c_nationkey
  FROM customer),
cus_scored AS (
  SELECT *, 25.0::DOUBLE * (CASE WHEN customer_id IS NOT NULL THEN 1 ELSE 0 END
    + CASE WHEN name IS NOT NULL THEN 1 ELSE 0 END
    + CASE WHEN email IS NOT NULL THEN 1 ELSE 0 END
    + CASE WHEN join_date IS NOT NULL THEN 1 ELSE 0 END) AS dq
  FROM cus),
cus_all AS (
  SELECT * FROM cus_scored
  UNION ALL SELECT * REPLACE (name || ' copy' AS name) FROM cus_scored WHERE c_nationkey = 5)"""

ITM = """itm_base AS (
  SELECT l_orderkey * 10 + l_linenumber AS item_id, l_orderkey AS order_id,
    CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN NULL ELSE l_partkey END AS product_id,
    CAST(l_quantity AS BIGINT) AS q0,
    CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.02, 2) * 100 AS BIGINT) AS u0,
    CAST(round(l_discount * 100) AS BIGINT) AS r0,
    CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(round(l_tax * 100) AS BIGINT) END AS t0,
    l_linenumber, day(l_shipdate) AS ship_day
  FROM lineitem),
itm_raw AS (
  SELECT *,
    CASE WHEN ship_day = 31 THEN NULL WHEN ship_day = 30 THEN 0 ELSE q0 END AS raw_quantity,
    CASE WHEN ship_day = 29 THEN -u0 ELSE u0 END AS raw_price,
    CASE WHEN ship_day = 28 THEN 150 ELSE r0 END AS raw_discount,
    (u0 * t0 + 50) // 100 AS tax_cents,
    (q0 * u0 * (100 - r0) + 50) // 100 + coalesce((u0 * t0 + 50) // 100, 0)
      + CASE WHEN l_linenumber = 7 THEN 500 ELSE 0 END AS raw_total
  FROM itm_base),
itm_c AS (
  SELECT *,
    CASE WHEN ship_day IN (30, 31) THEN NULL ELSE q0 END AS quantity,
    CASE WHEN ship_day = 29 THEN NULL ELSE u0 END AS unit_cents,
    CASE WHEN ship_day = 28 THEN NULL ELSE r0 END AS discount
  FROM itm_raw),
itm AS (
  SELECT *,
    quantity * unit_cents AS subtotal_cents,
    coalesce(quantity * unit_cents * discount, 0) AS discount_e4,
    quantity * unit_cents * 100 - coalesce(quantity * unit_cents * discount, 0)
      + 100 * coalesce(tax_cents, 0) AS total_e4,
    coalesce(abs(raw_total * 100 - (quantity * unit_cents * 100
      - coalesce(quantity * unit_cents * discount, 0) + 100 * coalesce(tax_cents, 0))) < 100, false) AS calc_ok
  FROM itm_c)"""

PRD = """prd AS (
  SELECT CASE WHEN p_size <> 11 THEN p_partkey END AS product_id,
    CASE WHEN p_size IN (1, 2) THEN 'Unknown Product' ELSE p_name END AS product_name,
    CASE WHEN p_size = 50 THEN 'Toys' WHEN p_type IN ('STANDARD', 'MEDIUM') THEN 'Electronics'
         WHEN p_type = 'ECONOMY' THEN 'Home & Kitchen' WHEN p_type = 'PROMO' THEN 'Sports & Outdoors'
         WHEN p_type = 'SMALL' THEN 'Books' ELSE 'Other' END AS category,
    CASE p_type WHEN 'STANDARD' THEN true WHEN 'MEDIUM' THEN false WHEN 'ECONOMY' THEN true
         WHEN 'PROMO' THEN false WHEN 'SMALL' THEN true END AS active,
    CASE WHEN p_size IN (4, 5, 6) THEN NULL WHEN p_size = 8 THEN 0
         ELSE CAST(round(p_retailprice * 100) AS BIGINT) END AS price_cents,
    CASE p_size WHEN 9 THEN NULL WHEN 7 THEN CAST(round(p_retailprice * 100) AS BIGINT) + 10000
         ELSE CAST(round(p_retailprice * 100) AS BIGINT) - 30000 END AS cost_cents,
    p_size, p_name, p_type
  FROM part)"""

OFACT = f"""{ORD}, {CUS},
ofact AS (
  SELECT o.*, c.name AS customer_name, c.segment AS customer_segment, c.dq AS customer_data_quality
  FROM valid o JOIN cus_scored c ON c.customer_id = o.customer_id WHERE c.name IS NOT NULL)"""

FACT = f"""{OFACT}, {ITM}, {PRD},
fact AS (
  SELECT o.*, i.product_id, p.product_name, p.category AS product_category, i.quantity,
    i.unit_cents, i.total_e4, i.calc_ok, p.active
  FROM ofact o
  LEFT JOIN (SELECT * FROM itm WHERE quantity IS NOT NULL AND unit_cents IS NOT NULL) i ON i.order_id = o.order_id
  LEFT JOIN prd p ON p.product_id = i.product_id)"""

FACT_SELECT = f"""SELECT order_id, customer_id, customer_name, customer_segment, order_date,
  CAST(order_year AS INTEGER) AS order_year, CAST(order_month AS INTEGER) AS order_month, status,
  {eur('cents')} AS total_amount, product_id, product_name, product_category,
  CAST(quantity AS INTEGER) AS quantity, {eur('unit_cents')} AS unit_price,
  CAST(total_e4 AS DOUBLE) / 10000 AS line_total, is_completed, customer_data_quality,
  calc_ok AS line_calc_valid, active AS product_active FROM fact"""

RFM_OVER = """{name} AS (
  SELECT customer_id, SUM(cents) AS monetary_cents, COUNT(order_id) AS frequency,
    MAX(order_date) AS last_order_date,
    date_diff('day', MAX(order_date), DATE '2001-09-01') AS recency_days,
    CASE WHEN SUM(cents) >= 50000 AND date_diff('day', MAX(order_date), DATE '2001-09-01') <= 60 THEN 'high_value'
         WHEN SUM(cents) >= 25000 AND date_diff('day', MAX(order_date), DATE '2001-09-01') <= 90 THEN 'medium_value'
         ELSE 'low_value' END AS value_segment
  FROM {source} WHERE status = 'completed' GROUP BY customer_id)"""
RFM = f"{OFACT}, {RFM_OVER.format(name='rfm', source='ofact')}"
SALES = f"""{RFM},
sales AS (SELECT f.*, r.value_segment FROM ofact f JOIN rfm r ON r.customer_id = f.customer_id
  WHERE f.status = 'completed')"""
GOLD = f"""{SALES},
gold AS (
  SELECT CAST(order_year AS INTEGER) AS order_year, CAST(order_month AS INTEGER) AS order_month,
    customer_segment, value_segment, SUM(cents) AS revenue_cents,
    COUNT(order_id) AS order_count, COUNT(DISTINCT customer_id) AS customer_count
  FROM sales GROUP BY 1, 2, 3, 4)"""
GOLD_SELECT = f"""SELECT order_year, order_month, customer_segment, value_segment,
  {eur('revenue_cents')} AS revenue, order_count, customer_count FROM gold"""

CUST_METRICS = f"""{ORD}, {CUS},
per_customer AS (
  SELECT customer_id, COUNT(order_id) AS total_orders, SUM(cents) AS total_cents
  FROM valid WHERE status = 'completed' GROUP BY customer_id),
cmetrics AS (
  SELECT p.customer_id, total_orders, {eur('total_cents')} AS total_revenue,
    {mean('total_cents', 'total_orders')} AS avg_order_value, c.join_date, c.segment,
    CAST(date_diff('day', c.join_date, DATE '2001-09-01') AS INTEGER) AS tenure_days
  FROM per_customer p JOIN cus c ON c.customer_id = p.customer_id)"""

FRAUD = f"""{ORD}, {ITM},
totals AS (
  SELECT order_id, SUM(quantity) AS total_quantity, COUNT(item_id) AS item_count,
    MAX(quantity) AS max_item_quantity
  FROM itm WHERE quantity IS NOT NULL GROUP BY order_id),
lagged AS (
  SELECT v.*, LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id NULLS FIRST) AS prev_order_date
  FROM valid v),
parts AS (
  SELECT l.*, t.total_quantity, t.max_item_quantity,
    CASE WHEN cents > 500000 THEN 4 WHEN cents > 300000 THEN 3 WHEN cents > 200000 THEN 2
         WHEN cents > 100000 THEN 1 ELSE 0 END AS a,
    CASE WHEN order_date - prev_order_date < 1 THEN 4 WHEN order_date - prev_order_date < 3 THEN 2
         WHEN order_date - prev_order_date < 7 THEN 1 ELSE 0 END AS v,
    CASE WHEN total_quantity > 30 THEN 3 WHEN total_quantity > 20 THEN 2
         WHEN total_quantity > 15 THEN 1 ELSE 0 END AS q,
    CASE WHEN max_item_quantity > 25 THEN 3 WHEN max_item_quantity > 15 THEN 2
         WHEN max_item_quantity > 10 THEN 1 ELSE 0 END AS i
  FROM lagged l LEFT JOIN totals t ON t.order_id = l.order_id),
frd AS (
  SELECT order_id, customer_id, order_date AS order_date_cleaned, cents,
    {eur('cents')} AS total_amount_cleaned, CAST(total_quantity AS BIGINT) AS total_quantity,
    CAST(max_item_quantity AS INTEGER) AS max_item_quantity,
    CAST(a + v + q + i AS INTEGER) AS fraud_score,
    CASE WHEN v >= 2 AND a >= 2 THEN 'Velocity + High Value' WHEN v >= 3 THEN 'Velocity Fraud'
         WHEN a >= 3 THEN 'High Value Fraud' WHEN q >= 2 THEN 'Bulk Purchase Fraud'
         WHEN i >= 2 THEN 'Suspicious Quantity' ELSE 'Mixed Pattern' END AS fraud_type,
    CASE WHEN a + v + q + i >= 8 THEN 'Critical' WHEN a + v + q + i >= 6 THEN 'High'
         WHEN a + v + q + i >= 4 THEN 'Medium' ELSE 'Low' END AS risk_level,
    true AS potential_fraud
  FROM parts WHERE a + v + q + i >= 3)"""

LIVE = """live AS (
  SELECT event_id AS order_id, user_id AS customer_id, ts AS event_timestamp,
    CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'cancelled'
         WHEN 'view' THEN 'pending' WHEN 'click' THEN 'shipped' WHEN 'signup' THEN 'refunded' END AS status,
    CAST(round(value * 100) AS BIGINT) * 20 AS cents, value, event_type
  FROM events),
live_scored AS (
  SELECT *, CAST(CASE WHEN cents > 500000 THEN 4 WHEN cents > 300000 THEN 3
         WHEN cents > 200000 THEN 2 ELSE 0 END
    + CASE WHEN status IN ('cancelled', 'refunded') THEN 1 ELSE 0 END AS INTEGER) AS fraud_score
  FROM live),
alerts AS (
  SELECT *, CAST(a + s AS INTEGER) AS score FROM (
    SELECT *, CASE WHEN cents > 500000 THEN 4 WHEN cents > 200000 THEN 2 ELSE 0 END AS a,
      CASE WHEN status IN ('cancelled', 'refunded') THEN 1 ELSE 0 END AS s FROM live)
  WHERE a + s >= 3)"""
ALERT_SELECT = f"""SELECT 'fraud_alert' AS event_type, event_timestamp,
  'FRAUD_' || order_id || '_' || CAST(floor(epoch(event_timestamp)) AS BIGINT) AS alert_id,
  order_id, customer_id, score AS fraud_score,
  CASE WHEN score >= 5 THEN 'HIGH' ELSE 'MEDIUM' END AS risk_level,
  CASE WHEN a = 4 THEN 'High transaction amount' ELSE 'Elevated transaction amount' END
    || CASE WHEN s = 1 THEN '; Suspicious order status' ELSE '' END AS reasons,
  {eur('cents')} AS total_amount, status, score >= 5 AS requires_review FROM alerts"""

# Stream events: sales under 1 have no readable time; views and clicks no readable date.
STREAM = f"""{LIVE},
ev AS (
  SELECT *, CASE WHEN value < 1 THEN NULL ELSE event_timestamp END AS t,
    CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE CAST(event_timestamp AS DATE) END AS d
  FROM live),
enriched AS (
  SELECT *, CAST(year(coalesce(d, CAST(t AS DATE))) AS INTEGER) AS order_year,
    CAST(month(coalesce(d, CAST(t AS DATE))) AS INTEGER) AS order_month
  FROM ev),
done AS (SELECT * FROM enriched WHERE status = 'completed' AND t IS NOT NULL)"""
RAW_EVENT = f"""'order' AS event_type,
  CASE WHEN value < 1 THEN 'n/a' ELSE strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') END AS event_timestamp,
  order_id, customer_id,
  CASE event_type WHEN 'purchase' THEN strftime(event_timestamp, '%Y/%m/%d') WHEN 'click' THEN 'soon'
    WHEN 'view' THEN NULL ELSE strftime(event_timestamp, '%m/%d/%Y') END AS order_date,
  status, {eur('cents')} AS total_amount, 'events' AS source_system"""
ENRICHED_SELECT = f"""SELECT {RAW_EVENT}, {{extra}} order_year, order_month,
  CASE WHEN status = 'completed' THEN 1 ELSE 0 END AS is_completed, 1 AS is_valid_order FROM enriched"""
WINDOW_SELECT = f"""status, COUNT(order_id) AS order_count, {eur('SUM(cents)')} AS total_revenue,
  {mean('SUM(cents)', 'COUNT(order_id)')} AS avg_order_value"""



def arrivals(days: int, turn: str, kept: str) -> str:
    """Events by the part in which they arrive, and the mark before each part: the latest time
    of the parts before it less ten minutes."""
    return f"""a AS (SELECT *, xor(CAST((coalesce(day(t), 1) - 1) // {days} + CASE WHEN order_id % 5 = 0 THEN 1 ELSE 0 END
    AS INTEGER), {turn}) AS arrival FROM enriched WHERE {kept}),
marks AS (SELECT arrival, MAX(MAX(t)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL 10 MINUTE AS mark FROM a GROUP BY arrival)"""


LATE_WINDOWS = f"""WITH {STREAM}, {arrivals(8, '1', "status = 'completed'")},
judged AS (SELECT a.*, date_trunc('hour', t) AS ws,
    t IS NULL OR coalesce(date_trunc('hour', t) + INTERVAL 1 HOUR <= mark, false) AS late FROM a JOIN marks USING (arrival))"""

MSG = """msg AS (
  SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS partition, event_id AS "offset",
    CAST(user_id AS VARCHAR) AS key, ts AS timestamp, event_id, user_id, value, props
  FROM events),
declared AS (
  SELECT topic, partition FROM (SELECT DISTINCT event_type AS topic FROM events),
    (VALUES (0), (1), (2), (3)) AS p(partition)),
stats AS (
  SELECT d.topic, d.partition, COUNT(m."offset") AS messages,
    coalesce(MIN(m."offset"), -1) AS earliest_offset, coalesce(MAX(m."offset"), -1) AS latest_offset
  FROM declared d LEFT JOIN msg m ON m.topic = d.topic AND m.partition = d.partition
  GROUP BY d.topic, d.partition)"""
JSON_VALUE = """'{"order_id":' || event_id || ',"customer_id":' || user_id || ',"total_amount":'
  || value || ',"quantity":' || json_extract_string(props, '$.k') || '}'"""

BROKEN = f"""broken AS (
  SELECT topic, partition, "offset", timestamp, key,
    CASE "offset" % 97 WHEN 0 THEN substr(whole, 1, length(whole) // 2) WHEN 1 THEN NULL WHEN 2 THEN ' '
      WHEN 3 THEN '{{"order_id":"none"}}' ELSE whole END AS value,
    CASE "offset" % 97 WHEN 0 THEN 'malformed' WHEN 1 THEN 'no_value' WHEN 2 THEN 'no_value'
      WHEN 3 THEN 'malformed' END AS decode_error
  FROM (SELECT *, {JSON_VALUE} AS whole FROM msg))"""
OFFSET_GAPS = """gaps AS (
  SELECT topic, partition, before + 1 AS gap_start, "offset" - 1 AS gap_end, "offset" - before - 1 AS missing FROM (
    SELECT *, LAG("offset") OVER (PARTITION BY topic, partition ORDER BY "offset") AS before FROM msg)
  WHERE "offset" - before > 1)"""

# Null counts of the raw tables, column by column.
RAW_ORDERS_EMPTY = {
    "order_id": "SUM(CASE WHEN o_totalprice >= 12000 AND o_totalprice < 13000 THEN 1 ELSE 0 END)",
    "customer_id": "SUM(CASE WHEN o_totalprice < 6000 THEN 1 ELSE 0 END)",
    "order_date": "SUM(CASE WHEN day(o_orderdate) <> 31 AND o_totalprice >= 6000 AND o_totalprice < 8000 THEN 1 ELSE 0 END)",
    "status": "SUM(CASE WHEN o_totalprice >= 8000 AND o_totalprice < 9000 THEN 1 ELSE 0 END)",
    "total_amount": "0",
    "source_system": "0",
    "last_updated": "0",
}
RAW_ITEMS_EMPTY = {
    "item_id": "0",
    "order_id": "0",
    "product_id": "SUM(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END)",
    "quantity": "SUM(CASE WHEN raw_quantity IS NULL THEN 1 ELSE 0 END)",
    "price": "0",
    "discount_percent": "0",
    "tax_amount": "SUM(CASE WHEN tax_cents IS NULL THEN 1 ELSE 0 END)",
    "line_total": "0",
}
RAW_CUSTOMERS_EMPTY = {
    "customer_id": "SUM(CASE WHEN c_nationkey = 11 THEN 1 ELSE 0 END)",
    "name": "0",
    "email": "SUM(CASE WHEN c_nationkey = 6 THEN 1 ELSE 0 END)",
    "join_date": "SUM(CASE WHEN c_nationkey = 7 THEN 1 ELSE 0 END)",
    "segment": "0",
    "phone": "0",
    "address": "COUNT(*)",
    "age": "0",
    "marketing_opt_in": "0",
    "last_login": "COUNT(*)",
}
RAW_PRODUCTS_EMPTY = {
    "product_id": "SUM(CASE WHEN p_size = 11 THEN 1 ELSE 0 END)",
    "product_name": "SUM(CASE WHEN p_size = 2 THEN 1 ELSE 0 END)",
    "category": "0",
    "subcategory": "0",
    "unit_price": "SUM(CASE WHEN p_size = 4 THEN 1 ELSE 0 END)",
    "cost": "SUM(CASE WHEN p_size = 9 THEN 1 ELSE 0 END)",
    "supplier_id": "COUNT(*)",
    "is_active": "SUM(CASE WHEN p_type = 'LARGE' THEN 1 ELSE 0 END)",
    "created_date": "0",
    "weight_kg": "0",
}


def table_line(name: str, empties: dict[str, str], source: str, key: str) -> str:
    """One line of the quality report."""
    n = len(empties)
    # Percentages in hundredths, each rounded, then averaged.
    hundredths = [f"(2 * 10000 * {e} + COUNT(*)) // (2 * COUNT(*))" for e in empties.values()]
    kept = " + ".join(f"(10000 - {h})" for h in hundredths)
    return f"""SELECT '{name}' AS table_name, COUNT(*) AS total_rows, {n} AS total_columns,
      COUNT(*) - COUNT(DISTINCT {key}) - MAX(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END) AS duplicate_rows,
      CAST((2 * ({kept}) + {n}) // (2 * {n}) AS DOUBLE) / 100 AS completeness_score FROM {source}"""


SUMMARY = " UNION ALL ".join(
    [
        table_line("orders", RAW_ORDERS_EMPTY, "orders JOIN dirty_ord USING (o_orderkey)", "order_id"),
        table_line("customers", RAW_CUSTOMERS_EMPTY, "cus_all", "customer_id"),
        table_line("order_items", RAW_ITEMS_EMPTY, "itm_raw", "item_id"),
        table_line("products", RAW_PRODUCTS_EMPTY, "prd", "product_id"),
    ]
)


def _quantile(p: str, order: str = "cents") -> str:
    """Lower quantile by rank within numbered rows."""
    return f"MIN(CASE WHEN rn >= ceil({p} * n) THEN {order} END)"


def statements() -> dict[str, str]:
    item_columns = "item_id, product_id, quantity, price, discount_percent, line_total"
    raw_items = f"""SELECT item_id, product_id, CAST(raw_quantity AS INTEGER) AS quantity,
      {eur('raw_price')} AS price, CAST(raw_discount AS DOUBLE) AS discount_percent,
      {eur('raw_total')} AS line_total FROM itm_raw"""
    numbered_items = f"""raw AS ({raw_items}), numbered AS (SELECT *, ROW_NUMBER() OVER (
      PARTITION BY item_id ORDER BY product_id NULLS FIRST, quantity NULLS FIRST, price,
      discount_percent, line_total) AS rn FROM raw)"""
    sql = {
        # ---- sources, sinks, layers
        "src_csv": f"""WITH {ITM} SELECT item_id, order_id, product_id,
            CAST(raw_quantity AS INTEGER) AS quantity, {eur('raw_price')} AS price,
            CAST(raw_discount AS DOUBLE) AS discount_percent, {eur('tax_cents')} AS tax_amount,
            {eur('raw_total')} AS line_total FROM itm_raw""",
        "src_json": f"""WITH {CUS} SELECT customer_id, name, segment, join_date,
            dq AS data_quality_score FROM cus_all""",
        "src_parquet": "SELECT * FROM part",
        "src_optional": "SELECT 'present' AS input, COUNT(*) AS n FROM orders UNION ALL SELECT 'absent', 0",
        "src_stream_file": f"WITH {LIVE} SELECT {RAW_EVENT} FROM live",
        "src_stream_kafka": """SELECT event_id AS order_id, user_id AS customer_id,
            value AS total_amount, CAST(json_extract_string(props, '$.k') AS INTEGER) AS quantity FROM events""",
        "snk_bronze": """SELECT 'orders' AS table_name, COUNT(*) AS rows FROM orders
            UNION ALL SELECT 'customers', COUNT(*) + SUM(CASE WHEN c_nationkey = 5 THEN 1 ELSE 0 END) FROM customer
            UNION ALL SELECT 'order_items', COUNT(*) FROM lineitem
            UNION ALL SELECT 'products', COUNT(*) FROM part""",
        "snk_silver": f"""WITH {ORD} SELECT order_id, customer_id, order_date, status,
            {eur('cents')} AS total_amount, CAST(order_year AS INTEGER) AS order_year,
            CAST(order_month AS INTEGER) AS order_month, is_completed, is_valid_order FROM valid""",
        "snk_fact": f"WITH {FACT} {FACT_SELECT}",
        "snk_metrics": f"WITH {CUST_METRICS} SELECT * FROM cmetrics",
        "snk_gold": f"WITH {GOLD} {GOLD_SELECT}",
        "snk_csv": f"WITH {GOLD} {GOLD_SELECT}",
        "snk_stream_bronze": f"""WITH {LIVE} SELECT status, COUNT(*) AS rows, {eur('SUM(cents)')} AS amount
            FROM live GROUP BY status""",
        "snk_stream_silver": f"""WITH {STREAM} SELECT
            CASE WHEN order_year IS NULL THEN 'invalid_dates' ELSE 'silver' END AS layer,
            order_year, order_month, COUNT(*) AS rows FROM enriched GROUP BY 1, 2, 3""",
        "snk_stream_snapshot": f"""WITH {STREAM} SELECT date_trunc('hour', t) AS window_start,
            date_trunc('hour', t) + INTERVAL 1 HOUR AS window_end, {WINDOW_SELECT}, true AS customers_within_bound
            FROM done GROUP BY 1, 2, status""",
        "layer_freshness": f"""WITH {ORD} SELECT 'bronze' AS layer, COUNT(*) AS rows, true AS has_files,
            true AS was_written, MAX(ts) AS last_event FROM events
            UNION ALL SELECT 'silver', COUNT(*), true, true, NULL FROM valid""",
        # ---- cleaners
        "cln_name": f"WITH {CUS} SELECT customer_id, name AS name_cleaned FROM cus_all",
        "cln_email": f"WITH {CUS} SELECT customer_id, email AS email_cleaned FROM cus_all",
        "cln_date": f"WITH {ORD} SELECT order_id, order_date AS order_date_cleaned FROM ord",
        "cln_status": f"WITH {ORD} SELECT order_id, status AS status_cleaned FROM ord",
        "cln_segment": f"WITH {CUS} SELECT customer_id, segment AS segment_cleaned FROM cus_all",
        "cln_bool": f"WITH {CUS} SELECT customer_id, opt_in AS opt_in_cleaned FROM cus_all",
        "cln_num": f"WITH {ORD} SELECT order_id, {eur('cents')} AS total_amount_cleaned FROM ord",
        "cln_phone": f"WITH {CUS} SELECT customer_id, phone AS phone_cleaned FROM cus_all",
        "cln_prodname": f"WITH {PRD} SELECT product_id, product_name AS product_name_cleaned FROM prd",
        "cln_category": f"WITH {PRD} SELECT product_id, category AS category_cleaned FROM prd",
        # ---- enrichment
        "enr_orders_raw": f"""WITH raw AS ({_raw_texts()}),
            iso AS (SELECT *, CASE WHEN order_date LIKE '____-__-__' AND order_date <> '2024-13-45'
              THEN CAST(strptime(order_date, '%Y-%m-%d') AS DATE) END AS day FROM raw)
            SELECT order_id, status, CAST(year(day) AS INTEGER) AS order_year,
              CAST(month(day) AS INTEGER) AS order_month,
              CASE WHEN status = 'completed' THEN 1 ELSE 0 END AS is_completed FROM iso""",
        "enr_orders": f"""WITH {ORD} SELECT order_id, customer_id, order_date, status,
            {eur('cents')} AS total_amount, CAST(order_year AS INTEGER) AS order_year,
            CAST(order_month AS INTEGER) AS order_month, is_completed, is_valid_order FROM ord""",
        "enr_customers": f"""WITH {CUS} SELECT customer_id, name AS name_cleaned, email AS email_cleaned,
            join_date AS join_date_cleaned, segment AS segment_cleaned, opt_in AS marketing_opt_in_cleaned,
            phone AS phone_cleaned, dq AS data_quality_score,
            CAST(date_diff('day', join_date, DATE '2001-09-01') AS INTEGER) AS tenure_days,
            CASE WHEN age BETWEEN 18 AND 120 THEN age END AS age_valid FROM cus_all""",
        "enr_items": f"""WITH {ITM} SELECT item_id, product_id, CAST(quantity AS INTEGER) AS quantity_cleaned,
            {eur('unit_cents')} AS price_cleaned, CAST(discount AS DOUBLE) AS discount_percent_cleaned,
            {eur('subtotal_cents')} AS subtotal_calculated,
            CAST(discount_e4 AS DOUBLE) / 10000 AS discount_amount_calculated,
            CAST(total_e4 AS DOUBLE) / 10000 AS line_total_calculated, calc_ok AS calculation_matches FROM itm""",
        "enr_products": f"""WITH {PRD} SELECT product_id, {eur('price_cents')} AS unit_price_cleaned,
            {eur('cost_cents')} AS cost_cleaned,
            CASE WHEN p_size < 50 THEN p_size * 1.5::DOUBLE END AS weight_kg_cleaned, active AS is_active_cleaned,
            CASE WHEN p_size <> 10 THEN CAST(DATE '2020-01-01' + p_size AS DATE) END AS created_date_cleaned,
            product_name AS product_name_cleaned, category AS category_cleaned,
            CASE WHEN price_cents > 0 THEN CAST(CASE WHEN price_cents >= cost_cents
              THEN (2 * 10000 * (price_cents - cost_cents) + price_cents) // (2 * price_cents)
              ELSE -((2 * 10000 * (cost_cents - price_cents) + price_cents) // (2 * price_cents)) END
              AS DOUBLE) / 100 END AS margin_percent,
            cost_cents <= price_cents AS price_cost_valid FROM prd""",
        # ---- filters
        "flt_valid_ratio": f"""WITH {ORD} SELECT COUNT(*) AS total_rows, CAST(SUM(is_valid_order) AS BIGINT) AS valid_rows,
            {pct('SUM(is_valid_order)', 'COUNT(*)')} AS valid_percent FROM ord""",
        "flt_bad_date": f"""SELECT order_id, order_date, status FROM ({_raw_texts()}) JOIN orders USING (o_orderkey)
            WHERE day(o_orderdate) = 31 OR (o_totalprice >= 6000 AND o_totalprice < 8000)
              OR CAST(o_orderdate AS DATE) > DATE '2001-07-01'""",
        "flt_bad_email": """SELECT c_custkey AS customer_id, CASE c_nationkey WHEN 2 THEN 'notanemail'
            WHEN 3 THEN 'user@domain' WHEN 4 THEN ' User' || c_custkey || '@Shop.COM ' END AS email
            FROM customer WHERE c_nationkey IN (2, 3, 4, 6)""",
        "flt_neg_amount": f"""WITH {ORD} SELECT o_orderkey AS order_id, o_custkey AS customer_id,
            -{eur(CENTS)} AS total_amount FROM orders WHERE o_totalprice >= 9000 AND o_totalprice < 11000""",
        "flt_dash": f"""WITH {GOLD} {GOLD_SELECT} WHERE order_year IN (1999, 2000, 2001)
            AND customer_segment IN ('Premium', 'Regular') AND value_segment = 'low_value'""",
        "flt_recent": f"""WITH {LIVE} SELECT order_id, customer_id, event_timestamp, status,
            {eur('cents')} AS total_amount FROM live WHERE status = 'completed' AND cents >= 50000
            ORDER BY event_timestamp DESC, order_id DESC LIMIT 100""",
        "flt_high_value": f"""WITH {RFM} SELECT customer_id, {eur('monetary_cents')} AS monetary, frequency,
            last_order_date, CAST(recency_days AS INTEGER) AS recency_days, value_segment
            FROM rfm WHERE value_segment = 'high_value'""",
        "flt_review": None,
        # ---- joins
        "join_fact_raw": None,
        "join_fact": f"WITH {FACT} {FACT_SELECT}",
        "join_metrics": f"WITH {CUST_METRICS} SELECT customer_id, total_orders, join_date, segment FROM cmetrics",
        "join_rfm": f"WITH {SALES} SELECT order_id, customer_id, {eur('cents')} AS total_amount, value_segment FROM sales",
        "join_fraud_items": f"""WITH {FRAUD} SELECT v.order_id, v.customer_id,
            CAST(t.total_quantity AS BIGINT) AS total_quantity, t.item_count,
            CAST(t.max_item_quantity AS INTEGER) AS max_item_quantity
            FROM valid v LEFT JOIN totals t ON t.order_id = v.order_id""",
        "anti_refint": f"""WITH {ORD}, {CUS}, {ITM}, {PRD}
            SELECT 'orders_missing_customers' AS issue, COUNT(*) AS orphan_count FROM ord o
              WHERE customer_id IS NOT NULL
              AND NOT EXISTS (SELECT 1 FROM cus c WHERE c.customer_id = o.customer_id)
            UNION ALL SELECT 'order_items_missing_orders', COUNT(*) FROM itm_raw i
              WHERE NOT EXISTS (SELECT 1 FROM ord o WHERE o.order_id = i.order_id)
            UNION ALL SELECT 'order_items_missing_products', COUNT(*) FROM itm_raw i
              WHERE product_id IS NOT NULL
              AND NOT EXISTS (SELECT 1 FROM prd p WHERE p.product_id = i.product_id)""",
        "anti_refint_rows": f"""WITH {ORD}, {ITM} SELECT item_id, order_id, {eur('raw_total')} AS line_total
            FROM itm_raw i WHERE NOT EXISTS (SELECT 1 FROM ord o WHERE o.order_id = i.order_id)""",
        # ---- aggregates
        "agg_overall": f"""WITH {ORD} SELECT {eur('SUM(cents)')} AS total_revenue, COUNT(order_id) AS completed_orders,
            {mean('SUM(cents)', 'COUNT(order_id)')} AS avg_order_value FROM valid WHERE status = 'completed'""",
        "agg_cust_metrics": f"WITH {CUST_METRICS} SELECT * FROM cmetrics",
        "agg_monthly": f"""WITH {ORD} SELECT CAST(order_year AS INTEGER) AS order_year,
            CAST(order_month AS INTEGER) AS order_month, {eur('SUM(cents)')} AS monthly_revenue
            FROM valid WHERE status = 'completed' GROUP BY 1, 2""",
        "agg_segment": f"""WITH {OFACT} SELECT customer_segment, {eur('SUM(cents)')} AS total_revenue,
            COUNT(order_id) AS order_count, {mean('SUM(cents)', 'COUNT(order_id)')} AS avg_order_value
            FROM ofact WHERE status = 'completed' GROUP BY customer_segment""",
        "agg_segment_line": f"""WITH {FACT} SELECT customer_segment, {eur('SUM(cents)')} AS total_revenue,
            COUNT(order_id) AS order_count, {mean('SUM(cents)', 'COUNT(order_id)')} AS avg_order_value
            FROM fact WHERE status = 'completed' GROUP BY customer_segment""",
        "agg_status": f"WITH {ORD} SELECT status, COUNT(order_id) AS count FROM ord GROUP BY status",
        "agg_category": f"""WITH {FACT} SELECT product_category,
            {eur('(CAST(SUM(total_e4) AS BIGINT) + 50) // 100')} AS category_revenue,
            CAST(SUM(quantity) AS BIGINT) AS units_sold
            FROM fact WHERE is_completed = 1 GROUP BY product_category""",
        "agg_category_order_total": f"""WITH {FACT} SELECT product_category,
            {eur('SUM(quantity * cents)')} AS category_revenue, CAST(SUM(quantity) AS BIGINT) AS units_sold
            FROM fact WHERE is_completed = 1 GROUP BY product_category""",
        "agg_rfm": f"""WITH {RFM} SELECT customer_id, {eur('monetary_cents')} AS monetary, frequency,
            last_order_date, CAST(recency_days AS INTEGER) AS recency_days, value_segment FROM rfm""",
        "agg_gold": f"WITH {GOLD} {GOLD_SELECT}",
        "agg_gold_line": f"""WITH {FACT}, {RFM_OVER.format(name='rfm', source='fact')}
            SELECT CAST(order_year AS INTEGER) AS order_year, CAST(order_month AS INTEGER) AS order_month,
              customer_segment, value_segment, {eur('SUM(cents)')} AS revenue,
              COUNT(order_id) AS order_count, COUNT(f.customer_id) AS customer_count
            FROM fact f JOIN rfm r ON r.customer_id = f.customer_id WHERE status = 'completed' GROUP BY 1, 2, 3, 4""",
        "agg_item_preagg": f"""WITH {ITM} SELECT order_id, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
            COUNT(item_id) AS item_count, CAST(MAX(quantity) AS INTEGER) AS max_item_quantity
            FROM itm WHERE quantity IS NOT NULL GROUP BY order_id""",
        "agg_dash_kpi": f"""WITH {SALES} SELECT {eur('coalesce(SUM(cents), 0)')} AS total_revenue,
            COUNT(order_id) AS total_orders, COUNT(DISTINCT customer_id) AS unique_customers,
            coalesce({mean('SUM(cents)', 'COUNT(order_id)')}, 0) AS avg_order_value FROM sales
            WHERE order_year IN (1999, 2000, 2001) AND customer_segment IN ('Premium', 'Regular', 'Bronze')""",
        "agg_dash_kpi_sketch": f"""WITH {SALES} SELECT {eur('coalesce(SUM(cents), 0)')} AS total_revenue,
            COUNT(order_id) AS total_orders, TRUE AS customers_within_5_percent,
            coalesce({mean('SUM(cents)', 'COUNT(order_id)')}, 0) AS avg_order_value FROM sales
            WHERE order_year IN (1999, 2000, 2001) AND customer_segment IN ('Premium', 'Regular', 'Bronze')""",
        "agg_dash_trend": f"""WITH {GOLD} SELECT order_year || '-' || lpad(CAST(order_month AS VARCHAR), 2, '0') AS year_month,
            {eur('SUM(revenue_cents)')} AS revenue FROM gold GROUP BY 1""",
        "agg_dash_seg": f"""WITH {GOLD} SELECT customer_segment, {eur('SUM(revenue_cents)')} AS revenue
            FROM gold GROUP BY 1""",
        "agg_dash_value": f"""WITH {SALES} SELECT value_segment, {eur('SUM(cents)')} AS revenue,
            COUNT(DISTINCT customer_id) AS customers FROM sales GROUP BY 1""",
        "agg_live": f"""WITH {LIVE} SELECT COUNT(*) AS total_orders,
            CAST(SUM(CASE WHEN recent THEN 1 ELSE 0 END) AS BIGINT) AS recent_orders,
            {eur('SUM(cents)')} AS total_revenue,
            {eur('coalesce(SUM(CASE WHEN recent THEN cents END), 0)')} AS recent_revenue,
            COUNT(DISTINCT customer_id) AS unique_customers,
            CAST(SUM(CASE WHEN status = 'completed' THEN 1 ELSE 0 END) AS BIGINT) AS completed_orders,
            {mean('SUM(cents)', 'COUNT(*)')} AS avg_order_value,
            {pct("SUM(CASE WHEN status = 'completed' THEN 1 ELSE 0 END)", 'COUNT(*)')} AS completion_rate
            FROM (SELECT *, event_timestamp >= TIMESTAMP '2024-01-30 22:00:00' AS recent FROM live)""",
        "agg_5min": f"""WITH {LIVE} SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS time_bucket,
            COUNT(order_id) AS orders, {eur('SUM(cents)')} AS revenue FROM live
            WHERE event_timestamp >= TIMESTAMP '2024-01-30 21:00:00' GROUP BY 1""",
        "agg_hist": f"""WITH {ORD}, v AS (SELECT {eur('cents')} AS v FROM valid),
            e AS (SELECT MIN(v) AS lo, (MAX(v) - MIN(v)) / 30 AS w FROM v),
            b AS (SELECT CAST(least(floor((v - lo) / w), 29) AS INTEGER) AS bin, lo, w FROM v, e)
            SELECT bin, lo + bin * w AS bin_start, lo + (bin + 1) * w AS bin_end, COUNT(*) AS count
            FROM b GROUP BY bin, lo, w""",
        "agg_hist_score": f"""WITH {FRAUD}, v AS (SELECT CAST(fraud_score AS DOUBLE) AS v FROM frd),
            e AS (SELECT MIN(v) AS lo, (MAX(v) - MIN(v)) / 10 AS w FROM v),
            b AS (SELECT CAST(least(floor((v - lo) / w), 9) AS INTEGER) AS bin, lo, w FROM v, e)
            SELECT bin, lo + bin * w AS bin_start, lo + (bin + 1) * w AS bin_end, COUNT(*) AS count
            FROM b GROUP BY bin, lo, w""",
        "agg_box": f"""WITH {ORD}, r AS (SELECT status, cents,
              ROW_NUMBER() OVER (PARTITION BY status ORDER BY cents) AS rn,
              COUNT(*) OVER (PARTITION BY status) AS n FROM valid)
            SELECT status, COUNT(*) AS n, {eur('MIN(cents)')} AS minimum, {eur(_quantile('0.25'))} AS q1,
              {eur(_quantile('0.5'))} AS median, {eur(_quantile('0.75'))} AS q3,
              {eur('MAX(cents)')} AS maximum FROM r GROUP BY status""",
        "agg_box_approx": f"""WITH {ORD}, p AS (SELECT unnest([0.25, 0.5, 0.75]::DOUBLE[]) AS probability)
            SELECT status, probability, COUNT(*) AS n, {eur('MIN(cents)')} AS minimum,
              {eur('MAX(cents)')} AS maximum, TRUE AS within_error FROM valid, p GROUP BY ALL""",
        "agg_fraud_kpi": f"""WITH {FRAUD} SELECT COUNT(*) AS alerts,
            CAST(SUM(CASE WHEN fraud_score >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS high_risk,
            {eur('SUM(cents)')} AS fraud_amount, {mean('SUM(cents)', 'COUNT(*)')} AS avg_amount,
            {mean('100 * SUM(fraud_score)', 'COUNT(*)')} AS avg_score, MAX(fraud_score) AS max_score FROM frd""",
        "agg_fraud_kpi_live": f"""WITH {LIVE} SELECT COUNT(*) AS alerts,
            CAST(SUM(CASE WHEN fraud_score >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS high_risk,
            {eur('SUM(cents)')} AS fraud_amount, {mean('SUM(cents)', 'COUNT(*)')} AS avg_amount,
            {mean('100 * SUM(fraud_score)', 'COUNT(*)')} AS avg_score, MAX(fraud_score) AS max_score
            FROM live_scored WHERE fraud_score >= 3""",
        "agg_cust_events": """SELECT COUNT(*) AS total_events, COUNT(DISTINCT user_id) AS unique_customers,
            CAST(SUM(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS new_customers,
            CAST(SUM(CASE WHEN event_type <> 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS customer_updates FROM events""",
        "agg_cust_events_segment": """SELECT c_mktsegment AS customer_segment, COUNT(*) AS events
            FROM events LEFT JOIN customer ON c_custkey = user_id GROUP BY 1""",
        "agg_item_events": """SELECT COUNT(*) AS total_items, COUNT(DISTINCT l_orderkey) AS orders_with_items,
            CAST(SUM(l_quantity) AS BIGINT) AS total_quantity,
            CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_value FROM lineitem""",
        "agg_item_events_category": """SELECT p_type AS category, CAST(SUM(l_quantity) AS BIGINT) AS total_quantity,
            CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, COUNT(*) AS item_count
            FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1""",
        "agg_alert_kpi": f"""WITH {LIVE} SELECT COUNT(*) AS total_alerts,
            CAST(SUM(CASE WHEN score >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS high_risk,
            CAST(SUM(CASE WHEN score >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS requires_review,
            {mean('100 * SUM(score)', 'COUNT(*)')} AS avg_fraud_score FROM alerts""",
        "agg_alert_risk": f"""WITH {LIVE} SELECT CASE WHEN score >= 5 THEN 'HIGH' ELSE 'MEDIUM' END AS risk_level,
            COUNT(*) AS alerts FROM alerts GROUP BY 1""",
        "agg_reasons": f"""WITH {LIVE}, reasons AS (
              SELECT CASE WHEN a = 4 THEN 'High transaction amount' ELSE 'Elevated transaction amount' END AS reason FROM alerts
              UNION ALL SELECT 'Suspicious order status' FROM alerts WHERE s = 1)
            SELECT reason, COUNT(*) AS frequency FROM reasons GROUP BY reason""",
        # ---- windows, top-k, set operations
        "win_lag_month": f"""WITH {ORD},
            m AS (SELECT CAST(order_year AS INTEGER) AS order_year, CAST(order_month AS INTEGER) AS order_month,
              CAST(SUM(cents) AS BIGINT) AS c FROM valid WHERE status = 'completed' GROUP BY 1, 2),
            l AS (SELECT *, LAG(c) OVER (ORDER BY order_year, order_month) AS p FROM m)
            SELECT order_year, order_month, {eur('c')} AS monthly_revenue, {eur('p')} AS prev_month_revenue,
              CAST((2 * 10000 * (p - c) + p) // (2 * p) AS DOUBLE) / 10000 AS revenue_drop_pct
            FROM l WHERE (p - c) * 20 >= p""",
        "win_lag_order": f"""WITH {ORD}, l AS (SELECT order_id, customer_id, order_date,
              LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id NULLS FIRST) AS prev_order_date FROM valid)
            SELECT *, CAST(order_date - prev_order_date AS INTEGER) AS days_since_last_order FROM l""",
        "win_dedup_flag": f"WITH {ITM}, {numbered_items} SELECT {item_columns}, rn > 1 AS is_duplicate FROM numbered",
        "win_dedup_drop": f"WITH {ITM}, {numbered_items} SELECT {item_columns} FROM numbered WHERE rn = 1",
        "win_orders_1h": """SELECT event_id AS order_id, user_id AS customer_id, ts AS order_timestamp,
            COUNT(*) OVER (PARTITION BY user_id ORDER BY ts
              RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS orders_in_last_hour FROM events""",
        "topk_customers": f"""WITH {CUST_METRICS} SELECT customer_id, total_orders, total_revenue, avg_order_value, segment
            FROM cmetrics ORDER BY total_revenue DESC, customer_id LIMIT 5""",
        "topk_fraud": f"""WITH {FRAUD} SELECT * EXCLUDE (cents) FROM frd ORDER BY fraud_score DESC, order_id NULLS FIRST LIMIT 10""",
        "topk_latest": f"""WITH {LIVE} SELECT order_id, customer_id, event_timestamp, status, {eur('cents')} AS total_amount
            FROM live ORDER BY event_timestamp DESC, order_id DESC LIMIT 1000""",
        "sort_report": f"WITH {ORD} SELECT status, COUNT(order_id) AS count FROM valid GROUP BY status",
        "set_union": f"WITH {STREAM} {ENRICHED_SELECT.format(extra='t AS order_timestamp, d AS order_date_parsed,')}",
        # ---- data quality
        "dq_nulls": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(0 * COUNT(*) + {e if c != 'status' else 0} AS BIGINT) AS null_count FROM orders"
            for c, e in RAW_ORDERS_EMPTY.items()
        ),
        "dq_dupkeys": """SELECT l_orderkey * 10 + l_linenumber AS item_id, COUNT(*) AS count
            FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1""",
        "dq_range": f"WITH {ORD} SELECT MIN(order_date) AS earliest, MAX(order_date) AS latest FROM ord",
        "dq_score": f"""WITH {CUS} SELECT customer_id, 25.0::DOUBLE * (1
            + CASE WHEN c_nationkey = 11 THEN 0 ELSE 1 END + CASE WHEN c_nationkey = 6 THEN 0 ELSE 1 END + CASE WHEN c_nationkey = 7 THEN 0 ELSE 1 END)
            AS data_quality_score FROM cus_all""",
        "dq_iqr": f"""WITH {ITM}, r AS (SELECT raw_total, ROW_NUMBER() OVER (ORDER BY raw_total) AS rn,
              COUNT(*) OVER () AS n FROM itm_raw),
            q AS (SELECT {_quantile('0.25', 'raw_total')} AS q1, {_quantile('0.75', 'raw_total')} AS q3 FROM r)
            SELECT item_id, product_id, {eur('raw_total')} AS line_total,
              raw_total < 2 * q1 - q3 OR raw_total > 2 * q3 - q1 AS line_total_is_outlier FROM itm_raw, q""",
        "dq_iqr_approx": f"""WITH {ITM}, p AS (SELECT unnest([0.25, 0.75]::DOUBLE[]) AS probability)
            SELECT probability, COUNT(raw_total) AS n, TRUE AS within_error FROM itm_raw, p GROUP BY probability""",
        "dq_report": f"""WITH {ITM}, line AS ({table_line('order_items', RAW_ITEMS_EMPTY, 'itm_raw', 'item_id')}),
            cols AS ({' UNION ALL '.join(
                f"SELECT '{c}' AS column_name, CAST({e} AS BIGINT) AS null_count, {pct(e, 'COUNT(*)')} AS null_percent FROM itm_raw"
                for c, e in RAW_ITEMS_EMPTY.items())})
            SELECT * FROM line, cols""",
        "dq_summary": f"WITH {ORD}, {CUS}, {ITM}, {PRD} {SUMMARY}",
        "dq_dash": f"""WITH {ORD}, {CUS}, {ITM}, {PRD}, summary AS ({SUMMARY}),
            invalid AS (
              SELECT SUM(CASE WHEN is_valid_order = 0 THEN 1 ELSE 0 END) AS bad FROM ord
              UNION ALL SELECT SUM(CASE WHEN dq < 100 THEN 1 ELSE 0 END) FROM cus_all
              UNION ALL SELECT SUM(CASE WHEN NOT calc_ok THEN 1 ELSE 0 END) FROM itm
              UNION ALL SELECT SUM(CASE WHEN coalesce(cost_cents <= price_cents, false) THEN 0 ELSE 1 END) FROM prd)
            SELECT CAST(SUM(total_rows) AS BIGINT) AS total_records,
              CAST((2 * CAST(round(SUM(completeness_score) * 100) AS BIGINT) + 4) // 8 AS DOUBLE) / 100 AS avg_completeness,
              CAST(SUM(duplicate_rows) AS BIGINT) AS total_duplicates,
              (SELECT CAST(SUM(bad) AS BIGINT) FROM invalid) AS total_invalid FROM summary""",
        "dq_impact": None,
        "dq_quarantine": f"""WITH {ORD} SELECT order_id, concat_ws(',',
              CASE WHEN order_id IS NULL THEN 'missing_order_id' END,
              CASE WHEN customer_id IS NULL THEN 'missing_customer_id' END,
              CASE WHEN order_date IS NULL THEN 'bad_order_date' END,
              CASE WHEN coalesce(cents, 0) <= 0 THEN 'bad_total_amount' END,
              CASE WHEN status = 'unknown' THEN 'unknown_status' END) AS reasons FROM ord""",
        # ---- fraud
        "frd_batch": f"WITH {FRAUD} SELECT * EXCLUDE (cents) FROM frd",
        "frd_stream": f"""WITH {LIVE} SELECT order_id, customer_id,
            CASE WHEN value < 1 THEN NULL ELSE event_timestamp END AS order_timestamp,
            {eur('cents')} AS total_amount, fraud_score, status FROM live_scored WHERE fraud_score >= 3""",
        "frd_velocity": f"""WITH {STREAM}, counted AS (
              SELECT order_id, COUNT(*) OVER (PARTITION BY customer_id ORDER BY t
                RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n FROM enriched WHERE t IS NOT NULL)
            SELECT s.order_id, s.customer_id, CASE WHEN value < 1 THEN NULL ELSE event_timestamp END AS order_timestamp,
              {eur('cents')} AS total_amount, fraud_score, n AS orders_in_last_hour, status
            FROM live_scored s LEFT JOIN counted c ON c.order_id = s.order_id WHERE fraud_score >= 3""",
        "frd_live": f"""WITH {LIVE} SELECT order_id, customer_id, event_timestamp, status,
            {eur('cents')} AS total_amount, fraud_score FROM live_scored WHERE fraud_score >= 3""",
        "frd_alert": f"WITH {LIVE} {ALERT_SELECT}",
        # ---- streaming
        "str_enrich": f"""WITH {STREAM} {ENRICHED_SELECT.format(
            extra='t AS order_timestamp, d AS order_date_parsed,')}""",
        "str_window": f"""WITH {STREAM}, w AS (SELECT *, date_trunc('minute', t) AS ws FROM done)
            SELECT ws AS window_start, ws + INTERVAL 1 MINUTE AS window_end, {WINDOW_SELECT}, true AS customers_within_bound FROM w
            WHERE ws + INTERVAL 1 MINUTE <= (SELECT MAX(t) FROM done) - INTERVAL 10 MINUTE GROUP BY ws, status""",
        "str_window_sliding": f"""WITH {STREAM}, w AS (
              SELECT *, time_bucket(INTERVAL 15 MINUTE, t) - k * INTERVAL 15 MINUTE AS ws
              FROM done, (VALUES (0), (1), (2), (3)) AS s(k))
            SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, {WINDOW_SELECT}, true AS customers_within_bound FROM w
            WHERE ws + INTERVAL 1 HOUR <= (SELECT MAX(t) FROM done) - INTERVAL 10 MINUTE GROUP BY ws, status""",
        "str_late": f"""WITH {STREAM}, w AS (SELECT *, date_trunc('hour', t) AS ws FROM done
              WHERE t >= TIMESTAMP '2024-01-16')
            SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, {WINDOW_SELECT}, true AS customers_within_bound FROM w
            WHERE ws + INTERVAL 1 HOUR <= (SELECT MAX(t) FROM done) - INTERVAL 10 MINUTE GROUP BY ws, status""",
        "str_velocity": f"""WITH {STREAM},
            v AS (SELECT customer_id, time_bucket(INTERVAL 5 MINUTE, t) AS tick FROM enriched WHERE t IS NOT NULL),
            ticks AS (SELECT customer_id, tick, COUNT(*) AS n FROM v GROUP BY 1, 2),
            recent AS (SELECT customer_id, tick + INTERVAL 5 MINUTE AS as_of, CAST(SUM(n) OVER (
              PARTITION BY customer_id ORDER BY tick RANGE BETWEEN INTERVAL 55 MINUTE PRECEDING AND CURRENT ROW)
              AS BIGINT) AS orders_in_window FROM ticks)
            SELECT * FROM recent WHERE orders_in_window >= 1
              AND as_of <= (SELECT MAX(t) FROM enriched) - INTERVAL 10 MINUTE""",
        "str_layers": f"""WITH {STREAM} SELECT 'bronze' AS layer, COUNT(*) AS rows FROM live
            UNION ALL SELECT 'silver', COUNT(*) FROM enriched WHERE order_year IS NOT NULL
            UNION ALL SELECT 'invalid_dates', COUNT(*) FROM enriched WHERE order_year IS NULL
            UNION ALL SELECT 'fraud_alerts', COUNT(*) FROM live_scored WHERE fraud_score >= 3
            UNION ALL SELECT 'revenue_closed', COUNT(DISTINCT date_trunc('minute', t)) FROM done
              WHERE date_trunc('minute', t) + INTERVAL 1 MINUTE <= (SELECT MAX(t) FROM done) - INTERVAL 10 MINUTE
            UNION ALL SELECT 'revenue_open', COUNT(DISTINCT date_trunc('minute', t)) FROM done
              WHERE date_trunc('minute', t) + INTERVAL 1 MINUTE > (SELECT MAX(t) FROM done) - INTERVAL 10 MINUTE
            UNION ALL SELECT 'revenue_late', COUNT(*) FROM enriched WHERE status = 'completed' AND t IS NULL
            UNION ALL SELECT 'velocity_told', COUNT(*) FROM enriched
              WHERE date_trunc('second', t) <= (SELECT date_trunc('second', MAX(t)) FROM enriched) - INTERVAL 10 MINUTE
            UNION ALL SELECT 'velocity_waiting', COUNT(*) FROM enriched
              WHERE date_trunc('second', t) > (SELECT date_trunc('second', MAX(t)) FROM enriched) - INTERVAL 10 MINUTE
            UNION ALL SELECT 'velocity_late', COUNT(*) FROM enriched WHERE t IS NULL
            UNION ALL SELECT 'customer_velocity', COUNT(DISTINCT (customer_id, time_bucket(INTERVAL 5 MINUTE, t)))
              FROM enriched WHERE time_bucket(INTERVAL 5 MINUTE, t) + INTERVAL 5 MINUTE
                <= (SELECT MAX(t) FROM enriched) - INTERVAL 10 MINUTE""",
        "str_window_late": f"""{LATE_WINDOWS} SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, {WINDOW_SELECT},
              ws + INTERVAL 1 HOUR <= (SELECT MAX(t) FROM done) - INTERVAL 10 MINUTE AS is_closed,
              true AS customers_within_bound
            FROM judged WHERE NOT late GROUP BY ws, status""",
        "str_late_rows": f"""{LATE_WINDOWS} SELECT order_id, customer_id, t AS order_timestamp,
              CASE WHEN t IS NOT NULL THEN ws + INTERVAL 1 HOUR END AS window_end, {eur('cents')} AS total_amount,
              CASE WHEN t IS NULL THEN 'no_time' ELSE 'too_late' END AS late_reason FROM judged WHERE late""",
        "str_reconciled": f"""WITH {STREAM} SELECT date_trunc('hour', t) AS window_start, COUNT(*) AS orders,
              {eur('SUM(cents)')} AS revenue FROM enriched WHERE status = 'completed' GROUP BY 1""",
        "str_window_rollup": f"""WITH {STREAM} SELECT date_trunc('hour', t) AS window_start,
            date_trunc('hour', t) + INTERVAL 1 HOUR AS window_end, {WINDOW_SELECT}, true AS customers_within_bound
            FROM done GROUP BY 1, 2, status""",
        "str_velocity_orders": f"""WITH {STREAM}, {arrivals(7, '0', 'true')},
            judged AS (SELECT a.*, date_trunc('second', t) AS sec,
                t IS NULL OR coalesce(date_trunc('second', t) <= date_trunc('second', mark), false) AS late
              FROM a JOIN marks USING (arrival)),
            counted AS (SELECT *, COUNT(*) OVER (PARTITION BY customer_id ORDER BY sec
              RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n,
              sec <= (SELECT date_trunc('second', MAX(t)) FROM a) - INTERVAL 10 MINUTE AS told FROM judged WHERE NOT late)
            SELECT order_id, customer_id, t AS order_timestamp, {eur('cents')} AS total_amount, status,
              CASE WHEN told THEN n END AS orders_in_last_hour, CASE WHEN told THEN 'told' ELSE 'waits' END AS fate FROM counted
            UNION ALL SELECT order_id, customer_id, t, {eur('cents')}, status, NULL,
              CASE WHEN t IS NULL THEN 'no_time' ELSE 'too_late' END FROM judged WHERE late""",
        "str_fraud_velocity": f"""WITH {STREAM}, counted AS (SELECT e.*, s.fraud_score, date_trunc('second', t) AS sec,
              COUNT(*) OVER (PARTITION BY e.customer_id ORDER BY date_trunc('second', t)
                RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n
              FROM enriched e JOIN live_scored s ON s.order_id = e.order_id WHERE t IS NOT NULL)
            SELECT order_id, customer_id, t AS order_timestamp, {eur('cents')} AS total_amount, status, fraud_score,
              n AS orders_in_last_hour FROM counted WHERE fraud_score >= 3
              AND sec <= (SELECT MAX(sec) FROM counted) - INTERVAL 10 MINUTE""",
        "str_kafka_log": f"""WITH {MSG}, {BROKEN}, {OFFSET_GAPS},
            rows AS (SELECT topic, partition, CASE WHEN decode_error IS NULL THEN 1 ELSE 0 END AS e, 0 AS g, 0 AS m FROM broken
              UNION ALL SELECT topic, partition, NULL, 1, missing FROM gaps)
            SELECT topic, partition, CAST(SUM(e) AS BIGINT) AS events, COUNT(CASE WHEN e = 0 THEN 1 END) AS undecodable,
              CAST(SUM(g) AS BIGINT) AS gaps, CAST(SUM(m) AS BIGINT) AS missing FROM rows GROUP BY topic, partition""",
        "src_kafka_quarantine": f"""WITH {MSG}, {BROKEN} SELECT topic, partition, "offset", timestamp, key, value, decode_error
            FROM broken WHERE decode_error IS NOT NULL""",
        "src_kafka_gaps": f"WITH {MSG}, {OFFSET_GAPS} SELECT * FROM gaps",
        "src_csv_malformed": """SELECT l_orderkey * 10 + l_linenumber AS item_id,
            CASE WHEN l_linenumber IN (6, 7) THEN 'malformed' ELSE 'loaded' END AS fate FROM lineitem""",
        "src_json_malformed": """SELECT c_custkey AS customer_id,
            CASE WHEN c_nationkey IN (13, 14) THEN 'malformed' ELSE 'loaded' END AS fate FROM customer""",
        "dq_lines": """SELECT table_name, n AS source_lines, n AS bronze_rows, bad AS malformed_rows, n - bad AS loaded_rows,
              true AS is_complete FROM (
            SELECT 'order_items' AS table_name, COUNT(*) AS n, COUNT(CASE WHEN l_linenumber IN (6, 7) THEN 1 END) AS bad FROM lineitem
            UNION ALL SELECT 'customers', COUNT(*), COUNT(CASE WHEN c_nationkey IN (13, 14) THEN 1 END) FROM customer)""",
        # ---- message log
        "log_topic_stats": f"WITH {MSG} SELECT * FROM stats",
        "log_topic_totals": f"""WITH {MSG} SELECT topic, COUNT(*) AS partition_count,
            CAST(SUM(messages) AS BIGINT) AS total_messages,
            CASE WHEN SUM(messages) > 0 THEN 'Active' ELSE 'Empty' END AS status FROM stats GROUP BY topic""",
        "log_rate": f"""WITH {MSG}, h AS (SELECT topic, date_trunc('hour', timestamp) + INTERVAL 1 HOUR AS snapshot_time,
              COUNT(*) AS n FROM msg GROUP BY 1, 2),
            s AS (SELECT topic, snapshot_time, CAST(SUM(n) OVER (PARTITION BY topic ORDER BY snapshot_time) AS BIGINT)
              AS total_messages FROM h),
            f AS (SELECT *, total_messages - FIRST_VALUE(total_messages) OVER w AS gained,
                epoch(snapshot_time) - epoch(FIRST_VALUE(snapshot_time) OVER w) AS elapsed FROM s
              WINDOW w AS (PARTITION BY topic ORDER BY snapshot_time ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
            SELECT topic, snapshot_time, total_messages,
              CASE WHEN elapsed > 0 THEN round(gained * 60 / elapsed, 4) ELSE 0 END AS messages_per_minute FROM f""",
        "log_lag": f"""WITH {MSG}, committed AS (
              SELECT event_type AS topic, user_id % 3 AS partition, MAX(event_id) + 1 AS c FROM events
              WHERE ts < TIMESTAMP '2024-01-16' AND event_type <> 'signup' GROUP BY 1, 2)
            SELECT 'billing' AS group_id, s.topic, s.partition, latest_offset, coalesce(c, 0) AS committed_offset,
              latest_offset + 1 - coalesce(c, 0) AS lag
            FROM stats s LEFT JOIN committed k ON k.topic = s.topic AND k.partition = s.partition
            WHERE s.topic IN (SELECT topic FROM committed)""",
        "log_read_from": f"""WITH {MSG}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY topic, partition ORDER BY "offset") AS rn
              FROM msg WHERE "offset" >= 500)
            SELECT topic, partition, "offset", key, timestamp, {JSON_VALUE} AS value FROM r WHERE rn <= 100""",
        "log_latest": f"""WITH {MSG}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY topic
              ORDER BY timestamp DESC, "offset" DESC) AS rn FROM msg)
            SELECT topic, partition, "offset", key, timestamp, {JSON_VALUE} AS value FROM r WHERE rn <= 5""",
        "log_flatten": f"""WITH {MSG} SELECT event_id AS order_id, user_id AS customer_id, value AS total_amount,
            CAST(json_extract_string(props, '$.k') AS INTEGER) AS quantity, timestamp AS _kafka_timestamp,
            "offset" AS _kafka_offset, partition AS _kafka_partition FROM msg""",
        "log_retain": f"""WITH {MSG} SELECT topic, partition, "offset", key, timestamp, {JSON_VALUE} AS value FROM msg
            WHERE timestamp >= TIMESTAMP '2024-01-30 23:00:00' - INTERVAL 336 HOUR""",
    }
    sql["agg_segment_order"] = sql["agg_segment"]
    sql["agg_gold_refresh"], sql["snk_fact_refresh"] = sql["agg_gold"], sql["snk_fact"]
    sql["log_retain_days"] = sql["log_retain"]
    sql["log_read_from_far"] = sql["log_read_from"].replace("rn <= 100", "rn <= 1001")
    sql["log_latest_far"] = sql["log_latest"].replace("rn <= 5", "rn <= 1001")
    sql["flt_review"] = f"WITH {LIVE}, a AS ({ALERT_SELECT}) SELECT * FROM a WHERE requires_review"
    flagged = sql["enr_orders_raw"].replace("SELECT order_id, status,", "SELECT o_orderkey, order_id, status,")
    sql["join_fact_raw"] = f"""WITH o AS ({flagged}), {ORD}, {ITM},
        head AS (
          SELECT o.order_id, d.customer_id, b.order_date, b.status, o.order_year, o.order_month, o.is_completed,
            d2.total_amount
          FROM o JOIN ord d ON d.o_orderkey = o.o_orderkey
          JOIN ({_raw_texts()}) b ON b.o_orderkey = o.o_orderkey
          JOIN ({_raw_amounts()}) d2 ON d2.o_orderkey = o.o_orderkey),
        people AS ({_raw_people()}),
        goods AS ({_raw_goods()})
        SELECT h.order_id, h.customer_id, p.name AS customer_name, p.segment AS customer_segment,
          h.order_date, h.order_year, h.order_month, h.status, h.total_amount, i.product_id,
          g.product_name, g.category AS product_category, CAST(i.raw_quantity AS INTEGER) AS quantity, h.is_completed
        FROM head h LEFT JOIN people p ON p.customer_id = h.customer_id
        LEFT JOIN itm_raw i ON i.order_id = h.order_id
        LEFT JOIN goods g ON g.product_id = i.product_id"""
    sql["dq_impact"] = _impact()
    return {name: text for name, text in sql.items() if text}


def _raw_texts() -> str:
    """Raw order date and status texts."""
    return """SELECT o_orderkey,
        CASE WHEN o_totalprice >= 12000 AND o_totalprice < 13000 THEN NULL ELSE o_orderkey END AS order_id,
        CASE WHEN day(o_orderdate) = 31 THEN '2024-13-45'
          WHEN o_totalprice >= 6000 AND o_totalprice < 8000 THEN NULL
          ELSE CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
                WHEN '2-HIGH' THEN strftime(o_orderdate, '%m/%d/%Y')
                WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%d-%m-%Y')
                WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y%m%d')
                ELSE strftime(o_orderdate, '%B %d, %Y') END END AS order_date,
        CASE WHEN o_totalprice >= 8000 AND o_totalprice < 9000 THEN ''
          WHEN o_orderstatus = 'F' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'completed'
            WHEN '2-HIGH' THEN 'Completed' WHEN '3-MEDIUM' THEN 'COMPLETED'
            WHEN '4-NOT SPECIFIED' THEN 'complete' ELSE '  Complete ' END
          WHEN o_orderstatus = 'P' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'cancelled'
            WHEN '2-HIGH' THEN 'Canceled' WHEN '3-MEDIUM' THEN 'CANCELLED'
            WHEN '4-NOT SPECIFIED' THEN 'canceled' ELSE 'unknwon' END
          ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'Processing' WHEN '2-HIGH' THEN 'Delivered'
            WHEN '3-MEDIUM' THEN 'returned' WHEN '4-NOT SPECIFIED' THEN 'ERROR' ELSE ' On Hold' END
          END AS status FROM orders"""


def _raw_amounts() -> str:
    return f"""SELECT o_orderkey, CASE WHEN o_totalprice >= 497500 THEN {eur(f'10 * {CENTS}')}
        WHEN o_totalprice >= 9000 AND o_totalprice < 11000 THEN -{eur(CENTS)}
        WHEN o_totalprice >= 11000 AND o_totalprice < 12000 THEN 0
        ELSE {eur(CENTS)} END AS total_amount FROM orders"""


def _raw_people() -> str:
    return """SELECT CASE WHEN c_nationkey <> 11 THEN c_custkey END AS customer_id,
        CASE WHEN c_nationkey = 0 THEN 'Test User' WHEN c_nationkey = 1 THEN ' '
          WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Mr. ' || c_name
          WHEN c_mktsegment = 'BUILDING' THEN '  Ann   ' || c_name || ' '
          WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Dr.' || c_name ELSE c_name END AS name,
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'VIP' WHEN 'BUILDING' THEN 'standard'
          WHEN 'FURNITURE' THEN ' New ' WHEN 'HOUSEHOLD' THEN 'Churned ' ELSE 'TBD' END AS segment
        FROM customer"""


def _raw_goods() -> str:
    return """SELECT CASE WHEN p_size <> 11 THEN p_partkey END AS product_id,
        CASE p_size WHEN 1 THEN 'N/A' WHEN 2 THEN '' WHEN 3 THEN '  ' || p_name || ' ' ELSE p_name END AS product_name,
        CASE WHEN p_size = 50 THEN ' Toys ' WHEN p_type = 'STANDARD' THEN 'ELECTRONICS'
          WHEN p_type = 'MEDIUM' THEN 'Electronic' WHEN p_type = 'ECONOMY' THEN 'HOME_KITCHEN'
          WHEN p_type = 'PROMO' THEN 'sports' WHEN p_type = 'SMALL' THEN 'Book & Media' ELSE 'TBD' END AS category
        FROM part"""


def _impact() -> str:
    """Counts before and after cleaning; the raw side is read off the supplied columns."""
    def line(metric: str, before: str, after: str, source: str) -> str:
        return f"""SELECT '{metric}' AS metric, {before} AS b, {after} AS a FROM {source}"""

    iso = """o_orderpriority = '1-URGENT' AND day(o_orderdate) <> 31
        AND NOT (o_totalprice >= 6000 AND o_totalprice < 8000)"""
    lines = [
        line("Total Orders", "COUNT(*)", "COUNT(*)", "ord"),
        line(
            "Valid Orders",
            f"""COUNT(CASE WHEN {iso} AND o_totalprice >= 6000
                AND NOT (o_totalprice >= 9000 AND o_totalprice < 12000) THEN 1 END)""",
            "(SELECT COUNT(*) FROM valid)",
            "orders",
        ),
        line(
            "Consistent Date Formats",
            f"COUNT(CASE WHEN {iso} THEN 1 END)",
            "(SELECT COUNT(order_date) FROM ord)",
            "orders",
        ),
        line("Complete Customer Records", "COUNT(*)", "COUNT(CASE WHEN dq = 100 THEN 1 END)", "cus_all"),
        line(
            "Valid Email Addresses",
            "COUNT(CASE WHEN c_nationkey NOT IN (2, 3, 4, 6) THEN 1 END)",
            "COUNT(email)",
            "cus_all",
        ),
        line(
            "Price Calculation Errors",
            "COUNT(CASE WHEN NOT calc_ok THEN 1 END)",
            "COUNT(CASE WHEN total_e4 IS NULL THEN 1 END)",
            "itm",
        ),
    ]
    signed = f"""CASE WHEN a >= b THEN {pct('a - b', 'b')} ELSE -{pct('b - a', 'b')} END"""
    return f"""WITH {ORD}, {CUS}, {ITM}, lines AS ({' UNION ALL '.join(lines)})
        SELECT metric, b AS before_cleaning, a AS after_cleaning, {signed} AS improvement_percent FROM lines"""
