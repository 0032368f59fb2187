"""The same results in plain SQL over the test tables.

The SQL never goes through JSON or through this package: every fault of the derived inputs sits on a residue of the
event id, so each result is written down from the flat columns.
"""

from __future__ import annotations

EVENTS = """
ev AS (
  SELECT event_id AS n, ts, user_id, event_type AS action, value AS v,
         CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k,
         'STR' || lpad(CAST(user_id % 5 + 1 AS VARCHAR), 4, '0') AS store_id,
         CASE WHEN event_id % 83 <> 0 THEN ts END AS event_ts
  FROM events),
cp AS (SELECT *, 0 AS copy FROM ev UNION ALL SELECT *, 1 AS copy FROM ev WHERE n % 10 = 0),
marked AS (
  SELECT *, n + copy * 1000000 AS off, CAST(event_ts AS DATE) AS event_date, CAST(hour(event_ts) AS INTEGER) AS event_hour,
         copy = CASE WHEN n % 10 = 0 THEN 1 ELSE 0 END AS latest,
         ts + INTERVAL 1 SECOND * (30 + n % 7 * 5 + copy * 60) AS ingested
  FROM cp)
"""

POS = EVENTS + """,
pos AS (
  SELECT *, 'POS-' || n AS event_id,
         CASE action WHEN 'signup' THEN 'refund' WHEN 'error' THEN 'void' ELSE 'sale' END AS event_type,
         'TRM-' || lpad(CAST(n % 20 + 1 AS VARCHAR), 3, '0') AS terminal_id,
         'EMP-' || (user_id + 1000) AS cashier_id,
         CASE WHEN n % 97 <> 0 THEN 'TXN-' || n END AS transaction_id,
         v AS subtotal,
         CASE WHEN n % 4 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS discount_total,
         (n % 7) * CAST(0.25 AS DOUBLE) AS tax_amount,
         CASE WHEN n % 53 = 0 THEN NULL WHEN n % 59 = 0 THEN 0 - v
              ELSE round(v - (CASE WHEN n % 4 = 0 THEN 1 ELSE 0 END) + (n % 7) * CAST(0.25 AS DOUBLE) + copy, 2) END AS total_amount,
         CASE WHEN n % 101 = 0 THEN 'bitcoin'
              ELSE ['cash', 'credit_card', 'debit_card', 'mobile_pay', 'gift_card', 'store_credit'][CAST(n % 6 AS INTEGER) + 1] END AS payment_method,
         CAST(CASE WHEN n % 103 = 0 OR n % 89 = 0 THEN 0 WHEN n % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS item_count
  FROM marked),
pos_silver AS (
  SELECT *, total_amount IS NOT NULL AND total_amount >= 0 AS _is_valid FROM pos WHERE latest AND transaction_id IS NOT NULL),
lines AS (
  SELECT *, ['electronics', 'apparel', 'grocery', 'home', 'beauty', 'sports', 'toys', 'automotive'][ik % 8 + 1] AS category,
         'SKU-' || ik AS sku, 'Product ' || ik AS product_name,
         round(v * q + CASE WHEN n % 61 = 0 THEN 1 ELSE 0 END, 2) AS line_total
  FROM (SELECT *, 0 AS line_no, k AS ik, CAST(n % 3 + 1 AS INTEGER) AS q FROM pos_silver WHERE item_count >= 1
        UNION ALL
        SELECT *, 1 AS line_no, (k + 1) % 100 AS ik, 1 AS q FROM pos_silver WHERE item_count = 2))
"""

INVENTORY = EVENTS + """,
inv AS (
  SELECT *, 'INV-' || n AS event_id,
         CASE WHEN n % 73 = 0 THEN 'recount'
              ELSE ['restock', 'sale_deduction', 'adjustment', 'transfer_in', 'transfer_out', 'damage', 'return',
                    'cycle_count'][CAST(n % 8 AS INTEGER) + 1] END AS event_type,
         'SKU-' || k AS sku, CAST(n % 41 - 20 AS INTEGER) AS quantity_delta,
         CAST(CASE WHEN n % 67 = 0 THEN -3 WHEN n % 13 = 0 THEN 0 ELSE floor(v) END AS INTEGER) AS quantity_on_hand,
         CAST(CASE WHEN n % 31 <> 0 THEN user_id % 41 + 10 END AS INTEGER) AS reorder_point,
         CASE WHEN n % 8 = 0 THEN 'SUP-' || (n % 9) END AS supplier_id,
         CASE WHEN n % 8 = 0 THEN 'PO-' || n END AS po_number,
         'A' || lpad(CAST(k % 20 + 1 AS VARCHAR), 2, '0') AS location
  FROM marked),
snap AS (
  SELECT *, quantity_on_hand <= reorder_point AS below_reorder
  FROM (SELECT *, row_number() OVER (PARTITION BY store_id, sku ORDER BY event_ts DESC NULLS LAST, event_id DESC) AS rn
        FROM inv WHERE latest)
  WHERE rn = 1),
alerts AS (
  SELECT *, CASE WHEN quantity_on_hand = 0 THEN 'CRITICAL' WHEN quantity_on_hand < reorder_point * 0.25 THEN 'HIGH'
                 ELSE 'MEDIUM' END AS urgency
  FROM snap WHERE below_reorder)
"""

ECOMMERCE = EVENTS + """,
eco AS (
  SELECT *, 'ECO-' || n AS event_id,
         CASE action WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' WHEN 'signup' THEN 'checkout_start'
                     WHEN 'purchase' THEN 'order_placed' ELSE 'search' END AS event_type,
         'S-' || user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
         CASE WHEN n % 71 <> 0 THEN 'C-' || user_id END AS customer_id,
         CASE WHEN n % 79 = 0 THEN 'kiosk' ELSE ['web', 'mobile_app', 'tablet'][CAST(user_id % 3 AS INTEGER) + 1] END AS channel
  FROM marked)
"""

# the value of every message: null, an array, cut off, or no UTF-8 on these residues
FAULTY = "(n % 37 = 0 OR n % 41 = 0 OR n % 43 = 0 OR n % 47 = 0)"

ORDERS = """
ord AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS event_date, 'STR' || lpad(CAST(o_custkey % 50 + 1 AS VARCHAR), 4, '0') AS store_id,
         o_custkey % 400 AS cashier, o_orderkey % 6 AS method, o_totalprice AS total
  FROM orders WHERE o_orderstatus <> 'P')
"""


def money(amount: str) -> str:
    return f"CAST(SUM(CAST(round({amount} * 10000) AS BIGINT)) AS DOUBLE) / 10000"


def codes(*pairs: tuple[str, str], sep: str = ";") -> str:
    """The texts whose condition holds, joined; empty text when none does."""
    cases = ", ".join(f"CASE WHEN {condition} THEN '{text}' END" for text, condition in pairs)
    return f"concat_ws('{sep}', {cases})"


POS_CODES = [
    ("missing:transaction_id", "n % 97 = 0"),
    ("type:items", "n % 103 = 0"),
    ("min_items:items", "n % 89 = 0 AND n % 103 <> 0"),
    ("missing:totals.total", "n % 53 = 0"),
]
POS_RULES = [
    ("total_amount_positive", "coalesce(total_amount, 0) < 0"),
    ("has_items", "item_count = 0"),
    ("valid_payment_method", "n % 101 = 0"),
]
INVENTORY_CODES = [("enum:event_type", "n % 73 = 0"), ("minimum:quantity_on_hand", "n % 67 = 0")]
INVENTORY_RULES = [("quantity_on_hand_nonneg", "n % 67 = 0"), ("valid_event_type", "n % 73 = 0")]
ECOMMERCE_CODES = [("missing:customer_id", "n % 71 = 0"), ("enum:channel", "n % 79 = 0")]


def tagged(tag: str, pairs: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return [(f"{tag}: {text}", condition) for text, condition in pairs]


POS_ERRORS = tagged("schema", POS_CODES) + tagged("business_rule", POS_RULES)
INVENTORY_ERRORS = tagged("schema", INVENTORY_CODES) + tagged("business_rule", INVENTORY_RULES)
ECOMMERCE_ERRORS = tagged("schema", ECOMMERCE_CODES)


def either(pairs: list[tuple[str, str]]) -> str:
    return " OR ".join(f"({condition})" for _, condition in pairs)


def report_row(name: str, table: str, bad: str) -> str:
    return f"""SELECT '{name}' AS source, COUNT(*) AS total_records, COUNT(*) FILTER (WHERE NOT ({bad})) AS valid_count,
       COUNT(*) FILTER (WHERE {bad}) AS invalid_count,
       CAST(COUNT(*) FILTER (WHERE NOT ({bad})) AS DOUBLE) / COUNT(*) * 100 AS pass_rate FROM {table}"""


REPORTS = f"""WITH {POS}, {INVENTORY.replace(EVENTS + ",", "")}, {ECOMMERCE.replace(EVENTS + ",", "")},
reports AS (
{report_row('pos', 'pos', either(POS_ERRORS))} UNION ALL
{report_row('inventory', 'inv', either(INVENTORY_ERRORS))} UNION ALL
{report_row('ecommerce', 'eco', either(ECOMMERCE_ERRORS))} UNION ALL
{report_row('silver_pos', 'pos_silver', 'event_ts IS NULL OR NOT _is_valid')}),
judged AS (SELECT *, pass_rate >= 95 AS passed FROM reports)
"""

HOURLY = f"""hours AS (
  SELECT event_date, event_hour, store_id, COUNT(transaction_id) AS transaction_count, {money('total_amount')} AS hourly_revenue,
         {money('total_amount')} / nullif(COUNT(total_amount), 0) AS avg_basket_size
  FROM pos_silver WHERE event_type = 'sale' GROUP BY ALL),
trend AS (
  SELECT *, lag(hourly_revenue) OVER (PARTITION BY event_date, store_id ORDER BY event_hour) AS prev_hour_revenue FROM hours),
changes AS (
  SELECT *, CASE WHEN prev_hour_revenue > 0 THEN (hourly_revenue - prev_hour_revenue) / prev_hour_revenue * 100 END AS revenue_change_pct
  FROM trend)"""

TOPICS = {"pos": "retail.pos.events", "inventory": "retail.inventory.events", "ecommerce": "retail.ecommerce.events"}
WIDTHS = {"pos": 12, "inventory": 6, "ecommerce": 8}


def contract(source: str, base: str, table: str, pairs: list[tuple[str, str]]) -> str:
    return f"""WITH {base} SELECT '{TOPICS[source]}' AS topic, off AS "offset",
        CASE WHEN {FAULTY} THEN 'type:$' ELSE {codes(*pairs)} END AS violations FROM {table}"""


def per_topic(select: str) -> str:
    return " UNION ALL ".join(select.format(topic=TOPICS[s], width=WIDTHS[s], source=s) for s in TOPICS)


DROPS = EVENTS + """,
drops AS (
  SELECT 'd' || (n % 8) AS file, 'SKU-' || k AS sku, store_id,
         CASE WHEN NOT ((n % 8 = 3 AND n % 5 <> 0) OR n % 40 = 5 OR n % 16 = 6)
              THEN CAST(CAST(CASE WHEN n % 67 = 0 THEN -3 WHEN n % 13 = 0 THEN 0 ELSE floor(v) END AS INTEGER) AS VARCHAR) END AS quantity_on_hand
  FROM ev WHERE n % 8 < 7),
counted AS (
  SELECT file, COUNT(sku) AS total_records, COUNT(quantity_on_hand) AS valid_count
  FROM (SELECT DISTINCT 'd' || (n % 10) AS file FROM ev) LEFT JOIN drops USING (file) GROUP BY file),
rated AS (
  SELECT *, CASE WHEN total_records > 0 THEN CAST(valid_count AS DOUBLE) / total_records * 100 ELSE CAST(0 AS DOUBLE) END AS pass_rate FROM counted),
verdicts AS (
  SELECT file, total_records, valid_count, total_records - valid_count AS invalid_count, pass_rate,
         CASE WHEN total_records = 0 THEN 'skip' WHEN pass_rate < 80 THEN 'reject' ELSE 'accept' END AS verdict,
         CASE WHEN total_records = 0 THEN 'empty_or_missing'
              WHEN pass_rate < 80 THEN 'low_pass_rate_' || CAST(round_even(pass_rate, 0) AS INTEGER) || 'pct' END AS reason
  FROM rated)
"""

PRODUCTS = """
prod AS (
  SELECT p_partkey AS p, 'SKU-' || p_partkey AS sku, CAST(floor(p_partkey / 100) + 1 AS INTEGER) AS page,
         CASE WHEN p_partkey % 37 = 0 THEN CAST(-1 AS DOUBLE) ELSE round(p_retailprice, 2) END AS unit_price,
         round(p_retailprice + 1, 2) AS new_price, p_partkey % 20 <> 0 AS active,
         DATE '2024-01-01' + CAST(p_partkey % 60 AS INTEGER) AS changed
  FROM part)
"""


def nullable_json(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN 'null' ELSE '\"' || {column} || '\"' END"


# second copies of every twentieth event are of a time three days earlier
LATE = POS + """,
late AS (SELECT *, CASE WHEN copy = 1 AND n % 20 = 0 THEN event_ts - INTERVAL 3 DAY ELSE event_ts END AS moved FROM pos)
"""

ALL = f"{POS}, {INVENTORY.replace(EVENTS + ',', '')}, {ECOMMERCE.replace(EVENTS + ',', '')}"

WAITS = f"""waits AS (SELECT CAST(30 + n % 7 * 5 + copy * 60 AS DOUBLE) AS s FROM marked WHERE event_ts IS NOT NULL),
points AS (SELECT unnest({list(TOPICS.values())}) AS _kafka_topic, COUNT(*) AS measured, quantile_disc(s, 0.5) AS p50, quantile_disc(s, 0.95) AS p95,
           quantile_disc(s, 0.99) AS p99 FROM waits)"""

ORACLE: dict[str, str] = {
    "bronze_metadata": f"WITH {POS} SELECT event_id, off AS _kafka_offset, 'pos' AS _source_name, event_date, event_hour FROM pos",
    "bronze_required_valid": f"""WITH {POS} SELECT event_id, off AS _kafka_offset, store_id, transaction_id FROM pos
        WHERE transaction_id IS NOT NULL""",
    "bronze_required_invalid": f"""WITH {POS}, {ECOMMERCE.replace(EVENTS + ",", "")}
        SELECT 'pos' AS _source_name, event_id, off AS _kafka_offset, 'missing_required_field' AS _validation_error,
               'transaction_id' AS _missing_fields FROM pos WHERE transaction_id IS NULL
        UNION ALL SELECT 'ecommerce', event_id, off, 'missing_required_field', 'customer_id' FROM eco WHERE customer_id IS NULL""",
    "record_fingerprint": f"""WITH {ECOMMERCE} SELECT event_id, off AS _kafka_offset, md5(
        '{{"event_id":"' || event_id || '","event_type":"' || event_type || '","session_id":"' || session_id
        || '","customer_id":' || {nullable_json('customer_id')} || ',"timestamp":"'
        || CASE WHEN n % 83 = 0 THEN 'not-a-time' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END
        || '","channel":"' || channel || '","sku":"SKU-' || k
        || '","product_name":null,"category":null,"price":null,"quantity":null,"order":null,"search_query":'
        || CASE WHEN action = 'error' THEN '"product ' || k || '"' ELSE 'null' END
        || ',"device_type":null,"metadata":null}}') AS record_hash FROM eco""",
    "silver_pos_clean": f"""WITH {POS} SELECT event_id, off AS _kafka_offset, event_type, store_id, terminal_id, cashier_id, event_ts,
        transaction_id, subtotal, discount_total, tax_amount, total_amount, payment_method, item_count, event_date, event_hour,
        total_amount IS NOT NULL AND total_amount >= 0 AS _is_valid FROM pos WHERE transaction_id IS NOT NULL""",
    "silver_inventory_clean": f"""WITH {INVENTORY} SELECT event_id, off AS _kafka_offset, event_type, store_id, sku, event_ts,
        quantity_delta, quantity_on_hand, reorder_point, quantity_on_hand <= reorder_point AS below_reorder, supplier_id,
        po_number, location, event_date FROM inv""",
    "dedup_latest": f"WITH {POS} SELECT event_id, total_amount FROM pos_silver",
    "schema_enforce": f"""WITH {POS} SELECT event_id, {codes(('null:event_ts', 'event_ts IS NULL'),
        ('null:total_amount', 'total_amount IS NULL'), ('null:event_date', 'event_ts IS NULL'), sep=',')} AS _validation_error
        FROM pos_silver WHERE event_ts IS NULL OR total_amount IS NULL""",
    "daily_sales_by_store": f"""WITH {POS} SELECT event_date, store_id, COUNT(transaction_id) AS transaction_count,
        {money('total_amount')} AS gross_revenue, {money('discount_total')} AS total_discounts, {money('tax_amount')} AS total_tax,
        {money('total_amount')} / COUNT(total_amount) AS avg_transaction_value, MAX(total_amount) AS max_transaction_value,
        CAST(SUM(item_count) AS BIGINT) AS total_items_sold, COUNT(DISTINCT cashier_id) AS unique_cashiers,
        COUNT(DISTINCT payment_method) AS payment_methods_used, {money('total_amount')} - {money('discount_total')} AS net_revenue
        FROM pos_silver WHERE event_type = 'sale' AND _is_valid GROUP BY event_date, store_id""",
    "hourly_sales_trend": f"WITH {POS}, {HOURLY} SELECT * FROM changes",
    "hourly_spikes": f"""WITH {POS}, {HOURLY} SELECT event_date, event_hour, store_id, hourly_revenue, revenue_change_pct,
        CASE WHEN revenue_change_pct > 0 THEN 'up' ELSE 'down' END AS direction FROM changes WHERE abs(revenue_change_pct) >= 100""",
    "inventory_snapshot": f"""WITH {INVENTORY} SELECT store_id, sku, quantity_on_hand, reorder_point, below_reorder, location, event_ts,
        CASE WHEN quantity_on_hand > 0 THEN CAST(quantity_on_hand AS DOUBLE) / 10 ELSE CAST(0 AS DOUBLE) END AS days_of_stock_remaining
        FROM snap""",
    "low_stock_alerts": f"WITH {INVENTORY} SELECT store_id, sku, quantity_on_hand, reorder_point, location, urgency FROM alerts",
    "critical_stock": f"WITH {INVENTORY} SELECT store_id, sku, quantity_on_hand FROM alerts WHERE urgency = 'CRITICAL'",
    "line_items": f"""WITH {POS} SELECT event_id, event_date, sku, product_name, category, q AS quantity_sold,
        line_total AS line_revenue FROM lines WHERE event_type = 'sale'""",
    "top_selling_products": f"""WITH {POS}, sums AS (
        SELECT event_date, sku, product_name, category, CAST(SUM(q) AS BIGINT) AS total_units_sold, {money('line_total')} AS total_revenue
        FROM lines WHERE event_type = 'sale' GROUP BY ALL),
        ranked AS (SELECT *, CAST(rank() OVER (PARTITION BY event_date ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank FROM sums)
        SELECT * FROM ranked WHERE revenue_rank <= 20""",
    "ecommerce_funnel": f"""WITH {ECOMMERCE} SELECT event_date, channel, event_type, COUNT(*) AS event_count,
        COUNT(DISTINCT session_id) AS session_count FROM eco WHERE latest AND customer_id IS NOT NULL GROUP BY ALL""",
    "table_freshness": f"""WITH {POS}, {INVENTORY.replace(EVENTS + ",", "")}, {ECOMMERCE.replace(EVENTS + ",", "")},
        newest AS (SELECT 'pos' AS table_name, MAX(event_ts) AS newest_event_ts FROM pos_silver
                   UNION ALL SELECT 'inventory', MAX(event_ts) FROM inv WHERE latest
                   UNION ALL SELECT 'ecommerce', MAX(event_ts) FROM eco WHERE latest AND customer_id IS NOT NULL),
        aged AS (SELECT *, CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') - floor(epoch(newest_event_ts)) AS BIGINT) AS age_seconds FROM newest)
        SELECT *, age_seconds < 300 AS within_target FROM aged""",
    "order_daily_sales": f"""WITH {ORDERS}, counted AS (SELECT l_orderkey, COUNT(*) AS items FROM lineitem GROUP BY l_orderkey)
        SELECT event_date, store_id, COUNT(*) AS transaction_count, {money('total')} AS gross_revenue,
        CAST(0 AS DOUBLE) AS total_discounts, CAST(0 AS DOUBLE) AS total_tax, {money('total')} / COUNT(*) AS avg_transaction_value,
        MAX(total) AS max_transaction_value, CAST(SUM(coalesce(items, 0)) AS BIGINT) AS total_items_sold,
        COUNT(DISTINCT cashier) AS unique_cashiers, COUNT(DISTINCT method) AS payment_methods_used, {money('total')} AS net_revenue
        FROM ord LEFT JOIN counted ON l_orderkey = o_orderkey GROUP BY event_date, store_id""",
    "order_top_products": f"""WITH {ORDERS}, sums AS (
        SELECT event_date, 'SKU-' || l_partkey AS sku, 'Product ' || l_partkey AS product_name,
               ['electronics', 'apparel', 'grocery', 'home', 'beauty', 'sports', 'toys', 'automotive'][CAST(l_partkey % 8 AS INTEGER) + 1] AS category,
               CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_units_sold, {money('l_extendedprice')} AS total_revenue
        FROM ord JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
        ranked AS (SELECT *, CAST(rank() OVER (PARTITION BY event_date ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank FROM sums)
        SELECT * FROM ranked WHERE revenue_rank <= 5""",
    "contract_pos": contract("pos", POS, "pos", POS_CODES),
    "contract_inventory": contract("inventory", INVENTORY, "inv", INVENTORY_CODES),
    "contract_ecommerce": contract("ecommerce", ECOMMERCE, "eco", ECOMMERCE_CODES),
    "contract_sku": f"WITH {PRODUCTS} SELECT sku, page, CASE WHEN p % 37 = 0 THEN 'minimum:unit_price' ELSE '' END AS violations FROM prod",
    "rules_pos": f"WITH {POS} SELECT event_id, off AS _kafka_offset, {codes(*POS_RULES)} AS broken_rules FROM pos",
    "rules_inventory": f"WITH {INVENTORY} SELECT event_id, off AS _kafka_offset, {codes(*INVENTORY_RULES)} AS broken_rules FROM inv",
    "rule_price_consistency": f"""WITH {POS} SELECT event_id, CAST(line_no AS INTEGER) AS line_no, sku, q AS quantity, v AS unit_price,
        line_total FROM lines WHERE n % 61 = 0""",
    "pos_intake_reason": f"""WITH {POS} SELECT event_id, off AS "offset", CASE
        WHEN transaction_id IS NULL THEN 'Missing required fields: [''transaction_id'']'
        WHEN coalesce(total_amount, -1) < 0 THEN 'Negative total amount' ELSE 'OK' END AS reason FROM pos""",
    "validation_report": f"{REPORTS} SELECT * FROM judged",
    "validation_errors": f"""WITH {POS} SELECT event_id, {codes(*POS_ERRORS, sep='; ')} AS errors FROM pos
        WHERE {either(POS_ERRORS)} ORDER BY event_id, errors LIMIT 100""",
    "validation_failures": f"""WITH {ALL} SELECT 'retail.pos.events' AS _kafka_topic, off AS _kafka_offset, event_id, {codes(*POS_ERRORS, sep='; ')} AS errors
        FROM pos WHERE {either(POS_ERRORS)}
        UNION ALL SELECT 'retail.inventory.events', off, event_id, {codes(*INVENTORY_ERRORS, sep='; ')} FROM inv WHERE {either(INVENTORY_ERRORS)}
        UNION ALL SELECT 'retail.ecommerce.events', off, event_id, {codes(*ECOMMERCE_ERRORS, sep='; ')} FROM eco WHERE {either(ECOMMERCE_ERRORS)}""",
    "error_breakdown": f"WITH {ALL} " + " UNION ALL ".join(
        f"SELECT '{text}' AS error, COUNT(*) AS records, '{source}' AS source FROM {table} WHERE {condition} HAVING COUNT(*) > 0"
        for source, table, errors in (("pos", "pos", POS_ERRORS), ("inventory", "inv", INVENTORY_ERRORS), ("ecommerce", "eco", ECOMMERCE_ERRORS))
        for text, condition in errors),
    "quality_gate": f"""{REPORTS} SELECT CAST(COUNT(*) AS INTEGER) AS sources, CAST(COUNT(*) FILTER (WHERE NOT passed) AS INTEGER) AS failed_sources,
        MIN(pass_rate) AS lowest_pass_rate,
        CASE WHEN COUNT(*) FILTER (WHERE NOT passed) > 0 THEN 'quarantine_alert' ELSE 'validation_passed' END AS branch FROM judged""",
    "schema_drift": f"""WITH {ALL}, seen AS (
        SELECT 'pos' AS source, unnest(['event_id', 'event_type', 'store_id', 'terminal_id', 'cashier_id', 'timestamp']) AS field, 'string' AS expected_type,
               'string' AS seen_type FROM pos WHERE NOT {FAULTY}
        UNION ALL SELECT 'pos', unnest(['payment', 'totals']), 'object', 'object' FROM pos WHERE NOT {FAULTY}
        UNION ALL SELECT 'pos', 'transaction_id', 'string', 'string' FROM pos WHERE NOT {FAULTY} AND transaction_id IS NOT NULL
        UNION ALL SELECT 'pos', 'items', 'array', CASE WHEN n % 103 = 0 THEN 'string' ELSE 'array' END FROM pos WHERE NOT {FAULTY}
        UNION ALL SELECT 'inventory', unnest(['event_id', 'event_type', 'store_id', 'sku', 'product_name', 'timestamp', 'location']), 'string', 'string'
                  FROM inv WHERE NOT {FAULTY}
        UNION ALL SELECT 'inventory', unnest(['quantity_delta', 'quantity_on_hand']), 'integer', 'integer' FROM inv WHERE NOT {FAULTY}
        UNION ALL SELECT 'inventory', 'reorder_point', 'integer', 'integer' FROM inv WHERE NOT {FAULTY} AND reorder_point IS NOT NULL
        UNION ALL SELECT 'inventory', unnest(['supplier_id', 'po_number']), 'string', 'string' FROM inv WHERE NOT {FAULTY} AND n % 8 = 0
        UNION ALL SELECT 'ecommerce', unnest(['event_id', 'event_type', 'session_id', 'timestamp', 'channel', 'sku']), 'string', 'string' FROM eco WHERE NOT {FAULTY}
        UNION ALL SELECT 'ecommerce', 'customer_id', 'string', 'string' FROM eco WHERE NOT {FAULTY} AND customer_id IS NOT NULL
        UNION ALL SELECT 'ecommerce', 'search_query', 'string', 'string' FROM eco WHERE NOT {FAULTY} AND action = 'error')
        SELECT source, field, expected_type, seen_type, COUNT(*) AS records,
               CASE WHEN expected_type = seen_type THEN 'none' ELSE 'type_changed' END AS drift FROM seen GROUP BY ALL""",
    "file_gate": f"WITH {DROPS} SELECT * FROM verdicts",
    "file_gate_rows": f"WITH {DROPS} SELECT sku, store_id, quantity_on_hand, file FROM drops JOIN verdicts USING (file) WHERE verdict = 'accept'",
    "drop_routing": f"""WITH {EVENTS} SELECT DISTINCT 'd' || (n % 8) AS drop_name,
        CASE WHEN n % 8 <= 2 THEN 'json' WHEN n % 8 <= 5 THEN 'csv' WHEN n % 8 = 6 THEN 'parquet' END AS reader,
        CASE WHEN n % 8 = 7 THEN 'unsupported_format' END AS reason FROM ev""",
    "file_anti": f"""WITH {EVENTS}, days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM ev),
        firsts AS (SELECT CAST(day AS VARCHAR) AS file FROM days WHERE day(day) = 1)
        SELECT CAST(day + 1 AS VARCHAR) AS file, 'missing' AS issue, CAST(0 AS BIGINT) AS copies FROM days WHERE day + 1 NOT IN (SELECT day FROM days)
        UNION ALL SELECT file, 'duplicate', CAST(2 AS BIGINT) FROM firsts
        UNION ALL SELECT file || '-copy', 'duplicate', CAST(2 AS BIGINT) FROM firsts""",
    "reconcile_counts": f"""WITH {EVENTS}, dated AS (SELECT *, strftime(ingested, '%Y-%m-%d') AS date_prefix, day(ingested) % 3 AS d FROM marked),
        expected AS (SELECT date_prefix, COUNT(*) AS expected_count FROM dated WHERE copy = 0 GROUP BY date_prefix),
        actual AS (SELECT date_prefix, COUNT(*) AS actual_count FROM dated
                   WHERE (d = 0 AND copy = 0) OR d = 1 OR (d = 2 AND off % 3 = 0) GROUP BY date_prefix),
        joined AS (SELECT date_prefix, expected_count, coalesce(actual_count, 0) AS actual_count,
                   abs(coalesce(actual_count, 0) - expected_count) / CAST(greatest(expected_count, 1) AS DOUBLE) * 100 AS off_pct
                   FROM expected LEFT JOIN actual USING (date_prefix))
        SELECT date_prefix, expected_count, actual_count, round(off_pct, 2) AS variance_pct,
               CASE WHEN off_pct < 5 THEN 'OK' WHEN off_pct < 15 THEN 'WARN' ELSE 'FAIL' END AS status FROM joined""",
    "lag_report": f"""WITH {EVENTS}, spread AS ({per_topic("SELECT n, ts, '{topic}' AS topic, '{source}' AS source, n % {width} AS part FROM ev")}),
        ends AS (SELECT topic, part, MAX(n) + 1 AS end_offset FROM spread GROUP BY ALL),
        done AS (SELECT topic, part, MAX(n) + 1 AS committed FROM spread
                 WHERE source = 'inventory' OR (source = 'pos' AND part <> 11 AND ts < TIMESTAMP '2024-01-20') GROUP BY ALL),
        lags AS (SELECT topic, CAST(SUM(end_offset - coalesce(committed, 0)) AS BIGINT) AS total_lag, COUNT(*) AS partitions
                 FROM ends LEFT JOIN done USING (topic, part) GROUP BY topic)
        SELECT *, CASE WHEN total_lag < 10000 THEN 'OK' WHEN total_lag < 100000 THEN 'WARN' ELSE 'CRITICAL' END AS status FROM lags""",
    "layer_counts": f"""WITH {POS} SELECT 'raw' AS layer, COUNT(*) AS record_count FROM pos
        UNION ALL SELECT 'processed', COUNT(*) FROM pos WHERE transaction_id IS NOT NULL
        UNION ALL SELECT 'silver', COUNT(*) FROM pos_silver
        UNION ALL SELECT 'gold', COUNT(*) FROM (SELECT DISTINCT event_date, store_id FROM pos_silver WHERE event_type = 'sale' AND _is_valid)""",
    "latency_percentiles": f"WITH {EVENTS}, {WAITS} SELECT _kafka_topic, measured, p50, p95, p99 FROM points",
    "lag_from_progress": f"""WITH {EVENTS}, spread AS ({per_topic("SELECT n, ts, '{topic}' AS topic, n % {width} AS part FROM ev")}),
        ends AS (SELECT topic, part, MAX(n) + 1 AS end_offset, MAX(n) FILTER (WHERE ts < TIMESTAMP '2024-01-20') + 1 AS done FROM spread GROUP BY ALL),
        lags AS (SELECT topic, CAST(SUM(end_offset - coalesce(done, 0)) AS BIGINT) AS total_lag, COUNT(*) AS partitions FROM ends GROUP BY topic)
        SELECT *, CASE WHEN total_lag < 10000 THEN 'OK' WHEN total_lag < 100000 THEN 'WARN' ELSE 'CRITICAL' END AS status FROM lags""",
    "health_report": REPORTS.replace("judged AS (", WAITS + ", judged AS (") + """,
        spread AS (""" + per_topic("SELECT n, ts, '{topic}' AS topic, '{source}' AS source, n % {width} AS part FROM ev") + """),
        ends AS (SELECT topic, part, MAX(n) + 1 AS end_offset FROM spread GROUP BY ALL),
        done AS (SELECT topic, part, MAX(n) + 1 AS committed FROM spread
                 WHERE source = 'inventory' OR (source = 'pos' AND part <> 11 AND ts < TIMESTAMP '2024-01-20') GROUP BY ALL),
        lags AS (SELECT topic, SUM(end_offset - coalesce(committed, 0)) AS lag FROM ends LEFT JOIN done USING (topic, part) GROUP BY topic)
        SELECT 'lag' AS metric, topic AS name, CAST(lag AS DOUBLE) AS value,
               CASE WHEN lag < 10000 THEN 'OK' WHEN lag < 100000 THEN 'WARN' ELSE 'CRITICAL' END AS status FROM lags
        UNION ALL SELECT 'records', 'raw', CAST(COUNT(*) AS DOUBLE), 'OK' FROM pos
        UNION ALL SELECT 'records', 'processed', CAST(COUNT(*) AS DOUBLE), 'OK' FROM pos WHERE transaction_id IS NOT NULL
        UNION ALL SELECT 'pass_rate', source, pass_rate, CASE WHEN passed THEN 'OK' ELSE 'FAIL' END FROM judged
        UNION ALL SELECT 'latency_p95', _kafka_topic, p95, CASE WHEN p95 < 300 THEN 'OK' ELSE 'LATE' END FROM points""",
    "sku_incremental": f"""WITH {PRODUCTS} SELECT sku, unit_price, strftime(changed, '%Y-%m-%d') || 'T00:00:00+00:00' AS updated_at
        FROM prod WHERE changed >= DATE '2024-01-31'""",
    "sku_run_summary": f"""WITH {PRODUCTS} SELECT COUNT(DISTINCT page) AS pages_fetched, COUNT(*) FILTER (WHERE p % 37 <> 0) AS valid_records,
        COUNT(*) FILTER (WHERE p % 37 = 0) AS invalid_records, CAST(MAX(changed) FILTER (WHERE p % 37 <> 0) AS TIMESTAMP) AS watermark,
        'success' AS status FROM prod""",
    "product_upsert": f"""WITH {PRODUCTS} SELECT sku, CASE WHEN p % 3 = 0 THEN new_price ELSE unit_price END AS unit_price, active,
        strftime(CASE WHEN p % 3 = 0 THEN changed + 90 ELSE changed END, '%Y-%m-%d') || 'T00:00:00+00:00' AS updated_at
        FROM prod WHERE p % 37 <> 0""",
    "product_feed_runs": f"""WITH {PRODUCTS}, good AS (SELECT * FROM prod WHERE p % 37 <> 0)
        SELECT sku, CASE WHEN changed = (SELECT MAX(changed) FROM good) THEN round(unit_price + 2, 2) ELSE unit_price END AS unit_price,
        strftime(changed, '%Y-%m-%d') || 'T00:00:00+00:00' AS updated_at, CAST(2 AS INTEGER) AS version FROM good""",
    "stream_decode_split": f"""WITH {EVENTS}, messages AS ({per_topic(
        "SELECT n, off, '{topic}' AS topic, '{source}' AS source, CAST(n % {width} AS INTEGER) AS part FROM marked")})
        SELECT CASE WHEN {FAULTY} THEN 'dead' ELSE 'event' END AS kind, topic, part AS "partition", off AS "offset",
               CASE WHEN NOT {FAULTY} THEN CASE source WHEN 'pos' THEN 'POS-' WHEN 'inventory' THEN 'INV-' ELSE 'ECO-' END || n END AS event_id
        FROM messages""",
    "landing_lossless": f"""WITH {EVENTS} SELECT CASE WHEN n % 2 = 0 THEN 'retail.returns.events' ELSE 'retail.inventory.events' END AS topic,
        CAST(n AS BIGINT) AS "offset", '{{"event_id":' || n || ',"quantity_on_hand":"many","extra":{{"store":"' || store_id || '"}}}}' AS event FROM ev""",
    "dlq_route": f"""WITH {EVENTS}, messages AS ({per_topic(
        "SELECT n, off, k, store_id, '{topic}' AS topic, '{source}' AS source, CAST(n % {width} AS INTEGER) AS part FROM marked")})
        SELECT CASE WHEN source = 'pos' THEN 'retail.pos.dlq' ELSE 'retail.inventory.dlq' END AS dlq_topic, topic AS original_topic,
               part AS original_partition, off AS original_offset,
               CASE WHEN source = 'inventory' THEN store_id || ':SKU-' || k ELSE store_id END AS original_key,
               CASE WHEN n % 37 = 0 THEN 'None' WHEN n % 41 = 0 THEN '[1,2]' WHEN n % 43 = 0 THEN '{{"event_id":' ELSE '7BFF7D' END AS raw_value
        FROM messages WHERE {FAULTY}""",
    "stream_pos_intake": f"""WITH {POS}, checked AS (SELECT CASE WHEN NOT {FAULTY} THEN event_id END AS event_id, CASE
        WHEN {FAULTY} THEN 'Not a JSON object'
        WHEN transaction_id IS NULL THEN 'Missing required fields: [''transaction_id'']'
        WHEN coalesce(total_amount, -1) < 0 THEN 'Negative total amount' ELSE 'OK' END AS reason FROM pos)
        SELECT event_id, reason, COUNT(*) AS messages FROM checked GROUP BY ALL""",
    "stream_dedup": f"WITH {POS} SELECT event_id, event_type, store_id, transaction_id FROM pos WHERE copy = 0",
    "stream_hours_complete": f"""WITH {POS} SELECT date_trunc('hour', ts) AS hour_start, store_id, COUNT(transaction_id) AS transaction_count,
        {money('total_amount')} AS hourly_revenue FROM pos WHERE event_type = 'sale' AND copy = 0 GROUP BY ALL""",
    "stream_late_rows": f"""WITH {POS}, sales AS (SELECT *, ts < TIMESTAMP '2024-01-20' AND n % 50 <> 0 AS first FROM pos WHERE event_type = 'sale' AND copy = 0),
        mark AS (SELECT MAX(ts) AS newest FROM sales WHERE first)
        SELECT event_id, store_id, ts AS event_ts, newest, CAST(1 AS BIGINT) AS batch FROM sales, mark WHERE NOT first AND ts < newest - INTERVAL 1 HOUR""",
    "stream_hourly_sales": f"""WITH {POS}, sales AS (SELECT * FROM pos WHERE event_type = 'sale' AND copy = 0),
        hours AS (SELECT date_trunc('hour', ts) AS hour_start, store_id, COUNT(transaction_id) AS transaction_count,
                  {money('total_amount')} AS hourly_revenue FROM sales GROUP BY ALL)
        SELECT * FROM hours WHERE hour_start + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM sales) - INTERVAL 1 HOUR""",
    "contract_from_raw": contract("pos", POS, "pos", POS_CODES) + f" WHERE NOT {FAULTY}",
    "pipeline_bronze": f"""WITH {LATE} SELECT event_id, off AS _kafka_offset, CAST(copy + 1 AS BIGINT) AS "load", CAST(moved AS DATE) AS event_date,
        CASE WHEN transaction_id IS NULL THEN 'missing_required_field' END AS _validation_error, terminal_id FROM late""",
    "pipeline_silver": f"""WITH {LATE} SELECT event_id, CAST(moved AS DATE) AS event_date, store_id, total_amount, nullif({codes(
        ('null:event_ts', 'moved IS NULL'), ('null:total_amount', 'total_amount IS NULL'), ('null:event_date', 'moved IS NULL'), sep=',')}, '') AS _validation_error
        FROM late WHERE latest AND transaction_id IS NOT NULL""",
    "pipeline_gold": f"""WITH {LATE} SELECT CAST(moved AS DATE) AS event_date, store_id, COUNT(*) AS transaction_count, {money('total_amount')} AS gross_revenue,
        CAST(SUM(item_count + CASE WHEN n % 103 = 0 AND n % 89 <> 0 THEN 1 + CASE WHEN n % 2 = 0 THEN 1 ELSE 0 END ELSE 0 END) AS BIGINT) AS total_items_sold,
        COUNT(DISTINCT cashier_id) AS unique_cashiers, COUNT(DISTINCT payment_method) AS payment_methods_used
        FROM late WHERE latest AND transaction_id IS NOT NULL AND event_type = 'sale' AND total_amount >= 0 AND moved IS NOT NULL GROUP BY 1, 2""",
    "pipeline_stock": f"""WITH {INVENTORY}, late AS (
        SELECT *, CASE WHEN copy = 1 AND n % 20 = 0 THEN event_ts - INTERVAL 3 DAY ELSE event_ts END AS moved FROM inv),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY store_id, sku ORDER BY moved DESC, event_id DESC) AS place FROM late
                   WHERE latest AND moved IS NOT NULL)
        SELECT store_id, sku, quantity_on_hand, reorder_point, quantity_on_hand <= reorder_point AS below_reorder, location, moved AS event_ts,
        CASE WHEN quantity_on_hand > 0 THEN CAST(quantity_on_hand AS DOUBLE) / 10 ELSE CAST(0 AS DOUBLE) END AS days_of_stock_remaining
        FROM ranked WHERE place = 1""",
    "drop_pipeline": f"""WITH {EVENTS}, shaped AS (SELECT n, 'd' || (n % 8) AS drop_name, n % 8 AS d, 'SKU-' || k AS sku, store_id,
               CASE WHEN NOT (n % 8 = 3 AND n % 5 <> 0) THEN CAST(CAST(CASE WHEN n % 67 = 0 THEN -3 WHEN n % 13 = 0 THEN 0 ELSE floor(v) END AS INTEGER) AS VARCHAR) END
               AS quantity_on_hand FROM ev),
        rates AS (SELECT drop_name, CAST(COUNT(quantity_on_hand) AS DOUBLE) / COUNT(*) * 100 AS rate FROM shaped WHERE d = 3 GROUP BY drop_name)
        SELECT drop_name, 'accept' AS verdict, NULL AS reason, sku, store_id, quantity_on_hand,
               CASE WHEN d IN (0, 1, 2, 4) THEN 'note, ' || n END AS note, CASE WHEN d = 1 THEN sku END AS inside FROM shaped WHERE d IN (0, 1, 2, 4, 5)
        UNION ALL SELECT drop_name, 'reject', 'low_pass_rate_' || CAST(round_even(rate, 0) AS INTEGER) || 'pct', NULL, NULL, NULL, NULL, NULL FROM rates
        UNION ALL SELECT DISTINCT drop_name, CASE WHEN d = 6 THEN 'skip' ELSE 'reject' END, CASE WHEN d = 6 THEN 'no_records' ELSE 'unsupported_format' END,
                  NULL, NULL, NULL, NULL, NULL FROM shaped WHERE d IN (6, 7)
        UNION ALL SELECT 'd8', 'skip', 'empty_file', NULL, NULL, NULL, NULL, NULL""",
    "file_inventory": f"""WITH {EVENTS} SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(*) AS records, CAST(1 AS BIGINT) AS empty_files,
        CAST(1 AS BIGINT) AS without_bytes FROM ev GROUP BY 1""",
    "catalog_tables": f"""WITH {LATE} SELECT CAST(moved AS DATE) AS event_date, store_id, COUNT(*) AS sales, COUNT(*) AS transaction_count
        FROM late WHERE latest AND transaction_id IS NOT NULL AND event_type = 'sale' AND total_amount >= 0 AND moved IS NOT NULL GROUP BY 1, 2""",
    "daily_run": f"""WITH {ALL}, {PRODUCTS},
        late AS (SELECT *, CASE WHEN copy = 1 AND n % 20 = 0 THEN event_ts - INTERVAL 3 DAY ELSE event_ts END AS moved FROM pos),
        counts AS (
        SELECT 'pos' AS source, COUNT(*) FILTER (WHERE transaction_id IS NOT NULL) AS good, COUNT(*) FILTER (WHERE transaction_id IS NULL) AS bad,
               COUNT(*) FILTER (WHERE latest AND transaction_id IS NOT NULL AND event_ts IS NOT NULL AND total_amount IS NOT NULL) AS silver_good,
               COUNT(*) FILTER (WHERE latest AND transaction_id IS NOT NULL AND (event_ts IS NULL OR total_amount IS NULL)) AS silver_bad FROM pos
        UNION ALL SELECT 'inventory', COUNT(*), 0, COUNT(*) FILTER (WHERE latest AND event_ts IS NOT NULL), COUNT(*) FILTER (WHERE latest AND event_ts IS NULL) FROM inv
        UNION ALL SELECT 'ecommerce', COUNT(*) FILTER (WHERE customer_id IS NOT NULL), COUNT(*) FILTER (WHERE customer_id IS NULL),
               COUNT(*) FILTER (WHERE latest AND customer_id IS NOT NULL AND event_ts IS NOT NULL),
               COUNT(*) FILTER (WHERE latest AND customer_id IS NOT NULL AND event_ts IS NULL) FROM eco)
        SELECT 'bronze_' || source AS step, 'valid' AS name, good AS value FROM counts UNION ALL SELECT 'bronze_' || source, 'invalid', bad FROM counts
        UNION ALL SELECT 'silver_' || source, 'valid', silver_good FROM counts UNION ALL SELECT 'silver_' || source, 'invalid', silver_bad FROM counts
        UNION ALL SELECT 'manifest_' || source, 'records', good + bad FROM counts
        UNION ALL SELECT 'dimension', 'valid', COUNT(*) FROM prod WHERE p % 37 <> 0
        UNION ALL SELECT 'gate', 'quarantine_alert', 1
        UNION ALL SELECT 'gold_daily_sales_by_store', 'rows', COUNT(*) FROM (SELECT DISTINCT CAST(moved AS DATE), store_id FROM late
                  WHERE latest AND transaction_id IS NOT NULL AND event_type = 'sale' AND total_amount >= 0 AND moved IS NOT NULL)""",
    "report_sink": f"{REPORTS} SELECT * FROM judged",
    "processing_stamps": f"""WITH {ECOMMERCE} SELECT '0000-00-00T00:00:00.000000+00:00' AS form,
        2 * COUNT(*) + COUNT(*) FILTER (WHERE latest AND customer_id IS NOT NULL) AS records, CAST(0 AS BIGINT) AS unreadable FROM eco""",
}
