"""Column lists, contracts and domain constants of the retail model."""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values: topics, domain lists, thresholds ----------------------------------------------------------------

TOPICS = {
    "pos": "retail.pos.events",
    "inventory": "retail.inventory.events",
    "ecommerce": "retail.ecommerce.events",
}
DLQ_POS = "retail.pos.dlq"
DLQ_INVENTORY = "retail.inventory.dlq"
CATEGORIES = ["electronics", "apparel", "grocery", "home", "beauty", "sports", "toys", "automotive"]
PAYMENT_METHODS = ["cash", "credit_card", "debit_card", "mobile_pay", "gift_card", "store_credit"]
POS_TYPES = ["sale", "refund", "void", "no_sale"]
INVENTORY_TYPES = ["restock", "sale_deduction", "adjustment", "transfer_in", "transfer_out", "damage", "return", "cycle_count"]
ECOMMERCE_TYPES = ["page_view", "add_to_cart", "remove_from_cart", "checkout_start", "order_placed", "order_cancelled",
                   "return_initiated", "search"]
CHANNELS = ["web", "mobile_app", "tablet"]

REQUIRED = {
    "pos": ["event_id", "store_id", "transaction_id", "timestamp"],
    "inventory": ["event_id", "store_id", "sku", "timestamp", "quantity_on_hand"],
    "ecommerce": ["event_id", "session_id", "customer_id", "timestamp"],
}
INTAKE_REQUIRED = ["event_id", "store_id", "transaction_id", "timestamp", "totals"]

PASS_RATE_PCT = 95.0
FILE_PASS_RATE_PCT = 80.0
REASONABLE_TOTAL = 100_000
LAG_OK, LAG_WARN = 10_000, 100_000
VARIANCE_OK, VARIANCE_WARN = 5.0, 15.0
BYTES_PER_RECORD = 200
FLUSH_SECONDS, FLUSH_RECORDS = 60, 5_000
POLL_SECONDS = 1
LATENCY_TARGET_SECONDS = 300

# ---- raw rows: business columns, nested parts as JSON text ----------------------------------------------------------

EVENT_COLUMNS = {
    "pos": "event_id string, event_type string, store_id string, terminal_id string, cashier_id string, timestamp string, "
           "transaction_id string, items string, payment string, totals string, metadata string",
    "inventory": "event_id string, event_type string, store_id string, warehouse_id string, sku string, product_name string, "
                 "timestamp string, quantity_delta int, quantity_on_hand int, reorder_point int, supplier_id string, "
                 "po_number string, location string, metadata string",
    "ecommerce": "event_id string, event_type string, session_id string, customer_id string, timestamp string, channel string, "
                 "sku string, product_name string, category string, price double, quantity int, `order` string, "
                 "search_query string, device_type string, metadata string",
}
INGEST_COLUMNS = "_ingestion_ts string, _kafka_topic string, _kafka_partition int, _kafka_offset bigint"
#: The whole event beside its columns: the text as it came, and parsed once.
WHOLE_EVENT = "_event_text string, _event variant"
BRONZE_COLUMNS = "_bronze_loaded_at string, _source_name string, _record_hash string, event_date date, event_hour int"
NESTED_COLUMNS = {"pos": ["items", "payment", "totals", "metadata"], "inventory": ["metadata"], "ecommerce": ["order", "metadata"]}

RAW = {source: f"{columns}, {INGEST_COLUMNS}" for source, columns in EVENT_COLUMNS.items()}
BRONZE = {source: f"{columns}, {BRONZE_COLUMNS}" for source, columns in RAW.items()}

ITEMS = ("array<struct<sku:string,product_name:string,category:string,quantity:int,unit_price:double,"
         "discount:double,line_total:double>>")
TOTALS = "subtotal double, discount double, tax double, total double"
PAYMENT = "method string, amount_tendered double, change_given double, card_last_four string"

# ---- silver tables: name, type, required ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Col:
    name: str
    type: str
    required: bool = False


SILVER = {
    "pos": [
        Col("event_id", "string", True), Col("event_type", "string", True), Col("store_id", "string", True),
        Col("terminal_id", "string"), Col("cashier_id", "string"), Col("event_ts", "timestamp", True),
        Col("transaction_id", "string", True), Col("subtotal", "double"), Col("discount_total", "double"),
        Col("tax_amount", "double"), Col("total_amount", "double", True), Col("payment_method", "string"),
        Col("item_count", "int"), Col("items", ITEMS), Col("event_date", "date", True), Col("event_hour", "int"),
        Col("_silver_ts", "string"), Col("_is_valid", "boolean"),
    ],
    "inventory": [
        Col("event_id", "string", True), Col("event_type", "string", True), Col("store_id", "string", True),
        Col("sku", "string", True), Col("event_ts", "timestamp", True), Col("quantity_delta", "int"),
        Col("quantity_on_hand", "int", True), Col("reorder_point", "int"), Col("below_reorder", "boolean"),
        Col("supplier_id", "string"), Col("po_number", "string"), Col("location", "string"),
        Col("event_date", "date", True), Col("_silver_ts", "string"),
    ],
    "ecommerce": [
        Col("event_id", "string", True), Col("event_type", "string", True), Col("session_id", "string", True),
        Col("customer_id", "string", True), Col("event_ts", "timestamp", True), Col("channel", "string"),
        Col("sku", "string"), Col("price", "double"), Col("quantity", "int"), Col("order_total", "double"),
        Col("event_date", "date", True), Col("event_hour", "int"), Col("_silver_ts", "string"),
    ],
}
#: Days are the partitions of all tables that have them; stores are sorted inside, so their number does not matter.
DAY = "event_date"

PRODUCT = ("sku string, product_name string, category string, subcategory string, brand string, unit_price double, "
           "cost_price double, unit_of_measure string, weight_kg double, is_perishable boolean, active boolean, "
           "created_at string, updated_at string")


def ddl(columns: list[Col]) -> str:
    return ", ".join(f"`{c.name}` {c.type}" for c in columns)


# ---- event contracts: path, JSON type, rules ------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """One rule line of a contract; ``items[].sku`` is a field of every element of ``items``."""
    path: str
    kind: str
    required: bool = False
    nullable: bool = False
    allowed: tuple[str, ...] = ()
    minimum: float | None = None
    min_items: int | None = None
    instant: bool = False


# fixed values: field names, types and limits of the three event kinds and of the product feed
CONTRACTS = {
    "pos": [
        Field("event_id", "string", required=True),
        Field("event_type", "string", required=True, allowed=tuple(POS_TYPES)),
        Field("store_id", "string", required=True),
        Field("terminal_id", "string", required=True),
        Field("cashier_id", "string"),
        Field("timestamp", "string", required=True, instant=True),
        Field("transaction_id", "string", required=True),
        Field("items", "array", required=True, min_items=1),
        Field("items[].sku", "string", required=True),
        Field("items[].product_name", "string"),
        Field("items[].category", "string"),
        Field("items[].quantity", "integer", required=True, minimum=1),
        Field("items[].unit_price", "number", required=True, minimum=0),
        Field("items[].discount", "number", minimum=0),
        Field("items[].line_total", "number", required=True),
        Field("payment", "object", required=True),
        Field("payment.method", "string", required=True),
        Field("payment.amount_tendered", "number", required=True),
        Field("payment.change_given", "number"),
        Field("payment.card_last_four", "string"),
        Field("totals", "object", required=True),
        Field("totals.subtotal", "number", required=True),
        Field("totals.discount", "number"),
        Field("totals.tax", "number", required=True),
        Field("totals.total", "number", required=True),
        Field("metadata", "object"),
    ],
    "inventory": [
        Field("event_id", "string", required=True),
        Field("event_type", "string", required=True, allowed=tuple(INVENTORY_TYPES)),
        Field("store_id", "string", required=True),
        Field("warehouse_id", "string"),
        Field("sku", "string", required=True),
        Field("product_name", "string"),
        Field("timestamp", "string", required=True, instant=True),
        Field("quantity_delta", "integer", required=True),
        Field("quantity_on_hand", "integer", required=True, minimum=0),
        Field("reorder_point", "integer"),
        Field("supplier_id", "string"),
        Field("po_number", "string"),
        Field("location", "string"),
        Field("metadata", "object"),
    ],
    "ecommerce": [
        Field("event_id", "string", required=True),
        Field("event_type", "string", required=True, allowed=tuple(ECOMMERCE_TYPES)),
        Field("session_id", "string", required=True),
        Field("customer_id", "string", required=True),
        Field("timestamp", "string", required=True, instant=True),
        Field("channel", "string", allowed=tuple(CHANNELS)),
        Field("sku", "string", nullable=True),
        Field("product_name", "string", nullable=True),
        Field("category", "string", nullable=True),
        Field("price", "number", nullable=True),
        Field("quantity", "integer", nullable=True),
        Field("order", "object", nullable=True),
        Field("order.order_id", "string"),
        Field("order.items", "array"),
        Field("order.subtotal", "number"),
        Field("order.shipping", "number"),
        Field("order.tax", "number"),
        Field("order.total", "number"),
        Field("order.payment_method", "string"),
        Field("search_query", "string", nullable=True),
        Field("device_type", "string"),
        Field("metadata", "object"),
    ],
    "sku": [
        Field("sku", "string", required=True),
        Field("product_name", "string", required=True),
        Field("category", "string", required=True),
        Field("subcategory", "string", nullable=True),
        Field("brand", "string", nullable=True),
        Field("unit_price", "number", required=True, minimum=0),
        Field("cost_price", "number", nullable=True),
        Field("unit_of_measure", "string"),
        Field("weight_kg", "number", nullable=True),
        Field("is_perishable", "boolean"),
        Field("active", "boolean", required=True),
        Field("created_at", "string"),
        Field("updated_at", "string"),
    ],
}
