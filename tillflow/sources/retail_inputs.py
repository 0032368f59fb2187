"""Retail-shaped inputs derived from the test tables: raw rows, message envelopes, product pages, offsets.

Every frame is a projection of a whole table; faults (missing ids, bad text, duplicates) sit on fixed residues of the
event id so that an independent SQL can predict every result. FIXTURES.md describes the mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.instants import iso_text
from ..schemas import (CATEGORIES, CHANNELS, INVENTORY_TYPES, PAYMENT_METHODS, TOPICS)

MICROS = 1_000_000


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def events(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """The events table with the derived keys ``n`` (event id), ``k`` (from props) and ``store_id``; dealt to ``tasks`` as it is read."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return (rows if tasks is None else rows.repartition(tasks, "event_id")).select(
        F.col("event_id").alias("n"), F.col("ts").cast("timestamp").alias("ts"), "user_id",
        F.col("event_type").alias("action"), F.col("value").alias("v"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        _padded("STR", F.col("user_id") % 5 + 1, 4).alias("store_id"),
    )


def with_copies(ev: DataFrame) -> DataFrame:
    """Every tenth event is delivered a second time, later and with a higher offset (``copy`` = 1)."""
    copies = F.when(F.col("n") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return ev.withColumn("copy", F.explode(copies))


def _delivered(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    """Events and, if asked for, their copies, dealt to all cores before anything is made of them: a file of few row groups has few tasks.

    With a number of its own the exchange is not merged by AQE, which sees the narrow rows only.
    """
    ev = events(spark, sf_dir, 4 * spark.sparkContext.defaultParallelism)
    return with_copies(ev) if copies else ev.withColumn("copy", F.lit(0))


def _later(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds * MICROS)


def _ingest_columns(source: str, partitions: int) -> list[Column]:
    n, copy = F.col("n"), F.col("copy")
    return [
        iso_text(_later(F.col("ts"), 30 + n % 7 * 5 + copy * 60)).alias("_ingestion_ts"),
        F.lit(TOPICS[source]).alias("_kafka_topic"),
        (n % partitions).cast("int").alias("_kafka_partition"),
        (n + copy * MICROS).alias("_kafka_offset"),
    ]


def _event_text(n: Column) -> Column:
    return F.when(n % 83 == 0, "not-a-time").otherwise(iso_text(F.col("ts")))


def _cents(amount: Column) -> Column:
    return F.round(amount, 2)


def _item(k: Column, quantity: Column) -> Column:
    v = F.col("v")
    return F.struct(
        F.concat(F.lit("SKU-"), k.cast("string")).alias("sku"),
        F.concat(F.lit("Product "), k.cast("string")).alias("product_name"),
        _pick(CATEGORIES, k % len(CATEGORIES)).alias("category"),
        quantity.cast("int").alias("quantity"),
        v.alias("unit_price"),
        F.lit(0.0).alias("discount"),
        # one line in 61 is a unit too dear
        _cents(v * quantity + F.when(F.col("n") % 61 == 0, 1.0).otherwise(0.0)).alias("line_total"),
    )


def pos_columns() -> dict[str, Column]:
    n, v, k, copy = F.col("n"), F.col("v"), F.col("k"), F.col("copy")
    discount = F.when(n % 4 == 0, 1.0).otherwise(0.0)
    tax = n % 7 * 0.25
    total = _cents(v - discount + tax + copy)
    total = F.when(n % 53 == 0, F.lit(None).cast("double")).when(n % 59 == 0, 0 - v).otherwise(total)
    first, second = F.struct(k.alias("k"), (n % 3 + 1).alias("quantity")), F.struct(((k + 1) % 100).alias("k"), F.lit(1).cast("bigint").alias("quantity"))
    lines = F.when(n % 89 == 0, F.array().cast("array<struct<k:int,quantity:bigint>>")).when(n % 2 == 0, F.array(first, second)).otherwise(F.array(first))
    items = F.transform(lines, lambda line: _item(line["k"], line["quantity"]))
    method = F.when(n % 101 == 0, "bitcoin").otherwise(_pick(PAYMENT_METHODS, n % 6))
    return {
        "event_id": F.concat(F.lit("POS-"), n.cast("string")),
        "event_type": F.when(F.col("action") == "signup", "refund").when(F.col("action") == "error", "void").otherwise("sale"),
        "store_id": F.col("store_id"),
        "terminal_id": _padded("TRM-", n % 20 + 1, 3),
        "cashier_id": F.concat(F.lit("EMP-"), (F.col("user_id") + 1000).cast("string")),
        "timestamp": _event_text(n),
        "transaction_id": F.when(n % 97 != 0, F.concat(F.lit("TXN-"), n.cast("string"))),
        "items": items,
        "payment": F.struct(method.alias("method"), F.coalesce(total, F.lit(0.0)).alias("amount_tendered")),
        "totals": F.struct(v.alias("subtotal"), discount.alias("discount"), tax.alias("tax"), total.alias("total")),
    }


def raw_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed POS rows: nested parts are JSON text; the items text of every 103rd event is broken."""
    parts = pos_columns()
    nested = ("items", "payment", "totals")
    columns = [(F.to_json(c) if name in nested else c).alias(name) for name, c in parts.items()]
    columns[7] = F.when(F.col("n") % 103 == 0, "{bad").otherwise(columns[7]).alias("items")
    return _delivered(spark, sf_dir).select(*columns, F.lit(None).cast("string").alias("metadata"),
                                            *_ingest_columns("pos", 12))


def inventory_columns() -> dict[str, Column]:
    n, k = F.col("n"), F.col("k")
    kind = _pick(INVENTORY_TYPES, n % 8)
    restock = n % 8 == 0
    none = F.lit(None).cast("string")
    return {
        "event_id": F.concat(F.lit("INV-"), n.cast("string")),
        # one type in 73 is not in the contract
        "event_type": F.when(n % 73 == 0, "recount").otherwise(kind),
        "store_id": F.col("store_id"),
        "warehouse_id": none,
        "sku": F.concat(F.lit("SKU-"), k.cast("string")),
        "product_name": F.concat(F.lit("Product "), k.cast("string")),
        "timestamp": _event_text(n),
        "quantity_delta": (n % 41 - 20).cast("int"),
        "quantity_on_hand": F.when(n % 67 == 0, -3).when(n % 13 == 0, 0).otherwise(F.floor("v")).cast("int"),
        "reorder_point": F.when(n % 31 != 0, F.col("user_id") % 41 + 10).cast("int"),
        "supplier_id": F.when(restock, F.concat(F.lit("SUP-"), (n % 9).cast("string"))),
        "po_number": F.when(restock, F.concat(F.lit("PO-"), n.cast("string"))),
        "location": _padded("A", k % 20 + 1, 2),
        "metadata": none,
    }


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [c.alias(name) for name, c in inventory_columns().items()]
    return _delivered(spark, sf_dir).select(*columns, *_ingest_columns("inventory", 6))


def ecommerce_columns() -> dict[str, Column]:
    n = F.col("n")
    step = {"view": "page_view", "click": "add_to_cart", "signup": "checkout_start", "purchase": "order_placed", "error": "search"}
    kind = F.coalesce(*[F.when(F.col("action") == a, F.lit(s)) for a, s in step.items()])
    none = F.lit(None).cast("string")
    return {
        "event_id": F.concat(F.lit("ECO-"), n.cast("string")),
        "event_type": kind,
        "session_id": F.concat(F.lit("S-"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyy-MM-dd")),
        "customer_id": F.when(n % 71 != 0, F.concat(F.lit("C-"), F.col("user_id").cast("string"))),
        "timestamp": _event_text(n),
        # one channel in 79 is not in the contract
        "channel": F.when(n % 79 == 0, "kiosk").otherwise(_pick(CHANNELS, F.col("user_id") % 3)),
        "sku": F.concat(F.lit("SKU-"), F.col("k").cast("string")),
        "product_name": none,
        "category": none,
        "price": F.lit(None).cast("double"),
        "quantity": F.lit(None).cast("int"),
        "order": none,
        "search_query": F.when(F.col("action") == "error", F.concat(F.lit("product "), F.col("k").cast("string"))),
        "device_type": none,
        "metadata": none,
    }


def raw_ecommerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [c.alias(name) for name, c in ecommerce_columns().items()]
    return _delivered(spark, sf_dir).select(*columns, *_ingest_columns("ecommerce", 8))


RAW_INPUTS = {"pos": raw_pos, "inventory": raw_inventory, "ecommerce": raw_ecommerce}


def envelope(spark: SparkSession, sf_dir: str, source: str, faults: bool = True, copies: bool = True) -> DataFrame:
    """Messages of one topic: ``key, value, topic, partition, offset, timestamp``; without ``copies`` every event is delivered once.

    With ``faults`` some values are an array (every 41st), cut-off JSON (43rd), empty of bytes that are text (47th,
    invalid UTF-8) or null (37th); the POS items of every 103rd event are text instead of an array.
    """
    n, copy = F.col("n"), F.col("copy")
    parts = {"pos": pos_columns, "inventory": inventory_columns, "ecommerce": ecommerce_columns}[source]()
    partitions = {"pos": 12, "inventory": 6, "ecommerce": 8}[source]
    document = F.to_json(F.struct(*[c.alias(name) for name, c in parts.items()]))
    value = document
    if source == "pos" and faults:
        odd = {name: c for name, c in parts.items()}
        odd["items"] = F.lit("{bad")
        value = F.when(n % 103 == 0, F.to_json(F.struct(*[c.alias(name) for name, c in odd.items()]))).otherwise(document)
    value = value.cast("binary")
    if faults:
        value = (F.when(n % 37 == 0, F.lit(None).cast("binary"))
                 .when(n % 41 == 0, F.lit("[1,2]").cast("binary"))
                 .when(n % 43 == 0, F.lit('{"event_id":').cast("binary"))
                 .when(n % 47 == 0, F.unhex(F.lit("7BFF7D")))
                 .otherwise(value))
    key = F.concat(F.col("store_id"), F.lit(":SKU-"), F.col("k").cast("string")) if source == "inventory" else F.col("store_id")
    return _made(_delivered(spark, sf_dir, copies).select(
        key.alias("key"), value.alias("value"), F.lit(TOPICS[source]).alias("topic"),
        (n % partitions).cast("int").alias("partition"), (n + copy * MICROS).alias("offset"), F.col("ts").alias("timestamp")))


def _made(messages: DataFrame) -> DataFrame:
    """Messages whose values are made once: a filter on the value stays above the generator instead of making it again below."""
    return messages.withColumn("value", F.explode(F.array("value")))


def late_envelope(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Messages without faults; the second copies of every twentieth event are of a time three days earlier."""
    n, late = F.col("n"), (F.col("copy") == 1) & (F.col("n") % 20 == 0)
    parts = {"pos": pos_columns, "inventory": inventory_columns, "ecommerce": ecommerce_columns}[source]()
    parts["timestamp"] = F.when((n % 83 != 0) & late, iso_text(F.col("ts") - F.expr("INTERVAL 3 DAYS"))).otherwise(parts["timestamp"])
    value = F.to_json(F.struct(*[c.alias(name) for name, c in parts.items()])).cast("binary")
    return _delivered(spark, sf_dir).select(
        F.col("store_id").alias("key"), value.alias("value"), F.lit(TOPICS[source]).alias("topic"), (n % 12).cast("int").alias("partition"),
        (n + F.col("copy") * MICROS).alias("offset"), F.col("ts").alias("timestamp"))


def products(spark: SparkSession, sf_dir: str, batch: int = 0) -> DataFrame:
    """Product records as JSON text with their feed page. Batch 1 holds every third product, dearer and 90 days newer."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    p = F.col("p_partkey")
    price = F.when(p % 37 == 0, F.lit(-1.0)).otherwise(_cents(F.col("p_retailprice") + batch))
    changed = F.date_add(F.lit("2024-01-01").cast("date"), (p % 60).cast("int") + 90 * batch)
    record = F.to_json(F.struct(
        F.concat(F.lit("SKU-"), p.cast("string")).alias("sku"),
        F.col("p_name").alias("product_name"),
        _pick(CATEGORIES, p % len(CATEGORIES)).alias("category"),
        F.col("p_brand").alias("brand"),
        price.alias("unit_price"),
        F.lit("each").alias("unit_of_measure"),
        (p % 20 != 0).alias("active"),
        F.concat(F.date_format(changed, "yyyy-MM-dd"), F.lit("T00:00:00+00:00")).alias("updated_at"),
    ))
    rows = part.where(p % 3 == 0) if batch else part
    return rows.select((F.floor(p / 100) + 1).cast("int").alias("page"), record.alias("record"))


def pages(records: DataFrame) -> DataFrame:
    """Product records packed into feed pages of a hundred, one JSON line per page."""
    packed = records.groupBy("page").agg(F.sort_array(F.collect_list("record")).alias("data"))
    return packed.select(F.concat(F.lit('{"page":'), F.col("page").cast("string"), F.lit(',"data":['),
                                  F.array_join("data", ","), F.lit("]}")).alias("value"))


def offsets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(end offsets, committed offsets) by topic and partition.

    POS is read up to 20 January with one partition never read, inventory is read to the end, e-commerce not at all.
    """
    ev = events(spark, sf_dir)
    widths = F.array(*[F.struct(F.lit(TOPICS[s]).alias("topic"), F.lit(w).alias("width"))
                       for s, w in (("pos", 12), ("inventory", 6), ("ecommerce", 8))])
    spread = ev.select("n", "ts", F.inline(widths)).withColumn("partition", (F.col("n") % F.col("width")).cast("int"))
    end = spread.groupBy("topic", "partition").agg((F.max("n") + 1).alias("end_offset"))
    pos = (F.col("topic") == TOPICS["pos"]) & (F.col("ts") < F.lit("2024-01-20").cast("timestamp")) & (F.col("partition") != 11)
    read = spread.where(pos | (F.col("topic") == TOPICS["inventory"]))
    return end, read.groupBy("topic", "partition").agg((F.max("n") + 1).alias("committed_offset"))


def order_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed POS rows built from orders and their lines, one sale per order; orders without lines keep ``[]``."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    item = F.struct(
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
        F.concat(F.lit("Product "), F.col("l_partkey").cast("string")).alias("product_name"),
        _pick(CATEGORIES, F.col("l_partkey") % len(CATEGORIES)).alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.lit(0.0).alias("discount"),
        F.col("l_extendedprice").alias("line_total"),
    )
    # an order has a handful of lines, so its list is small however many orders there are
    baskets = lines.groupBy("l_orderkey").agg(F.to_json(F.sort_array(F.collect_list(item))).alias("items"))
    joined = orders.join(baskets, orders["o_orderkey"] == baskets["l_orderkey"], "left")
    key = F.col("o_orderkey")
    total = F.col("o_totalprice")
    return joined.select(
        F.concat(F.lit("ORD-"), key.cast("string")).alias("event_id"),
        F.when(F.col("o_orderstatus") == "P", "refund").otherwise("sale").alias("event_type"),
        _padded("STR", F.col("o_custkey") % 50 + 1, 4).alias("store_id"),
        F.lit("TRM-001").alias("terminal_id"),
        F.concat(F.lit("EMP-"), (F.col("o_custkey") % 400).cast("string")).alias("cashier_id"),
        iso_text(F.col("o_orderdate").cast("timestamp")).alias("timestamp"),
        F.concat(F.lit("TXN-"), key.cast("string")).alias("transaction_id"),
        F.coalesce("items", F.lit("[]")).alias("items"),
        F.to_json(F.struct(_pick(PAYMENT_METHODS, key % 6).alias("method"), total.alias("amount_tendered"))).alias("payment"),
        F.to_json(F.struct(total.alias("subtotal"), F.lit(0.0).alias("discount"), F.lit(0.0).alias("tax"),
                           total.alias("total"))).alias("totals"),
        F.lit(None).cast("string").alias("metadata"),
        iso_text(F.col("o_orderdate").cast("timestamp")).alias("_ingestion_ts"),
        F.lit(TOPICS["pos"]).alias("_kafka_topic"), (key % 12).cast("int").alias("_kafka_partition"),
        key.alias("_kafka_offset"),
    )
