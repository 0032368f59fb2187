"""Silver to gold: the five business tables and the reports built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.money import exact_sum, oversized, scaled, unscaled
from .silver import latest_per_key


def sales(silver_pos: DataFrame) -> DataFrame:
    return silver_pos.where(F.col("event_type") == "sale")


def _gold_ts(df: DataFrame, stamp: bool) -> DataFrame:
    return df.withColumn("_gold_ts", F.current_timestamp()) if stamp else df


def daily_sales(silver_pos: DataFrame, stamp: bool = True) -> DataFrame:
    """Valid sales by day and store.

    Two distinct counts over the detail rows would make Spark expand every row threefold. All measures here can be
    combined from parts, so the rows are first folded to (day, store, cashier, payment method); a store with most of
    the sales is spread over its cashiers, and the distinct counts only see the folded rows.
    """
    money = {"gross_revenue": "total_amount", "total_discounts": "discount_total", "total_tax": "tax_amount"}
    parts = [F.count("transaction_id").alias("n"), F.count("total_amount").alias("n_amounts"),
             F.max("total_amount").alias("top"), F.sum("item_count").alias("items_sold")]
    for out, column in money.items():
        parts += [F.sum(scaled(F.col(column))).alias(f"{out}_s"), F.sum(oversized(F.col(column))).alias(f"{out}_o")]
    folded = (sales(silver_pos).where(F.col("_is_valid"))
              .groupBy("event_date", "store_id", "cashier_id", "payment_method").agg(*parts))

    def total(name: str):
        return unscaled(F.sum(f"{name}_s"), F.sum(f"{name}_o"))

    by_store = folded.groupBy("event_date", "store_id").agg(
        F.sum("n").alias("transaction_count"),
        *[total(name).alias(name) for name in money],
        (total("gross_revenue") / F.sum("n_amounts")).alias("avg_transaction_value"),
        F.max("top").alias("max_transaction_value"),
        F.sum("items_sold").alias("total_items_sold"),
        F.countDistinct("cashier_id").alias("unique_cashiers"),
        F.countDistinct("payment_method").alias("payment_methods_used"),
    )
    out = by_store.withColumn("net_revenue", F.col("gross_revenue") - F.col("total_discounts"))
    return _gold_ts(out, stamp).orderBy("event_date", "store_id")


def hourly_trend(silver_pos: DataFrame, valid_only: bool = False, stamp: bool = True) -> DataFrame:
    """Sales by hour and store with the change against the previous hour that had sales, within the day.

    Invalid sales are included unless ``valid_only``; the daily table leaves them out. The window sees one row per
    hour of a (day, store).
    """
    rows = sales(silver_pos)
    if valid_only:
        rows = rows.where(F.col("_is_valid"))
    revenue = exact_sum(F.col("total_amount"))
    hours = rows.groupBy("event_date", "event_hour", "store_id").agg(
        F.count("transaction_id").alias("transaction_count"),
        revenue.alias("hourly_revenue"),
        (revenue / F.nullif(F.count("total_amount"), F.lit(0))).alias("avg_basket_size"),
    )
    day = Window.partitionBy("event_date", "store_id").orderBy("event_hour")
    before = F.col("prev_hour_revenue")
    change = F.when(before > 0, (F.col("hourly_revenue") - before) / before * 100)
    out = hours.withColumn("prev_hour_revenue", F.lag("hourly_revenue").over(day)).withColumn("revenue_change_pct", change)
    return _gold_ts(out, stamp)


def hourly_spikes(hourly: DataFrame, threshold_pct: float = 100.0) -> DataFrame:
    """Hours whose revenue moved by at least ``threshold_pct`` percent."""
    return hourly.where(F.abs("revenue_change_pct") >= threshold_pct).withColumn(
        "direction", F.when(F.col("revenue_change_pct") > 0, "up").otherwise("down"))


def latest_stock_by_day(silver_inventory: DataFrame) -> DataFrame:
    """The latest movement of every (store, sku) of a day, with what the snapshot needs: parts that combine by the same rule."""
    parts = silver_inventory.select("event_date", "event_id", "event_ts", "store_id", "sku", "quantity_on_hand", "reorder_point", "below_reorder", "location")
    return latest_per_key(parts, ["event_date", "store_id", "sku"], [F.col("event_ts").desc(), F.col("event_id").desc()])


def inventory_snapshot(silver_inventory: DataFrame, daily_velocity: float = 10.0, stamp: bool = True) -> DataFrame:
    """Latest stock level of every (store, sku); ties on time go to the higher event id."""
    latest = latest_per_key(silver_inventory, ["store_id", "sku"], [F.col("event_ts").desc(), F.col("event_id").desc()])
    on_hand = F.col("quantity_on_hand")
    out = latest.select(
        "store_id", "sku", "quantity_on_hand", "reorder_point", "below_reorder", "location", "event_ts",
        F.when(on_hand > 0, on_hand / F.lit(daily_velocity)).otherwise(F.lit(0.0)).alias("days_of_stock_remaining"),
    )
    return _gold_ts(out, stamp)


def low_stock_alerts(snapshot: DataFrame) -> DataFrame:
    """Stock at or below its reorder point, most urgent first (the three words sort in the right order)."""
    on_hand = F.col("quantity_on_hand")
    urgency = (F.when(on_hand == 0, "CRITICAL")
               .when(on_hand < F.col("reorder_point") * 0.25, "HIGH")
               .otherwise("MEDIUM"))
    stamp = [c for c in ("_gold_ts",) if c in snapshot.columns]
    return (snapshot.where(F.col("below_reorder"))
            .select("store_id", "sku", "quantity_on_hand", "reorder_point", "location", *stamp, urgency.alias("urgency"))
            .orderBy("urgency", "quantity_on_hand"))


def critical_stock(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("urgency") == "CRITICAL").select("store_id", "sku", "quantity_on_hand")


def line_items(silver_pos: DataFrame) -> DataFrame:
    """One row per line of every sale."""
    return sales(silver_pos).select("event_id", "event_date", F.explode("items").alias("line")).select(
        "event_id", "event_date",
        F.col("line.sku").alias("sku"),
        F.col("line.product_name").alias("product_name"),
        F.col("line.category").alias("category"),
        F.col("line.quantity").alias("quantity_sold"),
        F.col("line.line_total").alias("line_revenue"),
    )


def top_products(silver_pos: DataFrame, top_n: int = 20, stamp: bool = True) -> DataFrame:
    """The products whose revenue rank of the day is at most ``top_n``; products tied at the edge all stay.

    The rank filter becomes a group limit before the exchange on the day, so a day ships its top rows only.
    """
    products = line_items(silver_pos).groupBy("event_date", "sku", "product_name", "category").agg(
        F.sum("quantity_sold").alias("total_units_sold"),
        exact_sum(F.col("line_revenue")).alias("total_revenue"),
    )
    day = Window.partitionBy("event_date").orderBy(F.col("total_revenue").desc())
    out = products.withColumn("revenue_rank", F.rank().over(day)).where(F.col("revenue_rank") <= top_n)
    return _gold_ts(out, stamp)


def ecommerce_funnel(silver_ecommerce: DataFrame) -> DataFrame:
    """Events and sessions by day, channel and step.

    Sessions are counted from rows folded to one per session, so the distinct count needs no row expansion.
    """
    folded = silver_ecommerce.groupBy("event_date", "channel", "event_type", "session_id").agg(F.count("*").alias("n"))
    return folded.groupBy("event_date", "channel", "event_type").agg(
        F.sum("n").alias("event_count"), F.count("session_id").alias("session_count"))


def freshness(tables: dict[str, DataFrame], as_of) -> DataFrame:
    """Age in seconds of the newest event of every table, against the five-minute target."""
    ages = None
    for name, table in tables.items():
        newest = table.agg(F.max("event_ts").alias("newest_event_ts")).select(F.lit(name).alias("table_name"), "newest_event_ts")
        ages = newest if ages is None else ages.unionByName(newest)
    age = F.unix_seconds(as_of) - F.unix_seconds("newest_event_ts")
    return ages.withColumn("age_seconds", age).withColumn("within_target", F.col("age_seconds") < 300)
