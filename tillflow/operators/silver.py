"""Bronze to silver: flatten, cast, deduplicate, enforce the table schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.instants import event_time, iso_text
from ..schemas import ITEMS, PAYMENT, SILVER, TOTALS, Col

# NaN and Infinity are no JSON; an amount written that way counts as absent
STRICT_JSON = {"allowNonNumericNumbers": "false"}

# the latest copy of an event wins; the later columns only decide between copies of one load
RECENCY = ["_bronze_loaded_at", "_ingestion_ts", "_kafka_partition", "_kafka_offset", "_record_hash"]


def _recency(df: DataFrame) -> list[str]:
    return [c for c in RECENCY if c in df.columns]


def clean_pos(bronze: DataFrame, silver_ts: Column | None = None) -> DataFrame:
    """One flat row per POS event plus the typed ``items``; ordering columns stay until ``deduplicate`` drops them."""
    parsed = bronze.withColumns({
        "_totals": F.from_json("totals", TOTALS, STRICT_JSON),
        "_payment": F.from_json("payment", PAYMENT, STRICT_JSON),
        "_items": F.from_json("items", ITEMS, STRICT_JSON),
        "event_ts": event_time(F.col("timestamp")),
    })
    total = F.col("_totals.total")
    return parsed.select(
        "event_id", "event_type", "store_id", "terminal_id", "cashier_id", "event_ts", "transaction_id",
        F.col("_totals.subtotal").alias("subtotal"),
        F.col("_totals.discount").alias("discount_total"),
        F.col("_totals.tax").alias("tax_amount"),
        total.alias("total_amount"),
        F.col("_payment.method").alias("payment_method"),
        F.coalesce(F.size("_items"), F.lit(0)).alias("item_count"),
        F.col("_items").alias("items"),
        "event_date", "event_hour",
        (silver_ts if silver_ts is not None else iso_text(F.current_timestamp())).alias("_silver_ts"),
        (total.isNotNull() & (total >= 0)).alias("_is_valid"),
        *_recency(bronze),
    )


def clean_inventory(bronze: DataFrame, silver_ts: Column | None = None) -> DataFrame:
    """Typed inventory movements; ``below_reorder`` is null where no reorder point is known."""
    return bronze.select(
        "event_id", "event_type", "store_id", "sku",
        event_time(F.col("timestamp")).alias("event_ts"),
        "quantity_delta", "quantity_on_hand", "reorder_point",
        (F.col("quantity_on_hand") <= F.col("reorder_point")).alias("below_reorder"),
        "supplier_id", "po_number", "location", "event_date",
        (silver_ts if silver_ts is not None else iso_text(F.current_timestamp())).alias("_silver_ts"),
        *_recency(bronze),
    )


def clean_ecommerce(bronze: DataFrame, silver_ts: Column | None = None) -> DataFrame:
    return bronze.select(
        "event_id", "event_type", "session_id", "customer_id",
        event_time(F.col("timestamp")).alias("event_ts"),
        "channel", "sku", "price", "quantity",
        F.from_json(F.col("`order`"), "total double", STRICT_JSON)["total"].alias("order_total"),
        "event_date", "event_hour",
        (silver_ts if silver_ts is not None else iso_text(F.current_timestamp())).alias("_silver_ts"),
        *_recency(bronze),
    )


CLEANERS = {"pos": clean_pos, "inventory": clean_inventory, "ecommerce": clean_ecommerce}


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``order``.

    Catalyst turns ``row_number() = 1`` into a group limit below and above the exchange: every task sends at most one
    row per key, so a key with most of the rows neither moves nor lands in one task as a whole.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def deduplicate(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Keeps the latest copy of every event and drops the ordering columns."""
    recency = _recency(df)
    return latest_per_key(df, [key], [F.col(c).desc() for c in recency]).drop(*recency)


def check_schema(df: DataFrame, columns: Sequence[Col]) -> DataFrame:
    """Casts to the declared columns and adds ``_schema_errors``: ``null:x``, ``cast:x`` per violated column.

    A required column the data lacks is null in every row; an optional one is filled with null.
    """
    cast, errors = [], []
    for column in columns:
        if column.name in df.columns:
            before = F.col(f"`{column.name}`")
            after = before.try_cast(column.type)
            errors.append(F.when(before.isNotNull() & after.isNull(), F.lit(f"cast:{column.name}")))
            if column.required:
                errors.append(F.when(before.isNull(), F.lit(f"null:{column.name}")))
        else:
            after = F.lit(None).cast(column.type)
            if column.required:
                errors.append(F.lit(f"null:{column.name}"))
        cast.append(after.alias(column.name))
    return df.select(*cast, F.array_compact(F.array(*errors)).alias("_schema_errors"))


def enforce_schema(df: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the silver table, rows for quarantine with the violated columns as text)."""
    checked = check_schema(df, SILVER[source])
    fits = F.size("_schema_errors") == 0
    bad = checked.where(~fits).withColumn("_validation_error", F.array_join("_schema_errors", ",")).drop("_schema_errors")
    return checked.where(fits).drop("_schema_errors"), bad


def build_silver(bronze: DataFrame, source: str) -> DataFrame:
    """Cleaned and deduplicated rows of one source."""
    return deduplicate(CLEANERS[source](bronze))
