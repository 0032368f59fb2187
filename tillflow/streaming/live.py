"""Live views over typed POS streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.money import exact_sum, oversized, scaled, unscaled
from ..sources import readers
from .landing import start


def dedup_stream(events: DataFrame, delay: str = "1 hour", key: str = "event_id") -> DataFrame:
    """Drops repeated events. The first copy stays (the batch table keeps the latest); a copy later than ``delay``
    counts as new. State holds one entry per key of the last ``delay``."""
    return events.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark([key])


def hourly_sales_stream(sales: DataFrame, delay: str | None = "1 hour") -> DataFrame:
    """Hourly sales per store as a stream; in append mode an hour comes out once its late events are in.

    ``delay`` is None for a stream that has its watermark already, such as a deduplicated one.
    """
    marked = sales.withWatermark("event_ts", delay) if delay else sales
    hours = marked.groupBy(F.window("event_ts", "1 hour").alias("w"), "store_id").agg(
        F.count("transaction_id").alias("transaction_count"), exact_sum(F.col("total_amount")).alias("hourly_revenue"))
    return hours.select(F.col("w.start").alias("hour_start"), "store_id", "transaction_count", "hourly_revenue")


LATE = "event_id string, store_id string, event_ts timestamp, newest timestamp, batch bigint"


def live_hours(sales: DataFrame, root: str, checkpoint: str, delay: str = "1 hour", once: bool = False) -> StreamingQuery:
    """Hourly sales per store that are complete after every batch, whatever came late.

    A batch adds parts, sums that combine, for the hours it touches, so an hour is out at once and moves when more arrives. An
    event counts once: its id is looked up among those counted in the days of the batch, which alone are read. Copies of an
    event are of equal time. Rows more than ``delay`` older than the newest event of the batches before are counted and, beside
    that, listed as late. A batch writes folders of its own and replaces them when it is run again.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark, before = batch.sparkSession, F.col("batch") < batch_id
        fresh = batch.dropDuplicates(["event_id"]).withColumn("day", F.to_date("event_ts"))
        if batch_id and readers.exists(spark, f"{root}/seen"):
            days = [r.day for r in fresh.select("day").distinct().collect()]  # the days of one batch
            seen = spark.read.schema("event_id string, day date, batch bigint").parquet(f"{root}/seen").where(before & F.col("day").isin(days))
            fresh = fresh.join(seen, "event_id", "left_anti")
        fresh = fresh.persist()
        try:
            newest = None
            if batch_id and readers.exists(spark, f"{root}/parts"):
                newest = spark.read.schema("newest timestamp, batch bigint").parquet(f"{root}/parts").where(before).agg(F.max("newest")).first()[0]
            mark = F.lit(newest).cast("timestamp")
            late = fresh.where(F.col("event_ts") < mark - F.expr(f"INTERVAL {delay}")).select("event_id", "store_id", "event_ts", mark.alias("newest"))
            late.write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}")
            hours = fresh.groupBy(F.date_trunc("hour", "event_ts").alias("hour_start"), "store_id").agg(
                F.count("transaction_id").alias("n"), F.sum(scaled(F.col("total_amount"))).alias("revenue_s"),
                F.sum(oversized(F.col("total_amount"))).alias("revenue_o"), F.max("event_ts").alias("newest"))
            hours.write.mode("overwrite").parquet(f"{root}/parts/batch={batch_id}")
            fresh.select("event_id", "day").write.mode("overwrite").partitionBy("day").parquet(f"{root}/seen/batch={batch_id}")
        finally:
            fresh.unpersist()

    return start(sales, write_batch, checkpoint, once)


def read_live_hours(spark: SparkSession, root: str) -> DataFrame:
    """All hours as they stand: the parts of all batches combined."""
    parts = spark.read.parquet(f"{root}/parts")
    return parts.groupBy("hour_start", "store_id").agg(
        F.sum("n").alias("transaction_count"), unscaled(F.sum("revenue_s"), F.sum("revenue_o")).alias("hourly_revenue"))


def read_late(spark: SparkSession, root: str) -> DataFrame:
    """The rows that came late, each with the newest event time seen before it."""
    return spark.read.schema(LATE).parquet(f"{root}/late")
