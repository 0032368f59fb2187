"""The message envelope ``key, value, topic, partition, offset, timestamp`` and its decoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.documents import is_json_object, object_variant
from ..functions.instants import iso_text
from ..schemas import DLQ_INVENTORY, DLQ_POS, EVENT_COLUMNS, FLUSH_RECORDS, FLUSH_SECONDS, TOPICS

ENVELOPE = "key string, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def kafka_options(servers: str, topics: Sequence[str] = tuple(TOPICS.values()), per_trigger: int | None = None,
                  flush_records: int = FLUSH_RECORDS, flush_seconds: int = FLUSH_SECONDS) -> dict[str, str]:
    """A batch is due when ``flush_records`` messages wait or the oldest has waited ``flush_seconds``, whichever is first.

    ``per_trigger`` limits the messages of a batch; without it a batch takes all there are.
    """
    if per_trigger is not None and per_trigger < flush_records:
        flush_records = per_trigger
    limit = {} if per_trigger is None else {"maxOffsetsPerTrigger": str(per_trigger)}
    return limit | {
        "minOffsetsPerTrigger": str(flush_records),
        "maxTriggerDelay": f"{flush_seconds}s",
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }


def read_kafka(spark: SparkSession, servers: str, topics: Sequence[str] = tuple(TOPICS.values()),
               per_trigger: int | None = None) -> DataFrame:
    """Stream of envelopes from Kafka; needs Spark's Kafka connector on the class path."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topics, per_trigger)).load()
    return stream.select(F.col("key").cast("string").alias("key"), "value", "topic", "partition", "offset", "timestamp")


def read_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of envelopes kept as Parquet files, e.g. an archive of a topic, with the ``_file`` each came from.

    ``files_per_trigger`` limits a batch.
    """
    reader = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withColumn("_file", F.col("_metadata.file_path"))


def decode(envelopes: DataFrame) -> DataFrame:
    """Adds ``text`` (the value as UTF-8, null when it is no UTF-8) and ``is_event`` (one JSON object)."""
    text = F.try_validate_utf8(F.col("value").cast("string"))
    return envelopes.withColumn("text", text).withColumn("is_event", is_json_object(F.col("text")))


def other_events(decoded: DataFrame, topics: Sequence[str], ingested_at: Column | None = None) -> DataFrame:
    """Events of all topics but these: the whole event as text, and the ingestion columns."""
    stamp = ingested_at if ingested_at is not None else F.current_timestamp()
    return decoded.where(F.col("is_event") & (F.col("topic").isNull() | ~F.col("topic").isin(list(topics)))).select(
        F.col("text").alias("_event_text"), object_variant(F.col("text")).alias("_event"), iso_text(stamp).alias("_ingestion_ts"), F.col("topic").alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"), F.col("offset").alias("_kafka_offset"))


def events_of(decoded: DataFrame, source: str, ingested_at: Column | None = None) -> DataFrame:
    """Raw rows of one source: business columns, nested parts as JSON text, the whole event beside them as text and parsed,
    so that fields without a column and values of another type are kept, and the ingestion columns."""
    event = F.from_json("text", EVENT_COLUMNS[source])
    stamp = ingested_at if ingested_at is not None else F.current_timestamp()
    return decoded.where("is_event").select(
        event.alias("_typed"), F.col("text").alias("_event_text"), object_variant(F.col("text")).alias("_event"), iso_text(stamp).alias("_ingestion_ts"), F.col("topic").alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"), F.col("offset").alias("_kafka_offset"),
    ).select("_typed.*", "_event_text", "_event", "_ingestion_ts", "_kafka_topic", "_kafka_partition", "_kafka_offset")


def dlq_topic(topic: Column) -> Column:
    """POS messages have their own dead-letter topic, everything else shares the inventory one."""
    return F.when(topic.contains("pos"), DLQ_POS).otherwise(DLQ_INVENTORY)


def dead_letters(decoded: DataFrame, error_ts: Column | None = None) -> DataFrame:
    """The messages that are no JSON object, whole: bytes that are no text are kept as hex."""
    raw = F.coalesce(F.col("text"), F.hex("value"), F.lit("None"))
    return decoded.where(~F.col("is_event")).select(
        dlq_topic(F.col("topic")).alias("dlq_topic"),
        F.col("topic").alias("original_topic"), F.col("partition").alias("original_partition"),
        F.col("offset").alias("original_offset"), F.col("key").alias("original_key"),
        iso_text(error_ts if error_ts is not None else F.current_timestamp()).alias("error_ts"),
        raw.alias("raw_value"),
    )
