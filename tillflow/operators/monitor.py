"""Pipeline health: consumer lag, layer counts, latency, schema drift."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import documents as D
from ..functions.instants import event_time
from ..schemas import CONTRACTS, LAG_OK, LAG_WARN, LATENCY_TARGET_SECONDS


def lag_report(end_offsets: DataFrame, committed: DataFrame) -> DataFrame:
    """Lag per topic; a partition nobody has read yet counts from offset 0."""
    lag = F.coalesce("end_offset", F.lit(0)) - F.coalesce("committed_offset", F.lit(0))
    topics = end_offsets.join(committed, ["topic", "partition"], "left").groupBy("topic").agg(
        F.sum(lag).alias("total_lag"), F.count("*").alias("partitions"))
    return topics.withColumn("status", F.when(F.col("total_lag") < LAG_OK, "OK")
                             .when(F.col("total_lag") < LAG_WARN, "WARN").otherwise("CRITICAL"))


def layer_counts(files: DataFrame) -> DataFrame:
    """Files and records per layer from one row per file with ``layer, file, records``; unreadable files count as files."""
    return files.groupBy("layer").agg(F.count("*").alias("file_count"), F.coalesce(F.sum("records"), F.lit(0)).alias("record_count"))


POINTS = (0.5, 0.95, 0.99)
#: Ranges that one pass of the selection tells apart.
RANGES = 4096


def latency_percentiles(bronze: DataFrame, by: str = "_kafka_topic", points: Sequence[float] = POINTS) -> DataFrame:
    """p50, p95 and p99 of the time from event to ingestion, in seconds: the least wait that this share of the rows does not exceed.

    Exact selection by counting: a pass counts the rows of the range that holds a rank in 4096 smaller ranges, the one that
    holds the rank is taken on, until it is one microsecond wide. Counts are combined before the exchange, so a topic's rows
    are never together; a few passes read two columns each, three for waits within a day.
    """
    spark = bronze.sparkSession
    micros = F.unix_micros(event_time(F.col("_ingestion_ts"))) - F.unix_micros(event_time(F.col("timestamp")))
    waits = bronze.select(F.col(by).alias("by"), micros.alias("wait")).where(F.col("wait").isNotNull())
    ends = waits.groupBy("by").agg(F.count("*").alias("measured"), F.min("wait").alias("low"), F.max("wait").alias("high")).collect()  # a row per topic
    sought = {(r["by"], p): (r.low, r.high - r.low + 1, max(1, math.ceil(p * r.measured))) for r in ends for p in points}
    while wide := {k: v for k, v in sought.items() if v[1] > 1}:
        rows = [(by_, p, low, -(-width // RANGES), width) for (by_, p), (low, width, _) in wide.items()]
        ranges = F.broadcast(spark.createDataFrame(rows, "by string, point double, low bigint, step bigint, width bigint"))
        inside = waits.join(ranges, waits["by"].eqNullSafe(ranges["by"])).where((F.col("wait") >= F.col("low")) & (F.col("wait") < F.col("low") + F.col("width")))
        counts = inside.groupBy(ranges["by"].alias("by"), "point", F.expr("(wait - low) div step").alias("range")).agg(F.count("*").alias("n"))
        sorted_counts = counts.groupBy("by", "point").agg(F.array_sort(F.collect_list(F.struct("range", "n"))).alias("counts"))
        for r in sorted_counts.collect():
            low, width, rank = sought[r["by"], r.point]
            step = -(-width // RANGES)
            for c in r.counts:  # at most RANGES
                if rank <= c.n:
                    break
                rank -= c.n
            sought[r["by"], r.point] = (low + c.range * step, min(step, width - c.range * step), rank)
    out = [(r["by"], r.measured, *(sought[r["by"], p][0] / 1_000_000 for p in points)) for r in ends]
    return spark.createDataFrame(out, f"`{by}` string, measured bigint, " + ", ".join(f"p{p * 100:g} double".replace(".", "_") for p in points))


def schema_drift(events: DataFrame, source: str, text: str = "value") -> DataFrame:
    """Fields seen in the events against the contract: field, expected and seen type, how many records, kind of drift.

    ``new_field`` is not in the contract, ``type_changed`` carries another JSON type, ``null_value`` an explicit null. Objects
    whose fields cannot be told apart, as they repeat names inside, are counted in a line of their own: field ``$``,
    ``unparsable``. ``text`` is JSON text, or a VARIANT column as raw rows hold it (null: unparsable).
    """
    expected = {f.path: f.kind for f in CONTRACTS[source] if "." not in f.path and "[]" not in f.path}
    if events.schema[text].dataType.typeName() == "variant":
        documents = events.select(F.col(text).alias("_document"), F.lit(True).alias("_is_object"))
    else:
        parsed = events.select(F.col(text).alias("_text"), D.event_variant(F.col(text)).alias("_document"))
        documents = parsed.select("_document", F.when(F.col("_document").isNotNull(), F.lit(True)).otherwise(D.is_json_object(F.col("_text"))).alias("_is_object"))
    seen_fields = F.expr("try_cast(_document as map<string, variant>)")
    none = F.when(F.col("_is_object"), F.expr("map('$', cast(null as variant))"))
    fields = documents.select(F.explode(F.coalesce(seen_fields, none)).alias("field", "_value"))
    codes = fields.groupBy("field", D.type_code(F.col("_value")).alias("_code")).agg(F.count("*").alias("n"))
    seen = codes.groupBy("field", D.json_type(F.col("_code")).alias("seen_type")).agg(F.sum("n").alias("records"))
    contract = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair])
    out = seen.withColumn("expected_type", F.try_element_at(contract, F.col("field")))
    same = (F.col("seen_type") == F.col("expected_type")) | (
        (F.col("seen_type") == "integer") & (F.col("expected_type") == "number"))
    drift = (F.when((F.col("field") == "$") & F.col("seen_type").isNull(), "unparsable").when(F.col("expected_type").isNull(), "new_field").when(F.col("seen_type") == "null", "null_value")
             .when(~same, "type_changed").otherwise("none"))
    return out.select("field", "expected_type", "seen_type", "records", drift.alias("drift"))


def health_report(lag: DataFrame | None = None, layers: DataFrame | None = None, pass_rates: DataFrame | None = None, latency: DataFrame | None = None) -> DataFrame:
    """All metrics of the pipeline in one table: ``metric, name, value, status``; what is None is left out.

    ``lag`` by topic, ``records`` and ``files`` by layer, ``pass_rate`` by source, ``latency_p95`` in seconds by topic.
    """
    parts = []
    if lag is not None:
        parts.append(lag.select(F.lit("lag").alias("metric"), F.col("topic").alias("name"), F.col("total_lag").cast("double").alias("value"), "status"))
    if layers is not None:
        for metric, column in (("files", "file_count"), ("records", "record_count")):
            empty = F.when(F.col("record_count") == 0, "EMPTY").otherwise("OK")
            parts.append(layers.select(F.lit(metric).alias("metric"), F.col("layer").alias("name"), F.col(column).cast("double").alias("value"), empty.alias("status")))
    if pass_rates is not None:
        passed = F.when(F.col("passed"), "OK").otherwise("FAIL")
        parts.append(pass_rates.select(F.lit("pass_rate").alias("metric"), F.col("source").alias("name"), F.col("pass_rate").alias("value"), passed.alias("status")))
    if latency is not None:
        status = F.when(F.col("p95") < LATENCY_TARGET_SECONDS, "OK").otherwise("LATE")
        parts.append(latency.select(F.lit("latency_p95").alias("metric"), F.col(latency.columns[0]).alias("name"), F.col("p95").alias("value"), status.alias("status")))
    return reduce(DataFrame.unionByName, parts)
