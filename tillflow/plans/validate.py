"""Validation of one file or table on request."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import quality
from ..schemas import RAW
from ..sources import readers


def annotate_path(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Records of a ``.json`` file (one array or one object) or of ``.parquet`` raw rows with their ``errors``."""
    if path.endswith(".json"):
        named = quality.annotate_events(readers.read_any(spark, path), source, "record")
        return named.select(F.try_variant_get("record", "$.event_id", "string").alias("event_id"), "errors")
    if path.endswith(".parquet"):
        return quality.annotate_bronze(spark.read.schema(RAW[source]).parquet(path), source).select("event_id", "errors")
    raise ValueError(f"unsupported file format: {path} (.json or .parquet)")


def validate(spark: SparkSession, path: str, source: str, samples: int = 5) -> bool:
    """Prints the summary line and the first bad records; True when the pass rate reaches the threshold."""
    annotated = annotate_path(spark, path, source)
    r = quality.report(annotated, source).first()
    print(f"[{'PASS' if r.passed else 'FAIL'}] {source}: {r.valid_count}/{r.total_records} valid ({r.pass_rate:.1f}%)")
    if r.invalid_count:
        for bad in quality.error_samples(annotated, samples).collect():
            print(f"  {bad.event_id}: {bad.errors}")
    return r.passed
