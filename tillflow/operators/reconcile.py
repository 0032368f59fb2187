"""Expected against landed counts, and missing or repeated files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import BYTES_PER_RECORD, VARIANCE_OK, VARIANCE_WARN


def estimated_records(files: DataFrame) -> DataFrame:
    """A listing with record counts guessed from file sizes, where no footer should be read; usable like counted ones."""
    return files.withColumn("records", F.floor(F.col("size_bytes") / BYTES_PER_RECORD).cast("long"))


def reconcile(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Report per ``date_prefix`` that is expected or has landed; what nobody expected is measured against 0.

    ``files`` has one row per file (``date_prefix, file, records``); ``expected`` has ``date_prefix, expected_count``.
    """
    actual = files.groupBy("date_prefix").agg(F.sum("records").alias("actual_count"), F.count("file").alias("blob_count"))
    joined = expected.join(actual, "date_prefix", "full").na.fill(0, ["expected_count", "actual_count", "blob_count"])
    off = F.abs(F.col("actual_count") - F.col("expected_count")) / F.greatest(F.col("expected_count"), F.lit(1)) * 100
    status = (F.when(F.col("_off") < VARIANCE_OK, "OK").when(F.col("_off") < VARIANCE_WARN, "WARN").otherwise("FAIL"))
    return joined.withColumn("_off", off).select(
        "date_prefix", "expected_count", "actual_count", F.round("_off", 2).alias("variance_pct"),
        status.alias("status"), "blob_count")


def file_details(files: DataFrame, report: DataFrame) -> DataFrame:
    """The files behind each line of a report: ``date_prefix, status, file, size_bytes, records``; a line without files has none."""
    return report.select("date_prefix", "status").join(files.select("date_prefix", "file", "size_bytes", "records"), "date_prefix")


def content_sums(records: DataFrame, file: Column, columns: list[str]) -> DataFrame:
    """Order-free checksum per file: row count and sum of row hashes, combined before the exchange."""
    row = F.xxhash64(*columns).cast("decimal(20,0)")
    return records.groupBy(file.alias("file")).agg(F.count("*").alias("records"), F.sum(row).alias("checksum"))


def file_issues(listed: DataFrame, expected: DataFrame) -> DataFrame:
    """Files that are expected but not there, and files whose content is there more than once.

    ``listed`` has ``file, records, checksum``; ``expected`` has ``file``.
    """
    missing = expected.join(listed, "file", "left_anti").select(
        "file", F.lit("missing").alias("issue"), F.lit(0).cast("long").alias("copies"))
    repeated = listed.groupBy("records", "checksum").agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
    duplicate = listed.join(repeated, ["records", "checksum"]).select("file", F.lit("duplicate").alias("issue"), "copies")
    return missing.unionByName(duplicate)
