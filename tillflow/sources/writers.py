"""Table sinks. A write returns its row count, observed on the way instead of by a second scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..session import MIB, whole_variants

#: Of tables whose rows are whole events. A writer holds a row group in the heap, a reader the chunk of a column in it.
ROW_GROUP_BYTES = 32 * MIB


def write_table(df: DataFrame, path: str, mode: str, partition_by: Sequence[str] = (), sort: Sequence[str] = ()) -> int:
    """Writes Parquet and returns the number of rows.

    Rows are rebalanced on the partition columns first: small partitions share a task and so a file, and a partition
    with a large part of the rows is split over several tasks by AQE instead of ending in one. ``sort`` orders the rows
    inside a task, so that the statistics of a file's row groups are narrow.
    """
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    if sort:
        out = out.sortWithinPartitions(*partition_by, *sort)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with whole_variants(df.sparkSession):
        writer.parquet(path)
    return seen.get.get("rows", 0)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that the caller has written for itself."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(name, True)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def stage_drop(records: DataFrame, path: str) -> None:
    """Accepted drop records (``file, record``) as JSON lines with the file they came from and the time they were staged."""
    line = F.to_json(F.struct(F.col("file").alias("source"), F.col("record"), F.current_timestamp().alias("ingested_at")))
    records.select(line.alias("value")).write.mode("overwrite").text(path)
