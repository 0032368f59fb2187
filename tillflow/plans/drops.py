"""Inventory files that stores drop: read, judged, staged or rejected, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import quality
from ..session import utc
from ..sources import inventory, readers, writers

#: One line per file handled: the verdict, and the load that took it.
VERDICTS = ("file string, size_bytes bigint, modified timestamp, reader string, total_records bigint, valid_count bigint, invalid_count bigint, "
            "pass_rate double, verdict string, reason string")
FILES_PER_LOAD = 10_000


def read_verdicts(spark: SparkSession, root: str) -> DataFrame | None:
    """The verdict of every file handled so far; None before the first load."""
    path = f"{root}/drops/_verdicts"
    return spark.read.schema(f"{VERDICTS}, load bigint").parquet(path) if readers.exists(spark, path) else None


def read_staged(spark: SparkSession, root: str) -> DataFrame:
    """The records of all accepted files: ``source, record`` (VARIANT), ``ingested_at``."""
    verdicts = read_verdicts(spark, root)
    last = 0 if verdicts is None else verdicts.agg(F.max("load")).first()[0] or 0
    lines = spark.read.schema("value string, load bigint").text(f"{root}/bronze-staging/inventory").where(F.col("load") <= last)
    return lines.select(F.from_json("value", "source string, record variant, ingested_at timestamp").alias("r")).select("r.*")


@utc
def run_drops(spark: SparkSession, root: str, path: str, files_per_load: int = FILES_PER_LOAD) -> dict[str, int]:
    """Takes the files below ``path`` that no load has taken: counts of files by verdict, and of staged records.

    A changed file (another size or time) is a new one. Records are read once and kept as they are read; verdicts, staging
    and the list of rejected files come from that table. The verdicts, appended last, commit a load.
    """
    done = {"accept": 0, "reject": 0, "skip": 0, "staged_records": 0}
    while files := _new_files(spark, root, path, files_per_load):
        known = read_verdicts(spark, root)
        load = 1 + (0 if known is None else known.agg(F.max("load")).first()[0] or 0)
        kept = f"{root}/drops/records/load={load}"
        records = readers.read_drops(spark, files)
        records.select(readers.plain_path("file").alias("file"), "record").write.mode("overwrite").parquet(kept)
        records = spark.read.schema("file string, record variant").parquet(kept)
        listed = spark.createDataFrame([(f.file, f.size_bytes, f.modified, f.problem) for f in files], "file string, size_bytes bigint, modified timestamp, problem string")
        listed = listed.withColumn("name", F.col("file")).withColumn("file", readers.plain_path("file"))
        verdicts = quality.judge_drops(listed.drop("name"), records)
        judged = spark.createDataFrame(verdicts.collect(), VERDICTS)  # one row per file of this load
        staged = quality.accepted_records(records, judged)
        writers.stage_drop(staged, f"{root}/bronze-staging/inventory/load={load}")
        quality.rejected_files(judged).write.mode("overwrite").json(f"{root}/rejected/inventory/load={load}")
        judged.withColumn("load", F.lit(load).cast("bigint")).coalesce(1).write.mode("append").parquet(f"{root}/drops/_verdicts")
        for r in judged.groupBy("verdict").agg(F.count("*").alias("files"), F.sum("total_records").alias("records")).collect():
            done[r.verdict] += r.files
            done["staged_records"] += r.records if r.verdict == "accept" else 0
        if len(files) < files_per_load:
            break
    return done


def _new_files(spark: SparkSession, root: str, path: str, most: int) -> list:
    listed = inventory.list_files(spark, path, footers=True, heads=True)
    known = read_verdicts(spark, root)
    if known is not None:
        same = known.select(F.col("file").alias("_plain"), "size_bytes", "modified")
        listed = listed.withColumn("_plain", readers.plain_path("file")).join(same, ["_plain", "size_bytes", "modified"], "left_anti").drop("_plain")
    return listed.orderBy("modified", "file").limit(most).collect()
