"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import SparkSession

MIB = 1024 * 1024
ZONE = "spark.sql.session.timeZone"
SHREDDING = "spark.sql.variant.inferShreddingSchema"


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 * MIB, floor: int = 8) -> int:
    """Shuffle partitions so that one holds about ``target_bytes``; AQE merges the small ones afterwards."""
    return max(floor, math.ceil(input_bytes / target_bytes))


def get_spark(app: str = "tillflow", master: str | None = None, input_bytes: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    ``input_bytes`` is the size of the data a job reads; it sets the number of shuffle partitions.
    Extra settings use ``__`` for dots: ``get_spark(spark__ui__enabled="false")``.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "static",
        "spark.sql.parquet.compression.codec": "snappy",
        # looking up the Python line of every column expression costs more than building it
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # state of the streaming dedup lives off-heap and on disk, not in the executor heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(input_bytes))
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def utc(function):
    """A function of a session and more whose dates and hours are cut in UTC; the caller's zone is back when it returns."""
    @wraps(function)
    def run(spark: SparkSession, *args, **kwargs):
        zone = spark.conf.get(ZONE)
        if zone == "UTC":
            return function(spark, *args, **kwargs)
        spark.conf.set(ZONE, "UTC")
        try:
            return function(spark, *args, **kwargs)
        finally:
            spark.conf.set(ZONE, zone)
    return run


@contextmanager
def whole_variants(spark: SparkSession):
    """Writes inside keep a VARIANT as one value instead of spread over columns; the caller's setting is back afterwards.

    Layers copy whole events from table to table: spreading an event over columns and putting it together again for each copy
    costs more than reading its fields does.
    """
    before = spark.conf.get(SHREDDING)
    spark.conf.set(SHREDDING, "false")
    try:
        yield
    finally:
        spark.conf.set(SHREDDING, before)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="tillflow-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
