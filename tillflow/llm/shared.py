"""Small helpers of the operators: written intermediate tables, folds, words and slices of Arrow batches."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def staged(df: DataFrame, purpose: str, tidy: bool = False, codec: str | None = None) -> DataFrame:
    """The rows written below the shared folder and read again: lineage is cut, and lost executors cost no recomputation.

    ``tidy``: the write's shuffle files are removed when it has ended instead of when the driver next collects garbage.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, purpose)
    before = spark.conf.get(CLEANUP, None)
    if tidy:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        if tidy:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _STAGED[id(out)] = (out, path)
    return out


_STAGED: dict[int, tuple[DataFrame, str]] = {}


def discard(*tables: DataFrame) -> None:
    """Removes staged tables that nothing will read again."""
    for table in tables:
        _, path = _STAGED.pop(id(table))
        jvm, context = table.sparkSession._jvm, table.sparkSession.sparkContext
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def fold(column: str, parts: int, part: int) -> Column:
    """True where crc32 of the id as text leaves ``part``; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % parts == part, F.lit(False))


def ship(spark: SparkSession) -> None:
    """Gives executors this package where the session has not been told to (once a session)."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        package = Path(__file__).parents[1]
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='package-')}/{package.name}", "zip", package.parent, package.name))


_SHIPPED: set[str] = set()


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of ``column``, so that long texts do not add up in a task."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start = size = 0
        for i, n in enumerate(lengths.tolist()):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def total_bytes(df: DataFrame, column: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0
