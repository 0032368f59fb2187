"""A listing of files as a table: names, sizes, change times and, from Parquet footers, row counts.

Spark's own readers leave out files without bytes, and counting rows by a scan touches every record. This data source lists
folders on the executors, one partition per few folders, and opens footers only when asked for counts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from fnmatch import fnmatch

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Folders the driver looks for before it leaves the rest of the walk to the tasks, and the most partitions it makes.
FOLDERS, PARTITIONS = 64, 1000
#: Rows of a batch.
BATCH = 1000
#: Bytes read of a file to tell its shape.
HEAD_BYTES = 1 << 16
SCHEMA = "file string, size_bytes bigint, modified timestamp, records bigint, shape string, problem string"
ARROW = pa.schema([("file", pa.string()), ("size_bytes", pa.int64()), ("modified", pa.timestamp("us", "UTC")), ("records", pa.int64()),
                   ("shape", pa.string()), ("problem", pa.string())])


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _hidden(name: str) -> bool:
    """What Spark's readers skip: names with a dot in front, and those with an underscore unless they are partitions."""
    return name.startswith(".") or name.startswith("_") and "=" not in name


@dataclass
class Part(InputPartition):
    """Folders to walk and single files, relative to the root."""
    folders: list[str] = field(default_factory=list)
    files: list[tuple[str, int, object]] = field(default_factory=list)


class Reader(DataSourceReader):
    def __init__(self, root: str, glob: str, footers: bool, heads: bool):
        self.root, self.glob, self.footers, self.heads = root.rstrip("/"), glob, footers, heads

    def _below(self, fs, base: str, folder: str, recursive: bool) -> Iterator:
        for info in fs.get_file_info(pyarrow.fs.FileSelector(f"{base}/{folder}" if folder else base, allow_not_found=True, recursive=recursive)):
            name = info.path[len(base):].lstrip("/")
            if not any(_hidden(part) for part in name.split("/")):
                yield name, info

    def partitions(self) -> list[Part]:
        fs, base = _open(self.root)
        base = base.rstrip("/")
        folders, files = [""], []
        while folders and len(folders) < FOLDERS:
            found = [x for folder in folders for x in self._below(fs, base, folder, False)]
            files += [(name, info.size, info.mtime) for name, info in found if info.type == pyarrow.fs.FileType.File]
            folders = [name for name, info in found if info.type == pyarrow.fs.FileType.Directory]
        step = -(-len(folders) // PARTITIONS) or 1
        parts = [Part(folders=folders[i:i + step]) for i in range(0, len(folders), step)]
        return parts + [Part(files=files[i:i + BATCH]) for i in range(0, len(files), BATCH)] or [Part()]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        fs, base = _open(self.root)
        base, rows = base.rstrip("/"), []
        walked = ((name, info.size, info.mtime) for folder in partition.folders for name, info in self._below(fs, base, folder, True)
                  if info.type == pyarrow.fs.FileType.File)
        for name, size, modified in (*partition.files, *walked):
            if fnmatch(name.rsplit("/", 1)[-1], self.glob):
                rows.append((f"{self.root}/{name}", size, modified, *self._inside(fs, f"{base}/{name}", size)))
            if len(rows) >= BATCH:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    def _inside(self, fs, path: str, size: int) -> tuple[int | None, str | None, str | None]:
        """Rows, shape and problem of a file."""
        footer = self.footers and path.endswith(".parquet")
        if not size or not (footer or self.heads):
            return None, None, "empty" if not size else None
        try:
            with fs.open_input_file(path) as file:
                if not footer:
                    return None, file.read(HEAD_BYTES).decode("utf-8", "replace"), None
                found = pyarrow.parquet.ParquetFile(file)
                return found.metadata.num_rows, ", ".join(f"{f.name} {f.type}" for f in found.schema_arrow), None
        except (pa.ArrowInvalid, OSError) as error:
            return None, None, f"unreadable: {str(error).splitlines()[0][:200]}"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)


class FileInventory(DataSource):
    """``spark.read.format("file_inventory")`` with the options ``path``, ``glob`` (of file names), ``footers`` and ``heads``."""

    @classmethod
    def name(cls) -> str:
        return "file_inventory"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], self.options.get("glob", "*"), *(self.options.get(o, "false").lower() == "true" for o in ("footers", "heads")))


def list_files(spark: SparkSession, path: str, glob: str = "*", footers: bool = False, heads: bool = False) -> DataFrame:
    """One row per file below ``path``, empty files included: ``file`` (below ``path`` as given), size, change time.

    With ``footers`` a Parquet file has its number of rows in ``records`` and its columns in ``shape``, or why not in ``problem``;
    with ``heads`` other files have their first 64 KB as text in ``shape``. Else no file is opened. A folder that is not there
    has no files.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package
    spark.dataSource.register(FileInventory)
    options = {"path": path, "glob": glob, "footers": str(footers).lower(), "heads": str(heads).lower()}
    return spark.read.format("file_inventory").options(**options).load()
