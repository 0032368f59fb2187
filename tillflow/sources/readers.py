"""Batch scans. Every read carries an explicit schema; nothing is inferred from the first file."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from csv import reader
from functools import reduce
from json import loads

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.documents import event_variant, whole_variant
from ..schemas import BRONZE, INGEST_COLUMNS, RAW, SILVER, TOPICS, WHOLE_EVENT, ddl
from . import inventory


def or_none(read, *args, **kwargs) -> DataFrame | None:
    """The scan, or None when its path does not exist; any other error is raised."""
    try:
        return read(*args, **kwargs)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of this name."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(name)


def raw_schema(source: str) -> str:
    return f"{RAW[source]}, {WHOLE_EVENT}"


def read_raw(spark: SparkSession, root: str, source: str) -> DataFrame:
    """Landed raw rows of one source with their whole event, whatever folder layout is below the topic."""
    return (spark.read.schema(raw_schema(source)).option("recursiveFileLookup", "true")
            .parquet(f"{root}/{TOPICS[source]}"))


def read_all_raw(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    found = {source: or_none(read_raw, spark, root, source) for source in TOPICS}
    return {source: df for source, df in found.items() if df is not None}


def read_other_raw(spark: SparkSession, root: str) -> DataFrame:
    """Landed events of topics that are no source, by topic; their fields are read with ``try_variant_get``."""
    return spark.read.schema(f"{WHOLE_EVENT}, {INGEST_COLUMNS}").option("recursiveFileLookup", "true").parquet(f"{root}/raw_other")


MANIFEST = "file string, size_bytes bigint, modified timestamp, records bigint, load bigint, valid bigint, invalid bigint, loaded_at timestamp"


def read_manifest(spark: SparkSession, root: str, source: str) -> DataFrame | None:
    """The raw files that bronze has taken, each with its load and the load's counts; None before the first load."""
    path = f"{root}/_manifest/{source}"
    return spark.read.schema(MANIFEST).parquet(path) if exists(spark, path) else None


def committed_load(spark: SparkSession, root: str, source: str) -> int:
    """Number of the newest load that is whole, 0 before the first one."""
    done = read_manifest(spark, root, source)
    return 0 if done is None else done.agg(F.max("load")).first()[0] or 0


def _loads(spark: SparkSession, root: str, source: str, more: str = "") -> DataFrame:
    rows = spark.read.schema(f"{BRONZE[source]}, {WHOLE_EVENT}, {more}load bigint, valid boolean").parquet(f"{root}/bronze_{source}")
    return rows.where(F.col("load") <= committed_load(spark, root, source))


def read_bronze(spark: SparkSession, root: str, source: str, keep: Sequence[str] = ()) -> DataFrame:
    """The valid rows of all whole loads."""
    rows = _loads(spark, root, source).where("valid").drop("valid")
    return rows if "load" in keep else rows.drop("load")


def read_quarantine(spark: SparkSession, root: str, layer: str, source: str) -> DataFrame:
    """The rows that ``layer`` (bronze or silver) refused, with ``_validation_error``; of bronze also ``_missing_fields``.

    ``root`` is the folder of the layer's tables.
    """
    if layer == "bronze":
        return _loads(spark, root, source, "_validation_error string, _missing_fields string, ").where("NOT valid").drop("valid")
    from . import versioned
    rows = versioned.read(spark, f"{root}/silver_{source}", f"{ddl(SILVER[source])}, _validation_error string, valid boolean")
    return rows.where("NOT valid").drop("valid")


def read_silver(spark: SparkSession, root: str, source: str, days: Iterable[str] | None = None) -> DataFrame:
    """The current valid rows, of some days or all."""
    from . import versioned
    return versioned.read(spark, f"{root}/silver_{source}", f"{ddl(SILVER[source])}, valid boolean", days).where("valid").drop("valid")


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    from . import versioned
    return versioned.read(spark, f"{root}/{name}")


def read_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The records of JSON files that hold one value each, an array or an object, as ``file, record`` (VARIANT).

    Such a file is read by one task. A file that is not exactly one JSON value has one row with a null record.
    """
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), whole_variant(F.col("value")).alias("v"))
    many = F.expr("coalesce(try_variant_get(v, '$', 'array<variant>'), array(v))")
    return whole.select("file", F.explode_outer(many).alias("record"))


def read_any(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A ``.json`` file (one array or one object, as ``record``) or ``.parquet`` rows, for validation on request."""
    if path.endswith(".json"):
        return read_documents(spark, path).select("record")
    if path.endswith(".parquet"):
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    raise ValueError(f"unsupported file format: {path} (.json or .parquet)")


def read_drops(spark: SparkSession, files: Sequence) -> DataFrame:
    """All records of dropped files as ``file, record`` (VARIANT with every field a record has).

    ``files`` are rows of ``inventory.list_files`` with footers and heads, as many as one load takes. A file's shape decides
    how it is read: JSON starting with an array or with an object over several lines is one value, else one record per line;
    CSV files are read in one scan, each row named by its own file's header; Parquet files are read by their columns and types.
    A line that is no JSON object is a record without fields; files that cannot be read or are empty have none.
    """
    parts = []
    usable = [f for f in files if f.size_bytes and f.problem is None]
    json = [f for f in usable if f.file.endswith(".json")]
    whole = [f.file for f in json if _is_one_value(f.shape)]
    if whole:
        parts.append(read_documents(spark, whole).where("record IS NOT NULL"))
    if lines := [f.file for f in json if not _is_one_value(f.shape)]:
        text = spark.read.text(lines).where(F.col("value").rlike(r"\S"))
        record = F.coalesce(event_variant(F.col("value")), F.parse_json(F.lit("{}")))
        parts.append(text.select(F.col("_metadata.file_path").alias("file"), record.alias("record")))
    if csv := [f for f in usable if f.file.endswith(".csv")]:
        parts.append(_csv_records(spark, csv))
    shapes: dict[str, list[str]] = {}
    for f in usable:
        if f.file.endswith(".parquet"):
            shapes.setdefault(f.shape, []).append(f.file)
    for same in shapes.values():
        rows = spark.read.parquet(*same)
        fields = F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
        parts.append(rows.select(F.col("_metadata.file_path").alias("file"), fields.alias("record")))
    if not parts:
        return spark.createDataFrame([], "file string, record variant")
    return reduce(DataFrame.unionByName, parts)


def _is_one_value(head: str) -> bool:
    """Whether a JSON file is one value: it starts with an array, or its first line is not an object by itself."""
    first, more, _ = head.lstrip().partition("\n")
    if not first.startswith("{"):
        return True
    if not more:
        return False
    try:
        return not isinstance(loads(first), dict)
    except ValueError:
        return True


def _csv_records(spark: SparkSession, files: Sequence) -> DataFrame:
    """CSV rows as records of text fields; blank fields are left out, like fields a short row does not have."""
    heads = {f.file: next(reader([f.shape.lstrip("\ufeff").splitlines()[0]]), []) if f.shape.strip() else [] for f in files}
    width = max(map(len, heads.values()))
    columns = [f"c{i}" for i in range(max(width, 1))]
    rows = spark.read.schema(", ".join(f"{c} string" for c in columns)).option("header", "true").option("enforceSchema", "true").option(
        "multiLine", "true").option("mode", "PERMISSIVE").csv(list(heads)).select("*", plain_path("_metadata.file_path").alias("file"))
    names = spark.createDataFrame([(_without_scheme(f), h) for f, h in heads.items()], "file string, names array<string>")
    pairs = F.arrays_zip(F.col("names").alias("key"), F.slice(F.array(*columns), 1, F.size("names")).alias("value"))
    pairs = F.filter(pairs, lambda p: p["value"].rlike(r"\S") & p["key"].isNotNull())
    fields = F.map_from_entries(F.array_distinct(pairs))
    return rows.join(names, "file").select(F.col("file"), F.to_variant_object(fields).alias("record"))


def plain_path(column: str) -> Column:
    """A local path without its scheme, other paths as they are, so that listings and Spark's ``file_path`` name a file alike."""
    return F.regexp_replace(column, "^file:/+", "/")


def _without_scheme(path: str) -> str:
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Names, sizes and change times of the files below a folder, empty files included; no file is opened."""
    return inventory.list_files(spark, path, glob).select("file", "size_bytes", "modified")


def count_by_file(spark: SparkSession, path: str, prefix: Column) -> DataFrame:
    """Exact records per landed Parquet file, from its footer, with the date prefix taken from its path."""
    return inventory.list_files(spark, path, "*.parquet", footers=True).withColumn("date_prefix", prefix).select(
        "file", "size_bytes", F.coalesce("records", F.lit(0)).alias("records"), "date_prefix")


def layer_files(spark: SparkSession, root: str, layers: Sequence[str]) -> DataFrame:
    """The Parquet files that make up every layer now: ``layer, file, records``, counts from footers.

    Files of earlier versions and of loads that did not end are left out.
    """
    from . import versioned
    parts = [inventory.list_files(spark, f"{root}/{layer}", "*.parquet", footers=True).withColumn("layer", F.lit(layer)) for layer in layers]
    files = reduce(DataFrame.unionByName, parts).withColumns({
        "table": F.regexp_extract("file", r"^(.*)/(?:run|load|version)=\d+/", 1), "number": F.regexp_extract("file", r"/(?:run|load|version)=(\d+)/", 1).try_cast("bigint"),
        "day": F.regexp_replace(F.regexp_extract("file", r"/event_date=([^/]*)/", 1), "^__HIVE_DEFAULT_PARTITION__$", "")})
    tables = [r.table for r in files.select("table").distinct().collect() if r.table]  # a handful
    now = [(t, d, n) for t in tables for d, n in versioned.state(spark, t).days.items()]
    loads = [(t, committed_load(spark, t.rsplit("/", 1)[0], t.rsplit("/bronze_", 1)[1])) for t in tables if "/bronze_" in t]
    for t in tables:  # of a dimension the newest version that a run has ended with
        if exists(spark, f"{t}/_runs"):
            now.append((t, versioned.NO_DAY, spark.read.schema("version int").parquet(f"{t}/_runs").agg(F.max("version")).first()[0]))
    current = spark.createDataFrame(now, "table string, day string, current bigint")
    done = spark.createDataFrame(loads, "table string, done bigint")
    dated = F.when(F.col("day") == "", F.lit(versioned.NO_DAY)).otherwise(F.col("day"))
    kept = files.withColumn("day", dated).join(current, ["table", "day"], "left").join(done, "table", "left")
    return kept.where((F.col("table") == "") | (F.col("number") == F.col("current")) | (F.col("number") <= F.col("done"))).select("layer", "file", "records")


def read_pages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All landed product pages ``{"page": n, "data": [...]}`` as one product per row (``page, record``).

    An empty page ends a feed for the client that fetches it; what has landed, of this run or of later ones, is all read. A
    line that is no page is a record as it stands, which no contract accepts.
    """
    pages = spark.read.schema("page int, data array<string>, _broken string").option("columnNameOfCorruptRecord", "_broken").option(
        "recursiveFileLookup", "true").json(path)
    records = F.when(F.col("_broken").isNotNull(), F.array("_broken")).otherwise(F.col("data"))
    return pages.select("page", F.explode(records).alias("record"))
