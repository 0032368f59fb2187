"""Raw rows to bronze: lineage columns and the split on required fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fingerprint import record_hash
from ..functions.instants import event_time, iso_text
from ..schemas import REQUIRED

MISSING_REQUIRED = "missing_required_field"


def add_metadata(df: DataFrame, source: str, loaded_at: Column | None = None) -> DataFrame:
    """Load time, source name, record fingerprint and the calendar columns of the event.

    Date and hour come from one parsed timestamp, so both are UTC; unparsable text gives null in both.
    """
    business = [c for c in df.columns if not c.startswith("_")]
    stamped = df.withColumn("_event_time", event_time(F.col("timestamp")))
    return stamped.withColumns({
        "_bronze_loaded_at": loaded_at if loaded_at is not None else iso_text(F.current_timestamp()),
        "_source_name": F.lit(source),
        "_record_hash": record_hash(business),
        "event_date": F.to_date("_event_time"),
        "event_hour": F.hour("_event_time"),
    }).drop("_event_time")


def missing_fields(df: DataFrame, source: str) -> Column:
    """Names of the required fields a row lacks. A column the data does not have is missing in every row."""
    return F.array_compact(F.array(*[
        F.when(F.col(f"`{name}`").isNull(), F.lit(name)) if name in df.columns else F.lit(name)
        for name in REQUIRED[source]
    ]))


def lacks_required(df: DataFrame, source: str) -> Column:
    checks = [F.col(f"`{name}`").isNull() if name in df.columns else F.lit(True) for name in REQUIRED[source]]
    verdict = checks[0]
    for check in checks[1:]:
        verdict = verdict | check
    return verdict


def flag_required(df: DataFrame, source: str) -> DataFrame:
    """All rows with ``valid`` and, where a required field lacks, the error and the names of the missing fields."""
    bad = lacks_required(df, source)
    return df.withColumns({"valid": ~bad, "_validation_error": F.when(bad, F.lit(MISSING_REQUIRED)),
                           "_missing_fields": F.when(bad, F.array_join(missing_fields(df, source), ","))})


def split_required(df: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows for quarantine with the error and the names of the missing fields).

    Both filters are plain null tests, so they reach the Parquet scan.
    """
    bad = lacks_required(df, source)
    quarantine = df.where(bad).withColumns({
        "_validation_error": F.lit(MISSING_REQUIRED),
        "_missing_fields": F.array_join(missing_fields(df, source), ","),
    })
    return df.where(~bad), quarantine
