"""Fingerprint of a record over its business columns only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def record_hash(columns: Sequence[str]) -> Column:
    """md5 of the row's JSON in a fixed column order; nulls are written, so absent and null values do not collide.

    Ingestion columns are left out by the caller: a message delivered twice keeps its fingerprint.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in columns])
    return F.md5(F.to_json(row, {"ignoreNullFields": "false"}))
