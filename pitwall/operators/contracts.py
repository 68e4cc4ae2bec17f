"""Schema and content contracts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns only known after the event.
POST_EVENT_COLUMNS = [
    "time", "points", "positionOrder", "position", "fastestLap", "fastestLapTime",
    "fastestLapSpeed", "rank", "statusId", "milliseconds",
]


def require_columns(df: DataFrame, needed: Iterable[str], what: str = "table") -> DataFrame:
    """Raise when a needed column is absent.  Reads the schema only."""
    absent = sorted(set(needed) - set(df.columns))
    if absent:
        raise ValueError(f"{what}: missing columns {absent}")
    return df


def require_no_null(df: DataFrame, column: str, what: str = "table") -> DataFrame:
    """Raise when a column has a NULL; the job stops at the first one found."""
    if not df.where(F.col(column).isNull()).limit(1).isEmpty():
        raise ValueError(f"{what}: column {column!r} has NULL values")
    return df


def leaking_columns(df: DataFrame, forbidden: Iterable[str] = POST_EVENT_COLUMNS) -> list[str]:
    return sorted(set(forbidden) & set(df.columns))


def require_no_leakage(df: DataFrame, forbidden: Iterable[str] = POST_EVENT_COLUMNS) -> DataFrame:
    found = leaking_columns(df, forbidden)
    if found:
        raise ValueError(f"post-event columns among the inputs: {found}")
    return df


def require_rows(df: DataFrame, what: str = "table") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint"))
