"""Snapshot filter and stamp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.months import MONTH, month_number


def scan_snapshot(df: DataFrame, *snapshots: str) -> DataFrame:
    """Rows of the given months; a partition filter on tables partitioned by month."""
    for snapshot in snapshots:
        month_number(snapshot)
    return df.where(F.col(MONTH).isin(*snapshots))


def stamp_snapshot(df: DataFrame, snapshot: str) -> DataFrame:
    """Set the month of all rows."""
    month_number(snapshot)
    return df.withColumn(MONTH, F.lit(snapshot))


def require_snapshot(df: DataFrame, snapshot: str, what: str) -> DataFrame:
    """Rows of one month; no rows at all is an error. Reads at most one row to find out."""
    rows = scan_snapshot(df, snapshot)
    if rows.isEmpty():
        raise ValueError(f"{what} has no rows for {snapshot}")
    return rows


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows to look at."""
    return df.limit(rows)
