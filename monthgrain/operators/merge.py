"""Keyed merge of a new version of some rows into the stored ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.functions.text import ref


def merge_by_key(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows, and the stored ones whose key is not among them.

    Columns that only one side has are null on the other.
    """
    replaced = incoming.selectExpr(*[ref(k) for k in keys])
    kept = stored.join(replaced, list(keys), "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or are null in part, with their row count."""
    some_null = " OR ".join(f"{ref(k)} IS NULL" for k in keys)
    counted = df.selectExpr(*[ref(k) for k in keys]).groupBy(*keys).count()
    return counted.where(f"count > 1 OR {some_null}")


def broken_keys(df: DataFrame, keys: Sequence[str], month: str) -> DataFrame:
    """Each month of ``df``, and one of its keys that is null or repeated, or null.

    One pass: rows are counted by key before they move, then by month.
    """
    some_null = " OR ".join(f"{ref(k)} IS NULL" for k in keys)
    parts = ", ".join(ref(k) for k in keys)
    counted = df.selectExpr(*[ref(k) for k in keys]).groupBy(*keys).count()
    return counted.groupBy(month).agg(
        F.expr(f"min(CASE WHEN count > 1 OR {some_null} THEN struct({parts}, count) END) AS broken")
    )
