"""Columns a source may lack, resolved to a fixed schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from monthgrain.functions.text import named, ref


def resolve(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """``df`` with a null column, of the declared type, for every column of the contract it lacks.

    Columns that are there stay as they are, declared or not, so the schema of what is built on
    them does not hinge on which columns a month's file happened to have.
    """
    there = {c.lower() for c in df.columns}
    absent = {c: kind for c, kind in contract.items() if c.lower() not in there}
    if not absent:
        return df
    return df.selectExpr("*", *[named(f"CAST(NULL AS {k})", c) for c, k in absent.items()])


def require(df: DataFrame, *names: str) -> DataFrame:
    """``df``; a column without which there is nothing to build is an error by name."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df
