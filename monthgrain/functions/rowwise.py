"""Arithmetic across the columns of one row."""

from __future__ import annotations

from collections.abc import Sequence


def or_zero(value: str) -> str:
    return f"coalesce({value}, 0D)"


def null_safe_sum(values: Sequence[str]) -> str:
    """Sum that reads null as zero; no values at all give zero."""
    return "(" + " + ".join(["0D", *[or_zero(v) for v in values]]) + ")"


def strict_sum(values: Sequence[str], zero: str = "0D") -> str:
    """Sum that is null as soon as one value is null; no values at all give zero."""
    return "(" + " + ".join([zero, *values]) + ")"


def row_max(values: Sequence[str]) -> str:
    """Largest non-null value (``greatest`` itself wants at least two)."""
    return f"greatest({', '.join(values)})" if len(values) > 1 else values[0]


def row_min(values: Sequence[str]) -> str:
    """Smallest non-null value."""
    return f"least({', '.join(values)})" if len(values) > 1 else values[0]


def row_mean(values: Sequence[str]) -> str:
    """Mean of the non-null values; 0.0 when there are none."""
    filled = " + ".join(f"int({v} IS NOT NULL)" for v in values)
    return f"{null_safe_sum(values)} / greatest({filled}, 1)"


def share(part: str, total: str) -> str:
    """``part / total`` for a positive total, else 0.0."""
    return f"CASE WHEN {total} > 0 THEN try_divide(double({part}), {total}) ELSE 0D END"


def relative_change(recent: str, past: str) -> str:
    """``(recent - past) / past`` for a positive past.

    A past of zero gives the recent value; a missing or negative past gives 0.0.
    """
    return (
        f"CASE WHEN {past} > 0 THEN try_divide({recent} - {past}, {past}) "
        f"WHEN {past} = 0 AND {recent} <> 0 THEN {recent} ELSE 0D END"
    )


def ratio_or_null(part: str, whole: str) -> str:
    """``part / whole``; null for a zero or missing whole."""
    return f"try_divide({part}, {whole})"


def capped(value: str, limit: int, when_null: int) -> str:
    """Value cut at ``limit``, with nulls replaced first."""
    return f"least(coalesce({value}, {when_null}D), {limit}D)"


def clipped(value: str, limit: int) -> str:
    """Value cut at ``limit``; null stays null (``least`` would turn it into the limit)."""
    return f"CASE WHEN {value} > {limit} THEN {limit}D ELSE {value} END"
