"""Calendar months written as ``yyyyMM`` text, the partition key of every table."""

from __future__ import annotations

MONTH = "snapshot_date"


def month_number(snapshot: str) -> int:
    """``year * 12 + month`` of a ``yyyyMM`` text; raises on anything else."""
    if len(snapshot) != 6 or not snapshot.isdigit() or not 1 <= int(snapshot[4:]) <= 12:
        raise ValueError(f"not a yyyyMM month: {snapshot!r}")
    return int(snapshot[:4]) * 12 + int(snapshot[4:])


def month_text(number: int) -> str:
    """Inverse of :func:`month_number`."""
    year, month = divmod(number - 1, 12)
    return f"{year:04d}{month + 1:02d}"


def months_back(snapshot: str, count: int) -> list[str]:
    """``count`` months ending with ``snapshot``, newest first."""
    anchor = month_number(snapshot)
    return [month_text(anchor - back) for back in range(count)]


def _part(month: str, start: int, length: int) -> str:
    return f"int(substring({month}, {start}, {length}))"


def month_index(month: str) -> str:
    """:func:`month_number` as SQL text over a ``yyyyMM`` expression."""
    return f"({_part(month, 1, 4)} * 12 + {_part(month, 5, 2)})"


def month_start(month: str) -> str:
    """First day of a ``yyyyMM`` expression as a date."""
    return f"make_date({_part(month, 1, 4)}, {_part(month, 5, 2)}, 1)"


def month_end(month: str) -> str:
    """Last day of a ``yyyyMM`` expression as a date."""
    return f"last_day({month_start(month)})"
