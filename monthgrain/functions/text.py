"""Quoting, header and text clean-up."""

from __future__ import annotations

import re

# Characters a column name may not keep, the empty time of day that
# date exports carry, and the text that stands for null.
NAME_BREAKERS = r"[ ,;{}()\n\t=]+"
MIDNIGHT = r"\b00:00:00\b"
NULL_TEXT = "(null)"


def ref(name: str) -> str:
    """Column reference that takes the name literally, dots and hyphens included."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """String literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(expression: str, name: str) -> str:
    return f"{expression} AS {ref(name)}"


def clean_name(name: str) -> str:
    """Lower-case column name with runs of awkward characters turned into ``_``."""
    parts = re.split(NAME_BREAKERS, name.lower())
    return "_".join(filter(None, parts)).strip("_")


def tidy_text(value: str) -> str:
    """Drop midnight stamps, read the null text as null, then trim.

    The null text is compared before trimming, so a padded one stays text.
    """
    return f"trim(nullif(regexp_replace({value}, {text(MIDNIGHT)}, ''), {text(NULL_TEXT)}))"
