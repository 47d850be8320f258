"""Statistics across the months of an attached history."""

from __future__ import annotations

from monthgrain.functions.rowwise import relative_change, row_max, row_mean, row_min
from monthgrain.functions.text import named, ref
from monthgrain.operators.history import lag_name

SPANS = (3, 6)

# How output names call lags 0 to 5.
LAG_TAGS = ("lm", "lm2", "lm3", "lm4", "lm5", "lm6")


def lag_refs(name: str, span: int) -> list[str]:
    """The newest ``span`` months of ``name``."""
    return [ref(lag_name(name, lag)) for lag in range(span)]


def span_stats(source: str, stem: str) -> list[str]:
    """``max_<stem>_lm3 … mean_<stem>_lm6`` over the months of ``source``."""
    out = []
    for span in SPANS:
        months = lag_refs(source, span)
        out += [
            named(row_max(months), f"max_{stem}_lm{span}"),
            named(row_min(months), f"min_{stem}_lm{span}"),
            named(row_mean(months), f"mean_{stem}_lm{span}"),
        ]
    return out


def change_between(source: str, stem: str, recent: int, past: int) -> str:
    """``<stem>_<recent tag>_<past tag>_diff``: relative change between two lags."""
    months = lag_refs(source, past + 1)
    name = f"{stem}_{LAG_TAGS[recent]}_{LAG_TAGS[past]}_diff"
    return named(relative_change(months[recent], months[past]), name)
