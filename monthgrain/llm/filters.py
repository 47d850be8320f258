"""A filter that tells which rows may meet a row of a plain table, so that the others need not move."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.llm.exact import MOST_SENT


def may_meet(rows: DataFrame, others: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those that may find their ``key`` in ``others``, and those that cannot.

    ``others`` is a plain table. A filter of sixteen bits for each of its rows or more is sent
    to all tasks (of ``MOST_SENT`` bits at most, 64 MB; keys it cannot tell apart only leave more
    rows in the first part). Null keys are like others: they may be in the first part.
    """
    bits = min(MOST_SENT, max(1 << 10, 1 << (16 * others.count()).bit_length()))
    spot = f"pmod(xxhash64(`{key}`), {bits}L)"
    words = others.groupBy(F.expr(f"{spot} div 64 AS __word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast({spot} % 64 AS int))) AS __mask")
    )
    marked = rows.join(F.broadcast(words), F.expr(f"{spot} div 64 = __word"), "left").select(
        *[F.col(f"`{c}`") for c in rows.columns],
        F.expr(f"coalesce(getbit(__mask, cast({spot} % 64 AS int)) = 1, false) AS __maybe"),
    )
    return marked.where("__maybe").drop("__maybe"), marked.where("NOT __maybe").drop("__maybe")
