"""Exact percentiles by weighted selection: no task holds the distinct values.

Rows become values with their counts. A pass cuts the range that holds the wanted rank into
cells and sums the counts of each; the cell that holds the rank is the next range. What reaches
the driver are the sums of ``CELLS`` cells a pass. Cells are cut by the values' distribution, at
approximate quantiles, so that a pass leaves about one in ``CELLS`` of the counted rows however
the values are spread; a range of one value ends the search.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.functions.text import ref

CELLS = 32


def exact_percentile(df: DataFrame, column: str, share: float = 0.5) -> float | None:
    """The least value that at least ``share`` of the non-null values do not exceed.

    The same as ``percentile_disc``: a value that occurs, the lower one of two middle ones.
    None where there are no values. Runs its passes when it is called. NaN counts as larger
    than all other values.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    value = F.col(ref(column)).cast("double").alias("value")
    counts = df.select(value).where("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("n"))
    counts = counts.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else counts
    rank = None
    while True:
        cuts = F.percentile_approx("value", [k / CELLS for k in range(1, CELLS)], 10 * CELLS)
        told = counts.agg(F.sum("n"), F.min("value"), F.max("value"), cuts).first()
        total, low, high, bounds = told
        if not total:
            return None
        rank = math.ceil(share * total) if rank is None else rank
        if low == high or math.isnan(low):
            return low
        bounds = sorted({b for b in bounds if not math.isnan(b) and not b >= high})
        if not bounds:
            bounds = [low]
        cell = F.size(F.filter(F.lit(bounds), lambda bound: F.col("value") > bound))
        sums = counts.groupBy(cell.alias("cell")).agg(F.sum("n")).collect()
        for k, n in sorted(map(tuple, sums)):
            if rank <= n:
                break
            rank -= n
        # cell k holds values above bounds[k - 1] and up to bounds[k]
        if k > 0:
            counts = counts.where(F.col("value") > F.lit(bounds[k - 1]))
        if k < len(bounds):
            counts = counts.where(F.col("value") <= F.lit(bounds[k]))
