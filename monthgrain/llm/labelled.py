"""Bounded samples of labelled documents, from rows that learning may see."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str = "doc_id") -> Column:
    """Whether learning may not see a row: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(id, text, label) of at most ``bound`` labelled documents that are not held out.

    The sample is drawn by hash of the id, so it is the same each time. Rows without id or label
    are left out; of several labels of an id the largest counts, of several texts each does. The
    sample of labels is broadcast: ``bound`` rows of two numbers, whatever the size of the table.
    """
    known = labels.where(f"doc_id IS NOT NULL AND `{label}` IS NOT NULL").where(~held_out())
    n = known.count()
    share = min(1.0, 1.2 * bound / max(1, n))
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    drawn = (
        known.where(spread < share)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"))
        .limit(bound)
    )
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "label")
