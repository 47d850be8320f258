"""Exact dedup: two passes with a Bloom filter of positions hit twice.

Only built-in expressions. The first pass hashes each text to a few positions and counts hits
per position; positions hit at least twice form the filter. The second pass tests every row:
rows with a position hit once have no equal and pass straight through. Only the others are
shuffled, as 32-byte digests, never as texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthgrain.llm.scratch import stored


#: The largest filter that is broadcast, in bits.
MOST_SENT = 1 << 28


def _positions(text: Column, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(text, F.lit(k)), F.lit(bits)) for k in range(hashes)]


def repeated_positions(texts: DataFrame, bits: int, hashes: int) -> DataFrame:
    """Filter words (word, mask): 64 positions each, a bit set where two rows or more hit it."""
    hit = texts.select(F.explode(F.array(*_positions(F.col("text"), bits, hashes))).alias("at"))
    twice = hit.groupBy("at").agg(F.count("*").alias("n")).where("n > 1")
    return twice.groupBy(F.expr("at div 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("mask")
    )


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int | None = None,
    hashes: int = 2,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. The row with the largest id of a
    group stays (null ids sort lowest); repeated rows of that id are all marked kept, being the
    same document. Other columns are ignored; an empty table gives an empty result.

    ``bits`` is the size of the filter, eight times the number of rows or more unless it is
    given; with fewer the result is the same and more digests move. A filter of up to
    ``MOST_SENT`` bits is broadcast (16 bytes for 64 of them: 64 MB), a larger one is joined.
    """
    if bits is None:
        bits = max(1 << 20, 1 << (8 * docs.count()).bit_length())
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    words = stored(repeated_positions(rows, bits, hashes), "bloom")
    seen = rows.select(
        "id",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        *[p.alias(f"p{k}") for k, p in enumerate(_positions(F.col("text"), bits, hashes))],
    )
    maybe = F.lit(True)
    for k in range(hashes):
        side = words.select(F.col("word").alias(f"word{k}"), F.col("mask").alias(f"mask{k}"))
        side = F.broadcast(side) if bits <= MOST_SENT else side
        seen = seen.join(side, F.expr(f"p{k} div 64") == F.col(f"word{k}"), "left")
        maybe = maybe & F.expr(f"coalesce(getbit(mask{k}, cast(p{k} % 64 as int)) = 1, false)")
    seen = stored(seen.select("id", "digest", maybe.alias("maybe")), "digests")

    shared = seen.where("maybe")
    groups = stored(
        shared.groupBy("digest").agg(F.max("id").alias("keep"), F.count("*").alias("n")), "groups"
    )
    # both sides are plain tables, so adaptive skew joins may split the rows of a hot digest
    grouped = shared.join(groups, "digest").select("id", "keep", "n", "digest")
    alone = seen.where("NOT maybe").select(
        "id", F.col("id").alias("keep"), F.lit(1).cast("long").alias("n"), "digest"
    )
    return alone.unionByName(grouped).select(
        F.col("id").alias(id_col),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
