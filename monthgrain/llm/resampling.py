"""Importance resampling towards a target: documents are drawn whose n-grams look like the target's.

Features are runs of one to three words; each has one of ``BUCKETS`` buckets by its crc32. The
gain of a bucket is the log ratio of its smoothed shares in target and corpus, in thousandths
and rounded down; the weight of a document is the sum of its features' gains.

Weights come from bit planes. Plane p of a document has a bit per bucket: bit p of the bucket's
count. Plane q of the gains has bit q of their absolute values, split by sign. Then the weight is
the sum of 2^(p+q) times popcount(plane p & positive plane q) less the same with the negative
ones. All is integer arithmetic, so results do not depend on an order of additions.

The draw adds Gumbel noise made from a hash of the id, so that the highest scores are a sample
without replacement. Ranks come from a range partitioning by score: no task sees all rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrain.llm.scratch import stored

BUCKETS = 10_000
#: Longest run of words, share of the documents drawn (in percent), least words of one drawn.
LONGEST, PERCENT, LEAST_WORDS, SEED = 3, 5, 20, 42
_WORDS_OF_64 = (BUCKETS + 63) // 64
#: Letters and digits as they are, A to Z lower, all other bytes below 128 a space.
_TO_WORDS = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
    for c in range(256)
)
#: Bytes of text whose words are held at once.
_PIECE = 1 << 22


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a few megabytes at a time."""
    at, rest = 0, b""
    while at < len(text):
        part = rest + text[at : at + _PIECE].translate(_TO_WORDS)
        at += _PIECE
        end = len(part) if at >= len(text) else part.rfind(b" ") + 1
        rest = part[end:]
        yield part[:end].split()


def features(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words, and the buckets of all features, of a text in UTF-8, piece by piece."""
    before: list[bytes] = []  # a run may begin with the last words of the piece before
    for new in _pieces(text):
        words = before + new
        spaced, runs = [b" " + w for w in words], list(map(zlib.crc32, words))
        found = [runs[len(before) :]]
        for length in range(2, LONGEST + 1):
            runs = list(map(zlib.crc32, spaced[length - 1 :], runs))
            found.append(runs[max(0, len(before) - length + 1) :])
        yield len(new), np.array(sum(found, []), np.uint32) % np.uint32(BUCKETS)
        before = words[1 - LONGEST :]


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts each bucket has. Null texts have none.

    Tasks add up their texts and pass on a row per bucket; what reaches the driver are
    ``BUCKETS`` numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros(BUCKETS, np.int64), []
        for batch in batches:
            for text in batch.column(0):
                for _, found in features(text.as_py() or b""):
                    held.append(found)
                    if len(held) >= 256:
                        total += np.bincount(np.concatenate(held), minlength=BUCKETS)
                        held.clear()
        for found in held:
            total += np.bincount(found, minlength=BUCKETS)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    raw = texts.select(F.col(f"`{text_col}`").cast("string").cast("binary"))
    found = raw.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for row in found.collect():
        counts[row.bucket] = row.n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The log ratio of each bucket's smoothed shares, in thousandths, rounded down."""
    in_corpus, in_target = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * in_corpus / ((s + 1) * in_target)))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of rows of numbers from 0 up: (bit, row, 64 buckets to a machine word)."""
    depth = int(values.max(initial=0)).bit_length()
    packed = np.zeros((depth, len(values), _WORDS_OF_64 * 8), np.uint8)
    for bit in range(depth):
        own = np.packbits((values >> bit & 1).astype(bool), axis=1)
        packed[bit, :, : own.shape[1]] = own
    return packed.view(np.uint64)


def sliced_sums(counts: np.ndarray, own_gains: np.ndarray) -> np.ndarray:
    """The sum of counts times gains of each row of counts, from bit planes alone."""
    signed = [planes(np.maximum(sign * own_gains, 0)[None, :]) for sign in (1, -1)]
    total = np.zeros(len(counts), np.int64)
    for p, plane in enumerate(planes(counts)):
        rows = np.flatnonzero(plane.any(axis=1))
        for sign, sliced in zip((1, -1), signed, strict=True):
            for q in range(len(sliced)):
                ones = np.bitwise_count(plane[rows] & sliced[q]).sum(axis=1, dtype=np.int64)
                total[rows] += sign * (ones << (p + q))
    return total


def weigh(docs: DataFrame, own_gains: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_features`` and ``weight`` in place of the text.

    Other columns pass through, those named like the results are replaced.
    """
    made = ("n_words", "n_features", "weight")
    others = [c for c in docs.columns if c.lower() not in made and c != text_col]
    raw = F.col(f"`{text_col}`").cast("string").cast("binary").alias("_text")
    given = docs.select(*[F.col(f"`{c}`") for c in others], raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(k, 64) for k in range(0, whole.num_rows, 64)):
                n_words = np.zeros(batch.num_rows, np.int64)
                counts = np.zeros((batch.num_rows, BUCKETS), np.int64)
                for k, text in enumerate(batch.column(len(others))):
                    for n, found in features(text.as_py() or b""):
                        n_words[k] += n
                        counts[k] += np.bincount(found, minlength=BUCKETS)
                made_here = n_words, counts.sum(axis=1), sliced_sums(counts, own_gains)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *map(pa.array, made_here)], names=[*others, *made]
                )

    kinds = T.StructType(given.schema.fields[:-1])
    for name in made:
        kinds = kinds.add(name, "long")
    return given.mapInArrow(run, kinds)


def noise(id_col: str = "doc_id", seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from the sha256 of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with n_words, n_features, weight, score and rank in place of the text.

    Of the documents with at least ``least_words`` words, ``percent`` of a hundred (rounded
    down) are drawn: those of the highest scores, ties to the smaller id. They are ranked 1, 2,
    3 and so on; others have no rank. ``target`` has texts in a column of the same name.

    Every row is a document of its own, repeated ones too; which of several rows equal in score
    and id comes first is not defined. Null and empty texts have no features, weigh 0 and are
    not drawn. A null id counts as the empty text for the noise, and as larger than all others.
    An empty target or table gives gains of buckets without any count, and no error.
    """
    own_gains = gains(bucket_counts(docs, text_col), bucket_counts(target, text_col))
    weighed = weigh(docs, own_gains, text_col)
    others = [c for c in weighed.columns if c.lower() not in ("score", "rank")]
    weighed = weighed.select(*[F.col(f"`{c}`") for c in others])
    weighed = stored(weighed.withColumn("score", F.col("weight") + noise(id_col, seed)), "weighed")
    rows = weighed.where(F.col("n_words") >= least_words)
    n_drawn = rows.count() * percent // 100
    part = "_part"
    while part in docs.columns:
        part += "_"
    order = F.desc("score"), F.asc_nulls_last(id_col)
    ranged = rows.repartitionByRange(*order).withColumn(part, F.spark_partition_id())
    ranged = stored(ranged, "ranged")
    # a row per range: as many as there are shuffle partitions
    before, at = {-1: 0}, 0
    for own, n in sorted(map(tuple, ranged.groupBy(part).count().collect())):
        if at < n_drawn:
            before[own] = at
        at += n
    no_rank = F.lit(None).cast("long").alias("rank")
    rest = ranged.where(F.col(part) > max(before)).drop(part).select("*", no_rank)
    drawn = ranged.where(F.col(part) <= max(before)).selectExpr(
        "*",
        f"row_number() OVER (PARTITION BY `{part}` ORDER BY score DESC, `{id_col}` ASC NULLS LAST)"
        " AS rank",
    )
    offset = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col(part)]
    rank = (F.col("rank") + offset).cast("long")
    drawn = drawn.withColumn("rank", F.when(rank <= n_drawn, rank)).drop(part)
    short = weighed.where(F.col("n_words") < least_words).select("*", no_rank)
    return drawn.unionByName(rest).unionByName(short)
