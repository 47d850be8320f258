"""Document fingerprints: sums of wide vectors, one for each paragraph.

A fingerprint is a vector of unsigned 32-bit lanes. Each paragraph is hashed to a vector and
the vectors are added modulo 2**32, so the order of paragraphs does not matter and paragraphs
can be added or taken away later. The first ``LANES`` lanes are uniform hash bytes of the
paragraph: they tell whether two multisets are equal. The other ``SKETCH`` lanes add +1 or -1
for each pair of adjacent words in the paragraph: their inner products estimate how much two
documents share.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.llm.words import mix, word_hashes

LANES = 128
SKETCH = 256
#: Documents for each bucket of neighbours, and most buckets.
BUCKET_ROWS = 64
MOST_BUCKETS = 16_384


def paragraph_vectors(paragraphs: list[bytes]) -> np.ndarray:
    """One vector for each paragraph."""
    out = np.zeros((len(paragraphs), LANES + SKETCH), np.uint32)
    if not paragraphs:
        return out
    lanes = b"".join(hashlib.shake_128(p).digest(2 * LANES) for p in paragraphs)
    out[:, :LANES] = np.frombuffer(lanes, "<u2").reshape(len(paragraphs), LANES)
    words, ends = _words(paragraphs)
    first = np.zeros(len(words), bool)
    first[np.append(0, ends[:-1])[np.append(0, ends[:-1]) < len(words)]] = True
    previous = np.where(first, np.uint64(0), np.roll(words, 1))
    pair = mix(previous * np.uint64(0x9E3779B97F4A7C15) + words)
    owner = np.repeat(np.arange(len(paragraphs)), np.diff(np.append(0, ends)))
    lane = (pair >> np.uint64(32)) % np.uint64(SKETCH)
    sign = np.where(pair & np.uint64(1), 1.0, -1.0)
    at = owner * SKETCH + lane.astype(np.int64)
    sums = np.bincount(at, sign, len(paragraphs) * SKETCH).astype(np.int64)
    out[:, LANES:] = sums.reshape(-1, SKETCH).astype(np.uint32)
    return out


def _words(paragraphs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    if sum(map(len, paragraphs)) <= 1 << 22:
        return word_hashes(paragraphs)
    each = [word_hashes([p])[0] for p in paragraphs]
    return np.concatenate(each), np.cumsum([len(e) for e in each])


def paragraphs(text: str) -> list[bytes]:
    """Lines that are not blank, as they are."""
    return [p.encode("utf-8", "surrogatepass") for p in text.split("\n") if p.strip()]


def fingerprint(text: str) -> np.ndarray:
    return insert(np.zeros(LANES + SKETCH, np.uint32), paragraphs(text))


def insert(vector: np.ndarray, added: list[bytes]) -> np.ndarray:
    """The fingerprint with some paragraphs more."""
    return vector + paragraph_vectors(added).sum(0, dtype=np.uint32)


def delete(vector: np.ndarray, removed: list[bytes]) -> np.ndarray:
    """The fingerprint with some paragraphs less."""
    return vector - paragraph_vectors(removed).sum(0, dtype=np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common word pairs, 0 to 1; 1 for equal fingerprints.

    Lanes wrap only beyond 2**31 word pairs, more than a text can hold.
    """
    if np.array_equal(a, b):
        return 1.0
    x, y = (v[LANES:].astype(np.int32).astype(np.float64) for v in (a, b))
    both = x @ y
    total = x @ x + y @ y - both
    return float(min(1.0, max(0.0, both / total))) if total > 0 else 0.0


def encoded(vector: np.ndarray) -> str:
    return base64.b64encode(vector.astype("<u4").tobytes()).decode()


def decoded(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u4").astype(np.uint32)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fingerprint of every row; null counts as empty, an empty text is all zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            out = pa.array([encoded(fingerprint(t or "")) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), out], names=["id", "fingerprint"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return given.mapInArrow(run, f"id {kind}, fingerprint string").withColumnRenamed("id", id_col)


def edited_neighbours(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every text beside an edit of it that borrows from the next document.

    The last quarter of the code points (rounded down) is replaced by as many from the start of
    the next document in ascending id, or all it has; the first follows the last. Returns id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Ids are whole numbers. Null texts count as empty. Rows of equal id are ordered by text and
    each counts as a document; rows without an id come last. An empty table gives no rows, a
    single row is its own neighbour.

    Documents move once, to buckets of adjacent ids cut at quantiles of the ids; each bucket is
    sorted by Spark and read as a stream, with one copy of the next bucket's first document
    behind its own.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        key.alias("at"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    n = docs.count()
    k = max(1, min(MOST_BUCKETS, n // BUCKET_ROWS))
    shares = ", ".join(str(i / k) for i in range(k))
    cuts = rows.selectExpr(f"percentile_approx(at, array({shares}), {8 * k + 10000}) c").first()
    starts = np.unique(np.array(cuts["c"] or [0], np.int64))
    # quantiles are ids that occur, but the least id has to be the first of them
    least = rows.agg(F.min("at")).first()[0]
    starts = np.unique(np.append(starts[1:], least if least is not None else 0))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(1).to_numpy()
            bucket = np.searchsorted(starts, at, "right") - 1
            first = starts[bucket] == at
            yield _dealt(batch, bucket, 0)
            if first.any():
                mask = pa.array(first)
                yield _dealt(batch.filter(mask), (bucket[first] - 1) % len(starts), 1)

    dealt = rows.mapInArrow(deal, "id long, at long, text string, bucket long, guest int")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = dealt.repartition(parts, "bucket").sortWithinPartitions(
        "bucket", "guest", "at", "text"
    )
    kinds = (
        "id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return sorted_rows.mapInArrow(_compare, kinds).withColumnRenamed("id", id_col)


def _dealt(batch: pa.RecordBatch, bucket: np.ndarray, guest: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            *batch.columns,
            pa.array(bucket, pa.int64()),
            pa.array(np.full(batch.num_rows, guest), pa.int32()),
        ],
        names=["id", "at", "text", "bucket", "guest"],
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads rows in order; each is finished by the row behind it in its bucket."""
    schema = pa.schema(
        [
            ("id", pa.int64()),
            ("n_chars", pa.int64()),
            ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()),
            ("near_next", pa.float64()),
        ]
    )
    held: tuple | None = None
    done = True  # the row held has been written, or there is none
    for batch in batches:
        out: list[tuple] = []
        for id_, _, text, bucket, guest in zip(
            *(c.to_pylist() for c in batch.columns), strict=True
        ):
            vector = None
            if not done and held is not None and held[0] == bucket:
                vector = fingerprint(text)
                out.append(_edited(held[1], held[2], held[3], text, vector))
                done = True
            if not guest:
                held = (bucket, id_, text, fingerprint(text) if vector is None else vector)
                done = False
        if out:
            columns = zip(zip(*out, strict=True), schema.types, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=schema)


def _edited(id_: int | None, text: str, own: np.ndarray, after: str, after_vector: np.ndarray):
    cut = len(text) // 4
    new = text[: len(text) - cut] + after[:cut]
    vector = fingerprint(new)
    return (
        id_,
        len(text),
        hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
        encoded(own),
        encoded(vector),
        likeness(own, vector),
        likeness(own, after_vector),
    )
