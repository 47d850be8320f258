"""Passage dedup: runs of 50 words that occur before go, wherever they stand in a line.

Two steps find the runs without moving every one. First, texts are winnowed: of the 26-word
grams that any 50 words hold, the one of the least hash stands for them, so texts that share 50
words share such a gram. Then only the 50-word runs around grams that occur several times are
compared, by hash. The first place of a run stays, in ascending id and word; at later places
its words go.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.llm.lines import ELSEWHERE, SHARED, place_of, with_cuts
from monthgrain.llm.scratch import stored
from monthgrain.llm.words import _SPACE, _starts, by_size, in_slices, mix, word_hashes

#: Words of a run, and of the grams that stand for it.
RUN, GRAM = 50, 26
#: Grams in a run.
SPAN = RUN - GRAM + 1
_AT = "at struct<id: bigint, salt: bigint, kin: bigint>"


def _hashed(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each ``size`` words in a row."""
    n = max(0, len(words) - size + 1)
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    return h


def _winnowed(words: np.ndarray, _: list[int] | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of the grams that stand for the runs of a text."""
    if len(words) < RUN:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = _hashed(words, GRAM)
    best = np.lib.stride_tricks.sliding_window_view(h, SPAN).argmin(1)
    places = np.unique(best + np.arange(len(best)))
    return places, h[places]


def _around(words: np.ndarray, grams: list[int] | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of the runs of a text that hold one of the grams at these places."""
    starts = np.array(grams, np.int64)[:, None] - np.arange(SPAN)[None, :]
    places = np.unique(starts[(starts >= 0) & (starts <= len(words) - RUN)])
    return places, _hashed(words, RUN)[places] if len(places) else np.empty(0, np.uint64)


def _places(rows: DataFrame, find: Callable) -> DataFrame:
    """(at, place, key, again): what ``find`` finds in each row (at, text, grams).

    ``again`` says that the row has some key twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in by_size(texts):
                words, ends = word_hashes(texts[part])
                grams = batch.column(2)[part].to_pylist()
                each = np.split(words, ends[:-1])
                found = [find(w, g) for w, g in zip(each, grams, strict=True)]
                row = np.repeat(np.arange(part.start, part.stop), [len(p) for p, _ in found])
                if len(row):
                    places = np.concatenate([p for p, _ in found]).astype(np.int32)
                    keys = np.concatenate([k for _, k in found]).view(np.int64)
                    twice = np.array([len(np.unique(k)) < len(k) for _, k in found])
                    again = np.repeat(twice, [len(p) for p, _ in found])
                    at = batch.column(0).take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [at, *map(pa.array, (places, keys, again))],
                        names=["at", "place", "key", "again"],
                    )

    kinds = f"{_AT}, place int, key bigint, again boolean"
    return rows.select("at", "text", "grams").mapInArrow(run, kinds)


def repeated_passages(rows: DataFrame) -> DataFrame:
    """(at, cut): for rows (at, text), the first words of runs that occur before."""
    none = F.expr("cast(NULL AS array<int>)")
    grams = stored(_places(rows.withColumn("grams", none), _winnowed), "grams")
    shared = grams.groupBy("key").agg(F.expr(SHARED).alias("shared"))
    often = stored(shared.where("shared").select("key"), "often")
    hits = stored(
        grams.join(often, "key").groupBy("at").agg(F.collect_set("place").alias("grams")), "hits"
    )
    runs = stored(_places(rows.join(hits, "at"), _around), "runs")
    first = stored(
        runs.groupBy("key")
        .agg(F.min(F.struct("at", "place")).alias("first"), F.expr(SHARED).alias("shared"))
        .where("shared")
        .select("key", "first"),
        "first",
    )
    # the first places are a plain table, so rows of a hot run can be split
    later = runs.join(first, "key").where(ELSEWHERE)
    return later.groupBy("at").agg(F.collect_set("place").alias("cut"))


def without(text: bytes, cut: list[int]) -> bytes:
    """The text without the runs that start at these words; line feeds around them stay."""
    starts = _starts(text)
    gone = np.zeros(len(starts) + 1, np.int64)
    places = np.array(cut, np.int64)
    np.add.at(gone, places, 1)
    np.add.at(gone, places + RUN, -1)
    gone = np.cumsum(gone) > 0
    edges = np.flatnonzero(np.diff(gone, prepend=False))  # the last is never gone
    bounds = np.append(starts, len(text)).tolist()
    out, at = [], 0
    for a, b in edges.reshape(-1, 2).tolist():
        out.append(text[at : bounds[a]])
        last, at = bounds[b - 1], bounds[b]
        space = _SPACE[np.frombuffer(text[last:at], np.uint8)]
        gap = text[last + int((~space).sum()) : at]  # a word, then white space
        if b"\n" in gap:
            at -= len(gap)
    return b"".join([*out, text[at:]])


def drop_repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    kin_col: str | None = None,
) -> DataFrame:
    """``docs`` with its texts cut.

    Words are parted by white space, A to Z count as lower case. Texts of fewer than 50 words
    stay whole, null texts stay null. Ids are whole numbers, null before all others; rows of
    equal id are told apart by their texts, and equal rows are one document. Other columns pass
    through. No rows give no rows. ``docs`` is read four times, so it should be a plain table.

    ``kin_col`` names a column of whole numbers: runs that stand first in a document of the same
    number are left alone. Null is no group.
    """
    at = place_of(id_col, text_col, kin_col)
    text = f"coalesce(cast(`{text_col}` AS string), '')"
    rows = docs.selectExpr(f"{at} AS at", f"{text} AS text")
    cuts = stored(repeated_passages(rows), "passages")
    held = docs.select(F.expr(at).alias("at"), F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"))
    found = with_cuts(held, cuts).select("row.*", F.col("cut").alias("__cut"))
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(where).cast(pa.binary()).to_pylist()
            cut = batch.column(batch.num_columns - 1).to_pylist()
            made = [t if c is None else without(t, c) for t, c in zip(texts, cut, strict=True)]
            columns = list(batch.columns[:-1])
            columns[where] = pa.array(made, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return found.mapInArrow(run, docs.schema)
