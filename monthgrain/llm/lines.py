"""Line dedup by overlapping windows of three lines.

Every three consecutive lines that are not blank are hashed. A window that occurs several times
stays where it comes first, in ascending id and line; at its later places the lines it covers
go. Only hashes and places are shuffled for the search, then the texts that have cuts to meet them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.llm.filters import may_meet
from monthgrain.llm.scratch import stored

#: Lines in a window.
WINDOW = 3


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """(at, place, again, key, lines): each window's document, place, 128-bit hash and line numbers.

    ``again`` says that the document has some window twice.
    """
    texts = ", ".join(f"own[k + {i}].x" for i in range(window))
    numbers = ", ".join(f"own[k + {i}].i" for i in range(window))
    made = (
        f"transform(sequence(0, size(own) - {window}), k -> struct("
        f"struct(xxhash64({texts}) AS a, xxhash64('second', {texts}) AS b) AS key, "
        f"array({numbers}) AS lines))"
    )
    full = "filter(transform(split(text, '\\n', -1), (x, i) -> struct(i, x)), s -> trim(s.x) <> '')"
    keys = "transform(windows, w -> w.key.a)"  # numbers, which are told apart by hash
    return (
        rows.selectExpr("at", f"{full} AS own")
        .where(f"size(own) >= {window}")
        .selectExpr("at", f"{made} AS windows")
        .selectExpr(
            "at",
            f"size(array_distinct({keys})) < size(windows) AS again",
            # there is always a window; a plain explode would filter by size(windows) first, with
            # the lines made anew for each of them
            "posexplode_outer(windows) AS (place, window)",
        )
        .select("at", "place", "again", "window.key", "window.lines")
    )


#: For a place and the first of its key: it is another one, not in a relative of that document.
ELSEWHERE = (
    "struct(at, place) <> first AND (at = first.at OR NOT coalesce(at.kin = first.at.kin, false))"
)
#: For the places of a key: some may have to go, as two documents that are no relatives share it
#: or a document that repeats itself has it.
SHARED = (
    "count(*) > 1 AND (bool_or(again) OR bool_or(at.kin IS NULL) OR min(at.kin) <> max(at.kin))"
)


def place_of(id_col: str, text_col: str, kin_col: str | None = None) -> str:
    """Where a text stands in the order of all: id, hash of the text, and its group if any."""
    kin = f"cast(`{kin_col}` AS long)" if kin_col else "cast(NULL AS long)"
    return (
        f"struct(coalesce(cast(`{id_col}` AS long), -9223372036854775808L) AS id, "
        f"xxhash64(cast(`{text_col}` AS string)) AS salt, {kin} AS kin)"
    )


def repeated_lines(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(at, cut): for rows (at, text) with later windows, the numbers of the covered lines."""
    windows = _windows(rows, window)
    first = stored(
        windows.groupBy("key")
        .agg(F.min(F.struct("at", "place")).alias("first"), F.expr(SHARED).alias("shared"))
        .where("shared")
        .select("key", "first"),
        "windows",
    )
    # the first places are a plain table, so rows of a hot window can be split
    later = windows.join(first, "key").where(ELSEWHERE)
    covered = later.select("at", F.explode("lines").alias("line"))
    return covered.groupBy("at").agg(F.collect_set("line").alias("cut"))


def with_cuts(held: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows (at, row) and the cut of their place, null where there is none.

    ``cuts`` is a plain table; rows that a filter rules out stay where they are.
    """
    near, alone = may_meet(held, cuts, "at")
    return near.join(cuts, "at", "left").unionByName(alone, allowMissingColumns=True)


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    kin_col: str | None = None,
) -> DataFrame:
    """``docs`` with its texts cut, and n_lines and n_removed (lines that are not blank).

    Lines are parted by line feeds; one of spaces alone is blank, belongs to no window and
    stays. Texts with fewer full lines than a window stay whole, null texts stay null. Ids are
    whole numbers, null before all others; rows of equal id are told apart by their texts, and
    equal rows are one document. Other columns pass through; ones named like the new columns
    are replaced. No rows give no rows.

    ``kin_col`` names a column of whole numbers: windows that stand first in a document of the
    same number are left alone. Null is no group.
    """
    new = ("n_lines", "n_removed")
    others = [c for c in docs.columns if c.lower() not in new]
    at = place_of(id_col, text_col, kin_col)
    text = f"coalesce(cast(`{text_col}` AS string), '')"
    cuts = stored(repeated_lines(docs.selectExpr(f"{at} AS at", f"{text} AS text"), window), "cuts")
    held = docs.select(F.expr(at).alias("at"), F.struct(*[f"`{c}`" for c in others]).alias("row"))
    found = with_cuts(held, cuts)
    lines = f"split(row.`{text_col}`, '\\n', -1)"
    kept = f"transform(array_except(sequence(0, size({lines}) - 1), cut), i -> {lines}[i])"
    rebuilt = f"if(cut IS NULL, row.`{text_col}`, array_join({kept}, '\\n'))"
    full = f"size(filter(split(coalesce(row.`{text_col}`, ''), '\\n', -1), x -> trim(x) <> ''))"
    return found.selectExpr(
        *[f"{rebuilt} AS `{c}`" if c == text_col else f"row.`{c}` AS `{c}`" for c in others],
        f"cast({full} AS long) AS n_lines",
        "cast(coalesce(size(cut), 0) AS long) AS n_removed",
    )
