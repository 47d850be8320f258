"""N-gram Jaccard join by vertical partitioning.

1. Every text gives the set of its word shingles, as 64-bit hashes, and a digest of the set.
   Equal sets form a class. Shingles are counted over all documents in a table of fixed size;
   its counts give the global order, rare cells first.
2. Two sets that reach the similarity share one of the first shingles of either in that order.
   Classes that share such a shingle, and are near in size, meet in the block of the least of
   them.
3. Blocks are screened by histograms of the sets: the sums of the smaller counts bound a
   pair's overlap from above. Classes without a partner within the bound go, and the others
   are regrouped by who is left.
4. The global order is cut into fragments of about equal weight. Each fragment of a block
   counts the partial overlaps of its pairs by itself; the counts are then summed per pair and
   compared with the sizes. What leaves a block is one row for each class, never its pairs.
5. Blocks give links to the least class they reach; these become components.

Texts move once, and only those of one document for each class that has a possible partner, told
by a filter of ids (and few others that it lets through).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.llm.components import connected_components
from monthgrain.llm.filters import may_meet
from monthgrain.llm.scratch import stored
from monthgrain.llm.words import in_slices, shingle_sets

#: Cells of the table of shingle counts (2**20 numbers of 32 bits), and rows it is sent in.
CELL_BITS = 20
SLICES = 64
#: Bits of a shingle that candidates are found by; overlaps use all 64.
KEY_BITS = 40
#: Counts in the histogram of a set, and in that of a set of ``LONG`` shingles or more.
BINS, FINE_BINS, LONG = 64, 512, 1024
#: Fragments of the global order.
FRAGMENTS = 4
#: Most classes of a block that are compared with each other in one task.
TILE = 1024
#: Cells with more shingles than this may hold a hot shingle, which is not put into one task.
HOT = 100_000


@dataclass(frozen=True)
class Join:
    """Which shingles, and the similarity ``num / den`` from which sets are linked."""

    size: int = 5
    num: int = 80
    den: int = 100

    def prefix(self, n: int) -> int:
        """How many of the first shingles any linked set must share one of."""
        return n - -(-self.num * n // self.den) + 1


@dataclass(frozen=True)
class Order:
    """The global order of shingles: by the count of their cell, then by hash."""

    rank: np.ndarray  # of each cell, rarest first
    fragment: np.ndarray  # of each cell
    hot: np.ndarray  # whether a cell may hold a hot shingle

    @classmethod
    def of(cls, counts: np.ndarray, hot: int) -> Order:
        order = np.argsort(counts, kind="stable")
        rank = np.empty(len(counts), np.int32)
        rank[order] = np.arange(len(counts), dtype=np.int32)
        weight = np.cumsum(counts[order])
        fragment = np.empty(len(counts), np.uint8)
        fragment[order] = np.minimum(
            FRAGMENTS - 1, (weight - 1) * FRAGMENTS // max(1, int(weight[-1]))
        ).astype(np.uint8)
        return cls(rank, fragment, counts > hot)


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.to_pylist()]


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _histogram(shingles: np.ndarray) -> bytes:
    """The counts in as few bytes each as the largest needs, behind that width."""
    bins = BINS if len(shingles) < LONG else FINE_BINS
    at = ((shingles >> np.uint64(32)) % np.uint64(bins)).astype(np.int64)
    counts = np.bincount(at, minlength=bins)
    width = next(w for w in (1, 2, 4) if w == 4 or counts.max() < 1 << 8 * w)
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _counts(histogram: bytes) -> np.ndarray:
    return np.frombuffer(histogram, f"<u{histogram[0]}", offset=1).astype(np.int64)


def _short(digest: bytes) -> int:
    """A number for a class; classes that share one only meet in more blocks."""
    return int.from_bytes(digest[:8], "little", signed=True)


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """id, n, digest, class, histogram of every row, and below them the counts of all shingles by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CELL_BITS, np.int64)
        for batch in in_slices(batches):
            n, digests, bins = [], [], []
            for shingles in shingle_sets(_texts(batch.column(1)), size):
                n.append(len(shingles))
                digests.append(_digest(shingles))
                bins.append(_histogram(shingles))
                np.add.at(counts, _cell(shingles), 1)
            shorts = [_short(d) for d in digests]
            none = pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.binary())
            yield _record([batch.column(0), n, digests, shorts, bins, *none])
        parts = [p.astype("<i8").tobytes() for p in np.split(counts, SLICES)]
        empty = [pa.nulls(SLICES, k) for k in kinds[:5]]
        yield _record([*empty, range(SLICES), parts])

    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
    kinds += [pa.int64(), pa.binary()]
    names = ["id", "n", "digest", "class", "bins", "slice", "counts"]

    def _record(columns: list) -> pa.RecordBatch:
        arrays = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(
        run,
        "id long, n long, digest binary, class long, bins binary, slice long, counts binary",
    )


def _order(counts: DataFrame, hot: int) -> Order:
    """The global order from the counts of all tasks; what reaches the driver is one table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[k] = np.frombuffer(raw, "<i8") + sums.get(k, 0)
        names = ["slice", "counts"]
        columns = [pa.array(sums, pa.int64()), pa.array([v.tobytes() for v in sums.values()])]
        yield pa.RecordBatch.from_arrays([columns[0], columns[1].cast(pa.binary())], names=names)

    found = counts.repartition("slice").mapInArrow(run, "slice long, counts binary")
    total = np.zeros((SLICES, (1 << CELL_BITS) // SLICES), np.int64)
    for k, raw in found.collect():
        total[k] += np.frombuffer(raw, "<i8")
    return Order.of(total.reshape(-1), hot)


def _prefixes(rows: DataFrame, join: Join, order) -> DataFrame:
    """(shingle, class, n, hot) for the first shingles of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Order = order.value
        for batch in batches:
            for part in (batch.slice(k, 1000) for k in range(0, batch.num_rows, 1000)):
                keys, hots, classes, sizes, many = [], [], [], [], []
                for shingles in shingle_sets(_texts(part.column(0)), join.size):
                    if not len(shingles):
                        continue
                    cell = _cell(shingles)
                    first = np.argsort(own.rank[cell], kind="stable")[: join.prefix(len(shingles))]
                    keys.append((shingles[first] >> np.uint64(64 - KEY_BITS)).astype(np.int64))
                    hots.append(own.hot[cell[first]])
                    classes.append(_short(_digest(shingles)))
                    sizes.append(len(shingles))
                    many.append(len(first))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(keys)),
                            pa.array(np.repeat(np.array(classes, np.int64), many)),
                            pa.array(np.repeat(np.array(sizes, np.int64), many)),
                            pa.array(np.concatenate(hots)),
                        ],
                        names=["shingle", "class", "n", "hot"],
                    )

    return rows.select("text").mapInArrow(run, "shingle long, class long, n long, hot boolean")


def _meetings(prefixes: DataFrame, join: Join) -> DataFrame:
    """(class, block): classes that share a first shingle go to the block of the least.

    Most shingles are in cells of at most ``HOT`` rows, so their groups are bounded and one
    window serves: within a shingle, sizes too far apart for a link are cut from each other.
    For the rest the least class is found by aggregation and joined, which Spark can split.
    """
    near = f"n * {join.num} > {join.den} * lag(n) OVER (PARTITION BY shingle ORDER BY n, class)"
    light = (
        prefixes.where("NOT hot")
        .selectExpr("shingle", "class", "n", f"coalesce(cast({near} AS int), 0) AS cut")
        .selectExpr("*", "sum(cut) OVER (PARTITION BY shingle ORDER BY n, class) AS run")
        .selectExpr(
            "class",
            "min(class) OVER (PARTITION BY shingle, run) AS block",
            "max(class) OVER (PARTITION BY shingle, run) AS last",
        )
        .where("block < last")
        .select("class", "block")
    )
    hot = prefixes.where("hot").select("shingle", "class")
    least = stored(
        hot.groupBy("shingle")
        .agg(F.min("class").alias("block"), F.max("class").alias("last"))
        .where("block < last")
        .select("shingle", "block"),
        "hot",
    )
    heavy = hot.join(least, "shingle").select("class", "block")
    return light.unionByName(heavy).distinct()


def _screened(meetings: DataFrame, classes: DataFrame, join: Join, tile: int) -> DataFrame:
    """(digest, blocks): the blocks of each class in which a partner is within the bound.

    Blocks of more than ``tile`` classes are compared chunk by chunk and keep their name; the
    others are cut into parts that hang together, each named by its members, so that parts met
    by several shingles become one.
    """
    parts = int(meetings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = stored(
        meetings.groupBy("block").agg(F.expr(f"ceil(count(*) / {tile})").alias("chunks")),
        "blocks",
    )
    dealt = (
        meetings.join(sizes, "block")
        .join(classes.select("class", "digest", "n", "bins"), "class")
        .selectExpr("block", "chunks", f"{_CHUNK} AS chunk", "digest", "n", "bins")
        .selectExpr("*", "explode(sequence(0L, chunks - 1)) AS other")
        .selectExpr(
            "block",
            "least(chunk, other) * chunks + greatest(chunk, other) AS tile",
            "chunks",
            "if(chunk = other, -1L, chunk) AS chunk",
            "digest",
            "n",
            "bins",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, 2):
            rows = list({r[4]: r for r in group}.values())
            if len(rows) < 2:
                continue
            allowed = _near(np.array([r[5] for r in rows]), np.array([r[3] for r in rows]), join)
            i, j = _bounded(rows, allowed, join)
            if not len(i):
                continue
            some = np.unique(np.concatenate([i, j]))
            chunks = group[0][2]
            name = np.full(len(rows), group[0][0], np.int64)
            if chunks == 1:
                root = _roots(len(rows), i, j)
                for r in np.unique(root[some]):
                    inside = np.flatnonzero(root == r)
                    members = b"".join(sorted(rows[k][4] for k in inside))
                    name[inside] = _short(hashlib.blake2b(members, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[k][4] for k in some], pa.binary()),
                    pa.array(name[some]),
                    pa.array(np.full(len(some), chunks), pa.int64()),
                ],
                names=["digest", "block", "chunks"],
            )

    kept = (
        dealt.repartition(parts, "block", "tile")
        .sortWithinPartitions("block", "tile", "digest")
        .mapInArrow(run, "digest binary, block long, chunks long")
    )
    return kept.groupBy("digest").agg(F.collect_set(F.struct("block", "chunks")).alias("blocks"))


#: Which chunk of its block a class is in.
_CHUNK = "pmod(cast(conv(hex(substring(digest, 9, 4)), 16, 10) AS long), chunks)"


def _near(n: np.ndarray, chunk: np.ndarray, join: Join) -> np.ndarray:
    """Pairs of rows that this tile compares and whose sizes allow a link."""
    allowed = np.triu(np.ones((len(n), len(n)), bool), 1)
    allowed &= np.minimum.outer(n, n) * join.den >= np.maximum.outer(n, n) * join.num
    if chunk[0] >= 0:
        allowed &= chunk[:, None] != chunk[None, :]
    return allowed


def _bounded(rows: list[tuple], allowed: np.ndarray, join: Join) -> tuple[np.ndarray, np.ndarray]:
    """The allowed pairs whose histograms leave room for a link.

    Pairs of two long sets are held against their finer histograms, too.
    """
    counts = [_counts(r[6]) for r in rows]
    coarse = np.stack([c.reshape(-1, BINS).sum(0) for c in counts])
    n = coarse.sum(1)

    def kept(i: np.ndarray, j: np.ndarray, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(i), bool)
        for start in range(0, len(i), 8192):
            a, b = i[start : start + 8192], j[start : start + 8192]
            most = np.minimum(bins[at[a]], bins[at[b]]).sum(1)
            keep[start : start + 8192] = most * join.den >= join.num * (n[a] + n[b] - most)
        return keep

    i, j = np.nonzero(allowed)
    keep = kept(i, j, coarse, np.arange(len(rows)))
    i, j = i[keep], j[keep]
    long = np.array([len(c) > BINS for c in counts])
    both = long[i] & long[j]
    if both.any():
        fine = np.stack([c for c in counts if len(c) > BINS])
        keep = ~both
        keep[both] = kept(i[both], j[both], fine, np.cumsum(long) - 1)
        i, j = i[keep], j[keep]
    return i, j


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member that each of ``n`` members reaches by the pairs."""
    root = np.arange(n)
    while True:
        new = root.copy()
        least = np.minimum(root[i], root[j])
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        if np.array_equal(new, root):
            return root
        root = new


_SEGMENTS = pa.schema(
    [
        ("block", pa.int64()),
        ("tile", pa.int64()),
        ("fragment", pa.int32()),
        ("digest", pa.binary()),
        ("rep", pa.int64()),
        ("n", pa.int64()),
        ("copies", pa.int64()),
        ("chunk", pa.int32()),
        ("blocks", pa.list_(pa.int64())),
        ("shingles", pa.binary()),
    ]
)
_SEGMENT_KINDS = (
    "block long, tile long, fragment int, digest binary, rep long, n long, copies long, "
    "chunk int, blocks array<long>, shingles binary"
)


def _segments(wanted: DataFrame, join: Join, order) -> DataFrame:
    """One row for each class, block, tile and fragment, with the shingles of the fragment."""

    def rows(own: Order, batch: pa.RecordBatch) -> Iterator[tuple]:
        columns = [c.to_pylist() for c in batch.columns[1:]]
        sets = shingle_sets(_texts(batch.column(0)), join.size)
        for shingles, digest, rep, n, copies, blocks in zip(sets, *columns, strict=True):
            if _digest(shingles) != digest:
                continue  # another row of the same id
            fragment = own.fragment[_cell(shingles)]
            parts = [shingles[fragment == k].tobytes() for k in range(FRAGMENTS)]
            names = [b["block"] for b in blocks]
            for block in blocks:
                chunks = block["chunks"]
                own_chunk = int.from_bytes(digest[8:12], "big") % chunks
                for other in range(chunks):
                    low, high = min(own_chunk, other), max(own_chunk, other)
                    for k, part in enumerate(parts):
                        yield (
                            block["block"],
                            low * chunks + high,
                            k,
                            digest,
                            rep,
                            n,
                            copies,
                            own_chunk if low != high else -1,
                            names,
                            part,
                        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Order = order.value
        for batch in batches:
            for part in (batch.slice(k, 64) for k in range(0, batch.num_rows, 64)):
                yield from _flush(rows(own, part))

    return wanted.select("text", "digest", "rep", "n", "copies", "blocks").mapInArrow(
        run, _SEGMENT_KINDS
    )


def _flush(rows: Iterator[tuple], most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + len(row[-1])
        if size > most:
            yield _segment_batch(held)
            held, size = [], 0
    if held:
        yield _segment_batch(held)


def _segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), _SEGMENTS.types, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=_SEGMENTS)


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Consecutive rows with equal first ``keys`` columns."""
    held: list[tuple] = []
    for batch in batches:
        for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if held and held[0][:keys] != row[:keys]:
                    yield held
                    held = []
                held.append(row)
    if held:
        yield held


def overlaps(sets: list[np.ndarray], allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes ``i * len(sets) + j`` and counts of common elements of the allowed pairs."""
    n = len(sets)
    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, at, often = np.unique(values, return_inverse=True, return_counts=True)
    common = often > 1
    column = (np.cumsum(common) - 1)[at]
    keep = common[at]
    owner, column = owner[keep], column[keep]
    width = int(common.sum())
    step = max(256, (1 << 23) // max(1, n))
    total = np.zeros((n, n), np.float32)
    by_column = np.argsort(column, kind="stable")
    owner, column = owner[by_column], column[by_column]
    for start in range(0, width, step):
        low, high = np.searchsorted(column, [start, start + step])
        has = np.zeros((n, min(step, width - start)), np.float32)
        has[owner[low:high], column[low:high] - start] = 1
        total += has @ has.T
    i, j = np.nonzero((total > 0) & allowed)
    return i * n + j, total[i, j].astype(np.int64)


def _partial(join: Join) -> Callable:
    """Counts overlaps of one fragment of one tile; the first fragment also tells who is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, 3):
            rows = list({r[3]: r for r in group}.values())  # a repeated row counts once
            if len(rows) < 2:
                continue
            n = np.array([r[5] for r in rows])
            allowed = _near(n, np.array([r[7] for r in rows]), join)
            codes, counts = overlaps([np.frombuffer(r[9], "<u8") for r in rows], allowed)
            first = group[0][2] == 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([group[0][0]], pa.int64()),
                    pa.array([group[0][1]], pa.int64()),
                    pa.array([group[0][2]], pa.int32()),
                    pa.array([codes.astype("<i4").tobytes()], pa.binary()),
                    pa.array([counts.astype("<i4").tobytes()], pa.binary()),
                    pa.array([[r[3] for r in rows] if first else []], pa.list_(pa.binary())),
                    pa.array([[r[4] for r in rows] if first else []], pa.list_(pa.int64())),
                    pa.array([n if first else []], pa.list_(pa.int64())),
                    pa.array([[r[6] for r in rows] if first else []], pa.list_(pa.int64())),
                    pa.array(
                        [[r[8] for r in rows] if first else []], pa.list_(pa.list_(pa.int64()))
                    ),
                ],
                names=["block", "tile", "fragment", "codes", "counts"]
                + ["digests", "reps", "ns", "copies", "blocks"],
            )

    return run


_PARTIAL_KINDS = (
    "block long, tile long, fragment int, codes binary, counts binary, digests array<binary>, "
    "reps array<long>, ns array<long>, copies array<long>, blocks array<array<long>>"
)


def _linked(join: Join) -> Callable:
    """Sums the partial overlaps of a tile per pair and gives a row for each linked class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, 2):
            digests, reps, sizes, copies, blocks = group[0][5:]
            size = len(reps)
            codes = np.concatenate([np.frombuffer(r[3], "<i4") for r in group]).astype(np.int64)
            counts = np.concatenate([np.frombuffer(r[4], "<i4") for r in group])
            pairs, at = np.unique(codes, return_inverse=True)
            both = np.bincount(at, counts, len(pairs)).astype(np.int64)
            i, j = pairs // size, pairs % size
            n = np.array(sizes)
            links = both * join.den >= join.num * (n[i] + n[j] - both)
            i, j = i[links], j[links]
            if not len(i):
                continue
            root = _roots(size, i, j)
            counted = ~_elsewhere(group[0][0], blocks, size)[i, j]
            weight = np.array(copies, np.float64)
            number = np.bincount(i[counted], weight[j[counted]], size)
            number += np.bincount(j[counted], weight[i[counted]], size)
            some = np.unique(np.concatenate([i, j]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digests[k] for k in some], pa.binary()),
                    pa.array([reps[k] for k in some], pa.int64()),
                    pa.array([reps[k] for k in root[some]], pa.int64()),
                    pa.array(number[some].astype(np.int64)),
                ],
                names=["digest", "rep", "root", "links"],
            )

    return run


def _elsewhere(block: int, blocks: list[list[int]], n: int) -> np.ndarray:
    """Which pairs also meet in a block of a smaller number, where they are counted."""
    out = np.zeros((n, n), bool)
    members: dict[int, list[int]] = {}
    for k, own in enumerate(blocks):
        for b in own:
            if b < block:
                members.setdefault(b, []).append(k)
    for both in members.values():
        if len(both) > 1:
            out[np.ix_(both, both)] = True
    return out


def jaccard_groups(
    docs: DataFrame,
    join: Join = Join(),
    id_col: str = "doc_id",
    text_col: str = "text",
    tile: int = TILE,
    hot: int = HOT,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, n_links.

    Words are runs of bytes other than white space (the space and U+0009 to U+000D), with A to
    Z in lower case. A text with fewer words than a shingle is one shingle; without words (or
    null) it has none and is linked with nothing. ``component_id`` is the least id that links
    reach, ``n_links`` how many other rows the row is linked with. Ids are whole numbers; rows
    of equal id are taken as one document. Rows without an id are linked with nothing and have
    no component. An empty table gives no rows; other columns are ignored.

    Shingles are compared by 64-bit hash. Pairs are all found and all compared exactly; the
    number of links of a group of G different texts takes G * G / 2 comparisons, spread over
    tiles of ``tile`` by ``tile`` classes.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").cast("binary").alias("text"),
    )
    sets = stored(_sets(rows, join.size), "sets")
    counted = sets.where("slice IS NOT NULL").select("slice", "counts")
    order = spark.sparkContext.broadcast(_order(counted, hot))
    sets = sets.where("slice IS NULL").select("id", "n", "digest", "class", "bins")
    named = sets.where("id IS NOT NULL")
    classes = stored(
        named.where("n > 0")
        .groupBy("digest", "n", "class")
        .agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("bins").alias("bins")),
        "classes",
    )

    known = rows.where("id IS NOT NULL")
    meetings = stored(_meetings(_prefixes(known, join, order), join), "meetings")
    screened = stored(_screened(meetings, classes, join, tile), "screened")
    wanted = stored(
        screened.join(classes, "digest").select(
            F.col("rep").alias("id"), "rep", "digest", "n", "copies", "blocks"
        ),
        "wanted",
    )
    # one plan at every size: texts that a filter of the wanted ids lets through move once, by a
    # merge join
    met, _ = may_meet(known, wanted, "id")
    segments = _segments(met.join(wanted.hint("merge"), "id"), join, order)
    partial = (
        segments.repartition(parts, "block", "tile", "fragment")
        .sortWithinPartitions("block", "tile", "fragment", "digest")
        .mapInArrow(_partial(join), _PARTIAL_KINDS)
    )
    linked = stored(
        partial.repartition(parts, "block", "tile")
        .sortWithinPartitions("block", "tile", "fragment")
        .mapInArrow(_linked(join), "digest binary, rep long, root long, links long"),
        "links",
    )
    links = linked.select(F.col("rep").alias("u"), F.col("root").alias("v"))
    component = connected_components(links)
    counts = linked.groupBy("digest").agg(F.sum("links").alias("links"))
    found = stored(
        classes.join(counts, "digest", "left")
        .join(component, F.col("rep") == F.col("node"), "left")
        .select(
            "digest",
            F.coalesce("component", "rep").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        ),
        "found",
    )
    out = named.join(found, "digest", "left").select(
        "id",
        "n",
        F.coalesce("component", "id").alias("component"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )
    lost = sets.where("id IS NULL").select(
        "id", "n", F.lit(None).cast("long").alias("component"), F.lit(0).cast("long").alias("links")
    )
    return out.unionByName(lost).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("links").alias("n_links"),
    )
