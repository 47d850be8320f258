"""Quality classifier: histogram gradient-boosted trees over document statistics.

Tasks compute the statistics; a bounded sample of labelled documents trains the trees on the
driver (``SAMPLE`` rows of a few dozen numbers). The trees are complete and flattened into
arrays, so that a batch of documents goes down all of them by numpy indexing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrain.llm.labelled import labelled_sample
from monthgrain.llm.words import mix, word_hashes

#: Most labelled documents that the trees are fitted on.
SAMPLE = 20_000
BINS, DEPTH, TREES, RATE, RIDGE = 64, 4, 80, 0.15, 2.0

_SIGNS = b"!$%&#*|@~^_+=<>/\\"
#: The class of each byte: lower, upper, digit, space, line end, beyond ASCII, points, signs, rest.
_CLASS = np.full(256, 8)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[ord(" ")] = 3
_CLASS[ord("\n")] = 4
_CLASS[128:] = 5
_CLASS[list(b".,;:?'\"()-")] = 6
_CLASS[list(_SIGNS)] = 7


def statistics(text: str) -> np.ndarray:
    """What the classifier sees of a text: numbers of its bytes, words and lines."""
    raw = text.encode("utf-8", "surrogatepass")
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(1, len(raw))
    shares = np.bincount(_CLASS, bytes_, 9) / n
    signs = bytes_[list(_SIGNS)] / n
    used = bytes_[bytes_ > 0] / n
    words, _ = word_hashes([raw])
    many = max(1, len(words))
    _, often = np.unique(words, return_counts=True)
    pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    threes = mix(pairs[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[2:])
    lines = [x for x in text.split("\n") if x]
    repeated = sum(map(len, lines)) - sum(map(len, set(lines)))
    length = np.array([len(x) for x in lines] or [0])
    return np.concatenate(
        [
            [np.log1p(len(raw)), np.log1p(len(words)), len(raw) / many],
            shares,
            signs,
            [
                -(used * np.log(used)).sum(),
                len(often) / many,
                often.max(initial=0) / many,
                len(np.unique(pairs)) / max(1, len(pairs)),
                len(np.unique(threes)) / max(1, len(threes)),
                np.log1p(len(lines)),
                len(set(lines)) / max(1, len(lines)),
                repeated / n,
                np.log1p(length.mean()),
                np.log1p(length.max()),
                length.std() / max(1.0, length.mean()),
            ],
        ]
    )


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: node ``i`` of a tree has the children ``2 i + 1`` and ``2 i + 2``."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray  # (trees, inner nodes); larger values go to the second child
    leaf: np.ndarray  # (trees, leaves)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        row = np.arange(len(x))
        total = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[row, feature[node]] > cut[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for the logistic loss; with one label only (or none) they are constant."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    if len(np.unique(y)) < 2:
        none = np.zeros((0, inner), np.int64)
        return Trees(base, none, none.astype(float), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
    binned = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T, strict=True)])
    total = np.full(len(y), base)
    grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            f, b, gain = _best(binned, node - first, width, gradient, weight)
            own = node - first
            for k in range(width):
                if gain[k] > 1e-6 and b[k] < len(cuts[f[k]]):
                    feature[first + k], cut[first + k] = f[k], cuts[f[k]][b[k]]
            right = (x[np.arange(len(y)), feature[node]] > cut[node]).astype(np.int64)
            node = 2 * (own + first) + 1 + right
        at = node - inner
        leaf = RATE * np.bincount(at, gradient, leaves) / (np.bincount(at, weight, leaves) + RIDGE)
        total += leaf[at]
        grown.append((feature, cut, leaf))
    features, tree_cuts, values = zip(*grown, strict=True)
    return Trees(base, np.stack(features), np.stack(tree_cuts), np.stack(values))


def _best(binned: np.ndarray, node: np.ndarray, width: int, g: np.ndarray, h: np.ndarray):
    """The best feature and bin for each node of a level, from histograms."""
    found = np.zeros(width, np.int64), np.zeros(width, np.int64), np.zeros(width)
    rows = np.arange(width)
    for f, bins in enumerate(binned):
        at = node * BINS + bins
        left_g = np.bincount(at, g, width * BINS).reshape(width, BINS).cumsum(1)
        left_h = np.bincount(at, h, width * BINS).reshape(width, BINS).cumsum(1)
        all_g, all_h = left_g[:, -1:], left_h[:, -1:]
        gain = left_g**2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE)
        gain -= all_g**2 / (all_h + RIDGE)
        gain[(left_h < 1) | (all_h - left_h < 1)] = 0
        best = gain.argmax(1)
        better = gain[rows, best] > found[2]
        found[0][better], found[1][better] = f, best[better]
        found[2][better] = gain[rows, best][better]
    return found


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE) -> Trees:
    """Trees from at most ``bound`` labelled documents that are not held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), batch.column(1), batch.column(2)],
                names=["x", "label", "doc_id"],
            )

    sample = labelled_sample(docs, labels, label, bound)
    rows = sample.select("text", "label", "doc_id").mapInArrow(
        run, "x binary, label int, doc_id long"
    )
    found = sorted(rows.collect(), key=lambda r: (r.doc_id, bytes(r.x)))
    wide = len(statistics(""))
    x = np.array([np.frombuffer(r.x) for r in found]).reshape(-1, wide)
    return fit(x, np.array([r.label for r in found], np.float64))


def score(docs: DataFrame, trees: Trees, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; null texts count as empty.

    All columns pass through; one named like the score is replaced.
    """
    own = docs.sparkSession.sparkContext.broadcast(trees)
    others = [c for c in docs.columns if c.lower() != name.lower()]
    at = others.index(text_col)
    given = docs.select(*[F.col(f"`{c}`") for c in others])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(k, 512) for k in range(0, whole.num_rows, 512)):
                x = np.array([statistics(t or "") for t in batch.column(at).to_pylist()])
                scores = pa.array(own.value.score(x), pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*others, name])

    return given.mapInArrow(run, T.StructType(given.schema.fields[:]).add(name, "double"))
