"""Hashes of words and word shingles of many texts at once, in numpy.

Words are runs of bytes other than the space and U+0009 to U+000D. A word's hash is a sum of
random 64-bit numbers per byte and place, then mixed; a shingle's mixes those of its words in
order. Both are the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_draw = np.random.default_rng(20240607)
_BYTE = _draw.integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[*range(9, 14), 32]] = True
#: Places of bytes in a word: place i counts as _LOW[i % 65536] * _HIGH[i // 65536 % 65536].
_LOW = np.cumprod(np.full(65536, 0x9E3779B97F4A7C15, np.uint64))
_HIGH = np.cumprod(np.full(65536, 0xD1342543DE82EF95, np.uint64))
#: Bytes and rows handled at once; arrays of a piece take some sixty times its bytes.
_PIECE, _ROWS = 1 << 18, 512


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads each of the 64 bits over all."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pieces(text: bytes) -> Iterator[bytes]:
    """Parts of a long text, cut before white space."""
    at = 0
    while len(text) - at > _PIECE:
        end = at + _PIECE
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and where each text's words end.

    Letters A to Z count as lower case. The texts should be about a piece together; a longer
    one is handled in parts.
    """
    if len(texts) == 1 and len(texts[0]) > _PIECE:
        parts = [word_hashes([p])[0] if len(p) <= _PIECE else _hash(p) for p in _pieces(texts[0])]
        hashes = np.concatenate(parts)
        return hashes, np.array([len(hashes)])
    joined = b"\n".join(texts)
    starts = _starts(joined)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return _hash(joined), np.searchsorted(starts, ends)


def _starts(text: bytes) -> np.ndarray:
    space = _SPACE[np.frombuffer(text, np.uint8)]
    return np.flatnonzero(~space & np.concatenate(([True], space[:-1])))


def _hash(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    starts = _starts(text)
    if not len(starts):
        return np.empty(0, np.uint64)
    space = _SPACE[raw]
    place = np.zeros(len(raw), np.int64)
    length = np.diff(np.append(starts, len(raw)))
    place[starts[0] :] = np.arange(starts[0], len(raw)) - np.repeat(starts, length)
    value = _BYTE[_FOLD[raw]] * _LOW[place & 0xFFFF]
    if place.max() > 0xFFFF:
        value *= _HIGH[(place >> 16) & 0xFFFF]
    value[space] = 0
    return mix(np.add.reduceat(value, starts))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingle hashes of one text, sorted; fewer words than ``size`` make one."""
    if not len(words):
        return words
    n = min(size, len(words))
    h = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - n + 1 + k])
    return np.unique(h)


def in_slices(batches: Iterator, rows: int = _ROWS) -> Iterator:
    """Arrow batches a few rows at a time, so that a task copies little of a large one."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def by_size(texts: list[bytes], most: int = _PIECE) -> Iterator[slice]:
    """Slices of the texts of about ``most`` bytes each, one text at least."""
    at, total = 0, 0
    for k, t in enumerate(texts):
        if k > at and total + len(t) > most:
            yield slice(at, k)
            at, total = k, 0
        total += len(t)
    if at < len(texts):
        yield slice(at, len(texts))


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """The shingle set of each text, in order."""
    for part in by_size(texts):
        words, ends = word_hashes(texts[part])
        at = 0
        for end in ends.tolist():
            yield shingles(words[at:end], size)
            at = end
