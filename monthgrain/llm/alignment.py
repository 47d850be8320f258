"""Alignment of two tokenizers over the same bytes, by products of sparse incidence matrices.

Both token sequences of a text cover the same bytes. Row i of the incidence matrix A says which
bytes token i covers, B likewise. A times the transpose of B has an entry for every two tokens
that overlap, with the number of bytes they share: the overlap links. Bytes after which tokens of
both sides end cut the text into groups; the product of the tokens' group incidence gives the
links of tokens that share a group. Matrices are compressed rows, products go row by row.

Between words both tokenizers begin anew, so a word's tokens, groups and links are the same
wherever it stands. Tasks keep those of the words they have seen: a document's id pairs are then
the product of its word counts with the words' pairs.

For corpus-wide counts of linked ids, documents are dealt into blocks of bounded size. A block
keeps a dictionary of its id pairs with the number of its documents that hold each; only
dictionaries are summed, and only the sums a block asked for come back to it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrain.llm.scratch import stored
from monthgrain.llm.words import by_size

#: Bytes of text in a block (one text at least), and those aligned at once.
BLOCK, PIECE = 1 << 24, 1 << 19
#: Longer texts are encoded in parts of this many characters.
_PART = 1 << 16
#: A single space between other characters begins a token on both sides, so texts can be cut
#: there. Only characters that no table of characters takes for white space count.
_CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
#: Words, and characters of them, that a task remembers.
REMEMBERED, REMEMBERED_CHARACTERS = 300_000, 1 << 22


# Sparse matrices -----------------------------------------------------------------------------


@dataclass
class Rows:
    """A matrix in compressed rows: the columns of row i are ``cols[ptr[i] : ptr[i + 1]]``."""

    ptr: np.ndarray
    cols: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def spans(cls, lengths: np.ndarray) -> Rows:
        """Row i covers the next ``lengths[i]`` columns."""
        ptr = np.concatenate(([0], np.cumsum(lengths)))
        n = int(ptr[-1])
        return cls(ptr, np.arange(n), np.ones(n, np.int64), n)

    @classmethod
    def members(cls, groups: np.ndarray, width: int) -> Rows:
        """Row i has its group as the only column."""
        n = len(groups)
        return cls(np.arange(n + 1), groups, np.ones(n, np.int64), width)

    def row_of_entries(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def transposed(self) -> Rows:
        order = np.argsort(self.cols, kind="stable")
        ptr = np.searchsorted(self.cols[order], np.arange(self.width + 1))
        return Rows(ptr, self.row_of_entries()[order], self.values[order], len(self.ptr) - 1)

    def times(self, other: Rows) -> Rows:
        """The product, row by row: the rows of ``other`` that a row names, scaled and added."""
        taken = np.diff(other.ptr)[self.cols]
        rows = np.repeat(self.row_of_entries(), taken)
        # places within the rows taken
        inner = np.arange(len(rows)) - np.repeat(np.cumsum(taken) - taken, taken)
        places = np.repeat(other.ptr[self.cols], taken) + inner
        cols = other.cols[places]
        values = np.repeat(self.values, taken) * other.values[places]
        key = rows * other.width + cols
        if len(key) and (np.diff(key) < 0).any():
            order = np.argsort(key, kind="stable")
            key, values = key[order], values[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        if len(first):
            values = np.add.reduceat(values, first)
        key = key[first]
        n_rows = len(self.ptr) - 1
        ptr = np.searchsorted(key, np.arange(n_rows + 1) * max(1, other.width))
        return Rows(ptr, key % max(1, other.width), values, other.width)


# Tokens --------------------------------------------------------------------------------------


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as they are, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Side:
    """One tokenizer: the ids of texts, and the bytes of every id."""

    def __init__(self, token_bytes: list[bytes]):
        self.token_bytes = token_bytes
        self.lengths = np.array([len(b) for b in token_bytes], np.int64)

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of each part of a text; all begin with a space that is left out."""
        raise NotImplementedError


class ByteLevel(Side):
    """A byte-level vocabulary file of the tokenizers library.

    Where the file's merges are in the order of their ids, as byte-level ones mostly are, ids
    are ranks and tiktoken, which is several times faster, gives the same ids (the tests hold
    them against each other for every character). Other files go through tokenizers itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        added = {t["id"]: t["content"] for t in content.get("added_tokens", [])}
        vocabulary = content["model"]["vocab"] | {t: k for k, t in added.items()}
        byte = _byte_of_character()
        own = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            own[k] = added[k].encode() if k in added else bytes(byte[c] for c in token)
        super().__init__(own)
        merges = (m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"])
        ranked = all(vocabulary["".join(m)] == 256 + k for k, m in enumerate(merges))
        self.encode = _by_ranks(own, added) if ranked else _by_tokenizers(path)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.encode([" " + t for t in texts])


def _by_ranks(token_bytes: list[bytes], added: dict[int, str]):
    import public_tokenizers
    import tiktoken

    ranks = {b: k for k, b in enumerate(token_bytes) if k not in added}
    pattern = public_tokenizers.PATTERN
    encoding = tiktoken.Encoding(
        "own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )
    return lambda texts: list(map(encoding.encode_ordinary, texts))


def _by_tokenizers(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


class Pieces(Side):
    """A model file of the sentencepiece library, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        own = []
        for k in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(k)
            if self.model.is_byte(k):
                own.append(bytes([int(piece[1:-1], 16)]))
            else:
                own.append(piece.replace("▁", " ").encode())
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"{path}: the piece {piece} goes on over a space")
        super().__init__(own)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=4)
def side(path: str) -> Side:
    """The tokenizer of a file, loaded once by each worker."""
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


def _parts(text: str) -> list[str]:
    """A long text cut at spaces where tokens begin on both sides; those spaces are left out."""
    found, at = [], 0
    while len(text) - at > _PART:
        cut = _CUT.search(text, at + _PART)
        if cut is None:
            break
        found.append(text[at : cut.start()])
        at = cut.end()
    return [*found, text[at:]]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


@dataclass
class Aligned:
    """The alignment of some texts; tokens, groups and links of one follow those of another.

    ``a`` and ``b`` are the ids, ``a_ends`` and so on say where each text's entries end, links
    are places in ``a`` and ``b``, and texts that have no tokens have no entries.
    """

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    group_ends: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_bytes: np.ndarray
    link_ends: np.ndarray

    def shared(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``a`` and ``b`` of all tokens that share a group."""
        width = int(self.group_ends[-1]) if len(self.group_ends) else 0
        of_a, of_b = Rows.members(self.a_group, width), Rows.members(self.b_group, width)
        both = of_a.times(of_b.transposed())
        return both.row_of_entries(), both.cols


def _tokens(
    tokenizer: Side, parts: list[str], raw: list[bytes]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all parts, how many each part has, and whether its tokens give back its bytes."""
    ids = tokenizer.ids(parts) if parts else []
    of_part = np.fromiter(map(len, ids), np.int64, len(ids))
    own = np.fromiter(chain.from_iterable(ids), np.int64, int(of_part.sum()))
    pieces = list(map(tokenizer.token_bytes.__getitem__, own.tolist()))
    sums = np.concatenate(([0], np.cumsum(tokenizer.lengths[own])))
    ends = np.cumsum(of_part)
    same = sums[ends] - sums[ends - of_part] == np.fromiter(map(len, raw), np.int64, len(raw))
    if not same.all() or b"".join(pieces) != b"".join(raw):
        starts = (ends - of_part).tolist()
        same = np.array(
            [b"".join(pieces[s:e]) == r for s, e, r in zip(starts, ends.tolist(), raw, strict=True)],
            bool,
        )
    return own, of_part, same


def align_texts(texts: list[str | None], a: Side, b: Side) -> Aligned:
    """Tokens, groups and overlap links of texts.

    Texts that are null or empty, or that one side does not give back byte for byte with a
    space before them, have none.
    """
    parts = [_parts(t) if t else [] for t in texts]
    flat = list(chain.from_iterable(parts))
    part_text = np.repeat(np.arange(len(texts)), list(map(len, parts)))
    raw = [(" " + p).encode() for p in flat]
    sides = [_tokens(tokenizer, flat, raw) for tokenizer in (a, b)]
    broken = np.bincount(part_text[~(sides[0][2] & sides[1][2])], minlength=len(texts)) > 0
    kept = ~broken[part_text]
    ids, starts, ends = [], [], []
    for own, of_part, _ in sides:
        n = np.where(kept, of_part, 0)
        ids.append(own[np.repeat(kept, of_part)])
        starts.append(np.concatenate(([0], np.cumsum(n))))
        ends.append(np.cumsum(np.bincount(part_text, weights=n, minlength=len(texts))).astype(np.int64))
    (a_ids, b_ids), (a_ends, b_ends) = ids, ends
    found: list[list[np.ndarray]] = [[] for _ in range(5)]
    n_groups = 0
    for piece in by_size(raw, PIECE):  # parts begin and end with groups, so they go alone
        at_a, at_b = (int(s[piece.start]) for s in starts)
        of_a, of_b = (
            Rows.spans(tokenizer.lengths[i[s[piece.start] : s[piece.stop]]])
            for tokenizer, i, s in zip((a, b), ids, starts, strict=True)
        )
        links = of_a.times(of_b.transposed())
        cuts = np.intersect1d(of_a.ptr[1:], of_b.ptr[1:], assume_unique=True)
        groups = [np.searchsorted(cuts, m.ptr[1:]) + n_groups for m in (of_a, of_b)]
        own = *groups, links.row_of_entries() + at_a, links.cols + at_b, links.values
        for made, values in zip(found, own, strict=True):
            made.append(values)
        n_groups += len(cuts)
    a_group, b_group, link_a, link_b, link_bytes = (
        np.concatenate(v) if v else np.empty(0, np.int64) for v in found
    )
    a_ends, b_ends = (np.array(e, np.int64) for e in ends)
    group_ends = np.concatenate(([0], a_group + 1))[a_ends]
    link_ends = np.searchsorted(link_a, a_ends)
    return Aligned(
        a_ids, b_ids, a_ends, b_ends, a_group, b_group, group_ends,
        link_a, link_b, link_bytes, link_ends,
    )


@lru_cache(maxsize=4)
def _id_texts(n_a: int, n_b: int) -> list[str]:
    """Ids of both sides as text, each followed by a comma, or by what ends its list."""
    sides = (n_a, "|"), (n_b, ";")
    return [f"{i}{mark}" for n, end in sides for i in range(n) for mark in (",", end)]


def group_texts(found: Aligned, n_a: int, n_b: int) -> list[str]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
    group = np.concatenate((found.a_group, found.b_group))
    is_b = np.repeat([0, 1], [len(found.a), len(found.b)])
    order = np.argsort(group * 2 + is_b, kind="stable")
    key = (group * 2 + is_b)[order]
    last = np.append(key[1:] != key[:-1], True) if len(key) else np.empty(0, bool)
    place = np.concatenate((found.a, found.b + n_a))[order] * 2 + last
    words = _id_texts(n_a, n_b)
    texts, start = [], 0
    for end in (found.a_ends + found.b_ends).tolist():
        texts.append("".join(map(words.__getitem__, place[start:end].tolist()))[:-1])
        start = end
    return texts


class Words:
    """Counts, groups and id pairs of the words a task has seen."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.n_a, self.n_b = len(a.token_bytes), len(b.token_bytes)
        self.place: dict[str, int] = {}
        self.size = 0
        self.groups: list[str] = []
        self.counts = np.empty((len(_COUNTS), 0), np.int64)
        self.pairs = Rows(np.zeros(1, np.int64), *[np.empty(0, np.int64)] * 2, self.n_a * self.n_b)

    def places(self, words: list[str]) -> np.ndarray:
        """The place of each word here; new ones are aligned."""
        new = [w for w in dict.fromkeys(words) if w not in self.place]
        if new:
            self._learn(new)
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def _learn(self, new: list[str]) -> None:
        found = align_texts(new, self.a, self.b)
        self.place |= {w: len(self.groups) + k for k, w in enumerate(new)}
        self.size += sum(map(len, new))
        self.groups += group_texts(found, self.n_a, self.n_b)
        ends = found.a_ends, found.b_ends, found.group_ends, found.link_ends
        counts = np.stack([np.diff(e, prepend=0) for e in ends])
        self.counts = np.concatenate((self.counts, counts), axis=1)
        codes = found.a[found.link_a] * self.n_b + found.b[found.link_b]
        ptr = np.concatenate((self.pairs.ptr, self.pairs.ptr[-1] + found.link_ends))
        cols = np.concatenate((self.pairs.cols, codes))
        self.pairs = Rows(ptr, cols, np.ones(len(cols), np.int64), self.pairs.width)

    @property
    def is_full(self) -> bool:
        return len(self.place) > REMEMBERED or self.size > REMEMBERED_CHARACTERS


# Tables --------------------------------------------------------------------------------------


def _given(docs: DataFrame, made: tuple[str, ...], text_col: str) -> tuple[list[str], DataFrame]:
    others = [c for c in docs.columns if c.lower() not in made and c != text_col]
    text = F.col(f"`{text_col}`").cast("string").alias("_text")
    return others, docs.select(*[F.col(f"`{c}`") for c in others], text)


def align(
    docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", shared: bool = False
) -> DataFrame:
    """``docs`` with the tokens of both sides, their groups and their links, in place of the text.

    ``a_ids`` and ``b_ids`` are ids; ``a_group`` and ``b_group`` number the group of each token
    from 0; ``links`` are (a, b, n_bytes) with places in the id lists. With ``shared`` there are
    also ``shared_links`` (a, b) of all tokens that share a group, whose number is the product
    of the group's two sides. Rows are worked on alone; null and empty texts have empty lists.
    """
    made = ("a_ids", "b_ids", "a_group", "b_group", "links", "shared_links")
    others, given = _given(docs, made, text_col)
    link = [("a", pa.int64()), ("b", pa.int64())]
    kinds = T.StructType(given.schema.fields[:-1])
    for name in made[:4]:
        kinds = kinds.add(name, T.ArrayType(T.LongType()))
    pair = T.StructType().add("a", "long").add("b", "long")
    kinds = kinds.add("links", T.ArrayType(T.StructType(pair.fields[:]).add("n_bytes", "long")))
    if shared:
        kinds = kinds.add("shared_links", T.ArrayType(pair))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(whole.num_rows):
                batch = whole.slice(k, 1)
                found = align_texts(batch.column(len(others)).to_pylist(), side(a_path), side(b_path))
                lists = [found.a, found.b, found.a_group, found.b_group]
                columns = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in lists]
                sides = zip(found.link_a, found.link_b, found.link_bytes, strict=True)
                links = [dict(zip(("a", "b", "n_bytes"), map(int, x), strict=True)) for x in sides]
                kind = pa.list_(pa.struct([*link, ("n_bytes", pa.int64())]))
                columns.append(pa.array([links], kind))
                if shared:
                    both = zip(*(x.tolist() for x in found.shared()), strict=True)
                    pairs = [{"a": x, "b": y} for x, y in both]
                    columns.append(pa.array([pairs], pa.list_(pa.struct(link))))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *columns], names=[f.name for f in kinds.fields]
                )

    return given.mapInArrow(run, kinds)


_LISTS = {"_pairs": pa.int32(), "_times": pa.int32(), "_code": pa.int64(), "_held": pa.int64()}


class _Block:
    """Documents of a block, and the id pairs they hold."""

    def __init__(self):
        self.size = 0
        self.rows: list[pa.RecordBatch] = []
        self.counts: list[np.ndarray] = []
        self.digests: list[str] = []
        self.codes, self.times, self.ends = [], [], []

    def add(self, rows: pa.RecordBatch, texts: list[str | None], size: int, known: Words) -> None:
        words = [_CUT.split(t) if t else [] for t in texts]
        place = known.places([w for own in words for w in own])
        doc = np.repeat(np.arange(len(texts)), [len(own) for own in words])
        # a text with a word that one side does not give back has no tokens
        whole = np.bincount(doc[known.counts[0, place] == 0], minlength=len(texts)) == 0
        place, doc = place[whole[doc]], doc[whole[doc]]
        self.size += size
        self.rows.append(rows)
        counts = [
            np.bincount(doc, weights=c[place], minlength=len(texts)).astype(np.int64)
            for c in known.counts
        ]
        self.counts.append(np.stack(counts))
        groups, start = known.groups, 0
        for n in np.bincount(doc, minlength=len(texts)).tolist():
            text = ";".join(map(groups.__getitem__, place[start : start + n].tolist()))
            self.digests.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
            start += n
        n_words = len(groups)
        key, times = np.unique(doc * n_words + place, return_counts=True)
        ptr = np.searchsorted(key // max(1, n_words), np.arange(len(texts) + 1))
        pairs = Rows(ptr, key % max(1, n_words), times, n_words).times(known.pairs)
        self.codes.append(pairs.cols)
        self.times.append(pairs.values)
        self.ends.append(np.diff(pairs.ptr))

    def close(self, number: int, names: list[str]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(self.rows).combine_chunks()
        n = rows.num_rows
        code, place, held = np.unique(
            np.concatenate(self.codes), return_inverse=True, return_counts=True
        )
        ends = np.cumsum(np.concatenate(([0], *self.ends))).astype(np.int32)
        first = pa.array([0] + [len(code)] * n, pa.int32())  # the dictionary is in the first row
        lists = zip(
            (ends, ends, first, first),
            (place, np.concatenate(self.times), code, held),
            _LISTS.values(),
            strict=True,
        )
        columns = [
            *rows.combine_chunks().to_batches()[0].columns,
            *[pa.array(c, pa.int64()) for c in np.concatenate(self.counts, axis=1)],
            pa.array(self.digests, pa.string()),
            pa.array(np.full(n, number), pa.int64()),
            *[
                pa.ListArray.from_arrays(pa.array(e, pa.int32()), pa.array(v, kind))
                for e, v, kind in lists
            ],
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)


def link_counts(
    docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", block: int = BLOCK
) -> DataFrame:
    """``docs`` with counts of tokens, groups and links in place of the text.

    ``n_a``, ``n_b``, ``n_groups`` and ``n_links`` are of the document itself,
    ``groups_sha256`` the digest of its groups. The count of an id pair is the number of
    documents, over the whole table, that hold it linked: ``count_sum`` adds it up over the
    document's links, ``n_best`` says how many links have the highest count of their A id.

    Other columns pass through, those named like the results are replaced. Every row is a
    document of its own, repeated ones and those without id too. Texts without tokens (null,
    empty, or not given back byte for byte by one side) have zeros and an empty digest. A
    block holds ``block`` bytes of text, or one longer text.
    """
    made = (*_COUNTS, "groups_sha256", "n_best", "count_sum")
    others, given = _given(docs, (*made, "_block", "_text", *_LISTS), text_col)
    names = [*others, *_COUNTS, "groups_sha256", "_block", *_LISTS]
    kinds = T.StructType(given.schema.fields[:-1])
    for name in _COUNTS:
        kinds = kinds.add(name, "long")
    kinds = kinds.add("groups_sha256", "string").add("_block", "long")
    out = T.StructType(kinds.fields[:-1]).add("n_best", "long").add("count_sum", "long")
    for name, kind in _LISTS.items():
        number = T.IntegerType() if kind == pa.int32() else T.LongType()
        kinds = kinds.add(name, T.ArrayType(number))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        own, known = _Block(), Words(side(a_path), side(b_path))
        for whole in batches:
            texts = whole.column(len(others)).to_pylist()
            rows = whole.select(others)
            sizes = [t.encode() if t else b"" for t in texts]
            for part in by_size(sizes, PIECE):
                size = sum(map(len, sizes[part]))
                own.add(rows.slice(part.start, part.stop - part.start), texts[part], size, known)
                if known.is_full:
                    known = Words(known.a, known.b)
                if own.size >= block:
                    yield own.close(number, names)
                    own, number = _Block(), number + 1
        if own.rows:
            yield own.close(number, names)

    encoded = stored(given.mapInArrow(run, kinds), "aligned")
    entries = encoded.where("size(_code) > 0").selectExpr(
        "_block AS _of", "posexplode(arrays_zip(_code, _held)) AS (place, entry)"
    )
    entries = entries.select("_of", "place", "entry._code", "entry._held")
    n_b = len(side(b_path).token_bytes)
    counts = entries.groupBy("_code").agg(F.sum("_held").alias("n"))
    counts = stored(counts.withColumn("a", F.expr(f"_code div {n_b}")), "pairs")
    # as many rows as A has ids
    best = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("most")))
    counts = counts.join(best, "a").selectExpr("_code", "n", "n = most AS is_best")
    asked = entries.join(counts, "_code").select("_of", "place", "n", "is_best")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.select([*others, *_COUNTS, "groups_sha256"])
        order = np.argsort(right.column("place").to_numpy())
        n = right.column("n").to_numpy()[order]
        n_best = np.where(right.column("is_best").to_numpy(zero_copy_only=False)[order], 1, 0)
        pairs, times = (left.column(c).combine_chunks() for c in ("_pairs", "_times"))
        place, times_of = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(pairs.value_lengths().to_numpy())))
        for name, values in (("n_best", n_best), ("count_sum", n)):
            sums = np.concatenate(([0], np.cumsum(values[place] * times_of, dtype=np.int64)))
            rows = rows.append_column(name, pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64()))
        return rows

    left = encoded.drop("_code", "_held").groupBy("_block")
    return left.cogroup(asked.groupBy("_of")).applyInArrow(summed, out)
