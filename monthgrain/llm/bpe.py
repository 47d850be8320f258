"""BPE encoding and decoding with a word vocabulary, by a contiguous rank array.

The vocabulary file is read once on the driver and broadcast (its size is that of the file).
Tasks read texts in Arrow batches; pieces between white space are encoded once per task and
looked up afterwards in a table of bounded size.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Words of more symbols are merged with a heap instead of repeated scans.
LONG_WORD = 256
#: Words of up to so many bytes are merged side by side.
SHORT_WORD = 64
#: Pieces remembered by one task.
REMEMBERED = 200_000
#: White space of the vocabulary's own pattern engine; Python's also has U+001C to U+001F.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CONTROL = re.compile("[\x1c-\x1f]")
#: Fixed values of the vocabulary library's Unicode version: letters and numbers that it does not
#: have yet, and capitals that Python's ``lower`` may not know (ranges by distance, and single ones).
LATER_LETTERS = (
    "\u0558 \u058b-\u058c \u088f \u0c5c \u0cdc \u208f \u209d-\u209f \ua7ce-\ua7cf \ua7d2 \ua7d4 \ua7dd \ua7e2 "
    "\ua7f1 \uab6c-\uab6d \U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 "
    "\U00010ed9-\U00010eee \U00011b0a \U00011db0-\U00011ddb \U00011df1 \U00016ea0-\U00016eb8 "
    "\U00016ebb-\U00016ed3 \U00016ff2-\U00016ff3 \U000187f8-\U000187ff \U00018cd6-\U00018cda "
    "\U00018d09-\U00018d20 \U00018d80-\U00018df2 \U00018e00-\U00019191 \U000191a0-\U000191d2 "
    "\U0001b123-\U0001b128 \U0001b168 \U0001d6a6 \U0001df1f-\U0001df24 \U0001df2b-\U0001df81 "
    "\U0001df90-\U0001df96 \U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de \U0001e6e0-\U0001e6e2 "
    "\U0001e6e4-\U0001e6e5 \U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 \U0001e6fe-\U0001e6ff "
    "\U0002b73a-\U0002b73f \U0002b81e \U0002cea2-\U0002cead \U000323b0-\U00033479 \U0003d000-\U0003fc3f"
)
LATER_NUMBERS = (
    "\U00011de0-\U00011de9 \U0001246f \U00012475-\U0001247f \U00012550-\U00012686 \U00016ff4-\U00016ff6"
)
CAPITAL_RANGES = [(0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B)]
CAPITALS = {
    "\u1c89": "\u1c8a",
    "\ua7cb": "\u0264",
    "\ua7cc": "\ua7cd",
    "\ua7ce": "\ua7cf",
    "\ua7d2": "\ua7d3",
    "\ua7d4": "\ua7d5",
    "\ua7da": "\ua7db",
    "\ua7dc": "\u019b",
}
LOWER = str.maketrans(
    CAPITALS | {chr(c): chr(c + by) for a, z, by in CAPITAL_RANGES for c in range(a, z + 1)}
)
NEWER = re.compile("[" + "".join(map(chr, LOWER)) + "]")
BLANK = re.compile(f"[{SPACE}]+")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in plain}
    rest = (b for b in range(256) if b not in names)
    names |= {b: chr(256 + k) for k, b in enumerate(rest)}
    return [names[b] for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary in the JSON form of the tokenizers library.

    Supports what word vocabularies of that form use: NFC, white space, lower case, a split
    pattern, byte symbols, an end-of-word suffix, and special tokens matched in the raw text.
    """

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special = special
        self.at_special = re.compile(
            "(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")"
        )
        pattern = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        pattern = pattern.replace(r"\s", SPACE)
        for kind, later in ((r"\p{L}", LATER_LETTERS), (r"\p{N}", LATER_NUMBERS)):
            pattern = pattern.replace(kind, f"[{kind}--[{later.replace(' ', '')}]]")
        self.words = regex.compile(pattern, regex.VERSION1)
        symbols = _byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + self.suffix] for s in symbols]
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for left, right in (m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            self.rank[vocab[left], vocab[right]] = len(self.merged)
            self.merged.append(vocab[left + right])
        self.token = [""] * (1 + max([*vocab.values(), *special.values()]))
        for name, i in [*vocab.items(), *special.items()]:
            self.token[i] = name
        self.inner_at, self.last_at = np.array(self.inner), np.array(self.last)
        self.merged_at = np.array(self.merged)
        pairs = np.array([a * len(self.token) + b for a, b in self.rank])
        order = np.argsort(pairs)
        self.pairs, self.pair_rank = pairs[order], order
        self.known: dict[str, bytes] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Symbols of one word to tokens; the lowest rank goes first, the leftmost of equals."""
        if len(ids) > LONG_WORD:
            return self._merge_long(ids)
        rank, none = self.rank.get, len(self.merged)
        ranks = [rank(pair, none) for pair in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < none:
            at = ranks.index(least)
            ids[at] = self.merged[least]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank((ids[at - 1], ids[at]), none)
            if at < len(ranks):
                ranks[at] = rank((ids[at], ids[at + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same result with a heap over linked parts."""
        n, rank = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank((ids[i], ids[j])) != r:
                continue
            ids[i], ids[j] = self.merged[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (s := rank((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (s, i))
            if (h := before[i]) >= 0 and (s := rank((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (s, h))
        return [i for i in ids if i >= 0]

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Token ids of many words at once: one row of parts and ranks for each word.

        Column 0 stands before a word and the column after its last symbol behind it; both
        have no rank with anything. Parts are linked, so that a merge deletes one boundary
        and looks up the two ranks beside it.
        """
        n, none = len(words), len(self.merged)
        length = np.fromiter(map(len, words), np.int64, n)
        wide = int(length.max(initial=0)) + 2
        column = np.arange(wide)
        inside = (column >= 1) & (column <= length[:, None])
        ids = np.full((n, wide), -1, np.int32)
        ids[inside] = self.inner_at[np.frombuffer(b"".join(words), np.uint8)]
        row = np.arange(n)
        final = np.array([w[-1] for w in words], np.uint8)
        ids[row, length] = self.last_at[final]
        after = np.tile((column + 1).astype(np.int32), (n, 1))
        before = np.tile((column - 1).astype(np.int32), (n, 1))
        ranks = np.full((n, wide), none, np.int32)
        ranks[:, :-1] = self._ranks(ids[:, :-1], ids[:, 1:])
        out: list[bytes] = [b""] * n
        word = np.arange(n)
        while len(word):
            at = ranks.argmin(1)
            least = ranks[row, at]
            live = least < none
            if not live.all():
                for k, got in zip(word[~live], ids[~live], strict=True):
                    out[k] = got[got >= 0].astype("<u4").tobytes()
                ids, ranks, after, before = ids[live], ranks[live], after[live], before[live]
                word, at, least = word[live], at[live], least[live]
                row = np.arange(len(word))
            right = after[row, at]
            left, beyond = before[row, at], after[row, right]
            joined = self.merged_at[least]
            ids[row, at], ids[row, right], ranks[row, right] = joined, -1, none
            after[row, at], before[row, beyond] = beyond, at
            ranks[row, at] = self._ranks(joined, ids[row, beyond])
            ranks[row, left] = self._ranks(ids[row, left], joined)
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; the number of merges where a pair has none."""
        pair = left.astype(np.int64) * len(self.token) + right
        pair[(left < 0) | (right < 0)] = -1
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.pair_rank[at], len(self.merged))

    def learn(self, pieces: list[str]) -> None:
        """Encodes pieces that are not yet known, their words side by side by length."""
        split = [[p] if p.isalpha() else self.words.findall(p) for p in pieces]
        words = {w: w.encode() for group in split for w in group}
        short: dict[int, list[str]] = {}
        done: dict[str, bytes] = {}
        for w, raw in words.items():
            if len(raw) <= SHORT_WORD:
                short.setdefault((len(raw) + 3) // 4, []).append(w)
            else:
                *head, tail = raw
                ids = self.merge([*(self.inner[b] for b in head), self.last[tail]])
                done[w] = np.array(ids, "<u4").tobytes()
        for group in short.values():
            for at in range(0, len(group), 4096):
                part = group[at : at + 4096]
                done.update(zip(part, self.merge_words([words[w] for w in part]), strict=True))
        for p, group in zip(pieces, split, strict=True):
            self.known[p] = b"".join([done[w] for w in group])

    def _pieces(self, text: str) -> list[str]:
        """Normalised text, cut where no word can cross."""
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # each character by itself: no final sigma
        text = text.replace("Σ", "σ").lower()
        if not text.isascii() and NEWER.search(text):
            text = text.translate(LOWER)
        if CONTROL.search(text):
            return [p for p in BLANK.split(text) if p]
        return text.split()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as unsigned little-endian 32-bit numbers."""
        parts = [self.at_special.split(t) if self.special else [t] for t in texts]
        cut = [[p if k % 2 else self._pieces(p) for k, p in enumerate(own)] for own in parts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        fresh = {p for own in cut for part in own[::2] for p in part if p not in known}
        self.learn(list(fresh))
        out = []
        for own in cut:
            found = [
                b"".join([known[p] for p in part])
                if k % 2 == 0
                else np.array([self.special[part]], "<u4").tobytes()
                for k, part in enumerate(own)
            ]
            out.append(b"".join(found))
        return out

    def encode(self, text: str) -> bytes:
        """Token ids of one text."""
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        return joined(self.token, ids)


def joined(token: list[str], ids: bytes) -> str:
    """The tokens with a space between each two, as the vocabulary names no decoder."""
    return " ".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


@lru_cache(maxsize=2)
def _loaded(spec: str) -> WordBpe:
    return WordBpe(spec)


@lru_cache(maxsize=2)
def _tokens(spec: str) -> list[str]:
    """The names of the tokens by id, which is all that decoding needs."""
    data = json.loads(spec)
    names = {i: name for name, i in data["model"]["vocab"].items()}
    names |= {t["id"]: t["content"] for t in data["added_tokens"]}
    return [names.get(i, "") for i in range(1 + max(names))]


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def _column(df: DataFrame, name: str) -> str:
    """A name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def encode(
    df: DataFrame, vocabulary: str, text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """``df`` without its text column, with n_tokens and token_ids (binary, 32 bits each).

    With ``decoded`` there is the column of ``decode``, too; one Python worker makes both, where
    ``decode`` on top needs a second one that holds a vocabulary.

    Null counts as empty and gives no tokens. Special tokens written out in a text become
    their ids. Other columns pass through, but replaced ones named like a new one.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())
    new = ["n_tokens", "token_ids", *["decoded"] * decoded]
    others = [c for c in df.columns if c.lower() not in [*new, text_col.lower()]]
    text = _column(df, "text_in")
    given = df.selectExpr(*[f"`{c}`" for c in others], f"cast(`{text_col}` as string) `{text}`")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(spec.value)
        for batch in (b for whole in batches for b in _slices(whole)):
            ids = bpe.encode_all([t or "" for t in batch.column(len(others)).to_pylist()])
            counts = pa.array([len(i) // 4 for i in ids], pa.int64())
            columns = [batch.column(k) for k in range(len(others))]
            columns += [counts, pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array([bpe.decode(i) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*others, *new])

    schema = df.select(*[f"`{c}`" for c in others]).schema
    schema = schema.add("n_tokens", "long").add("token_ids", "binary")
    schema = schema.add("decoded", "string") if decoded else schema
    return given.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str) -> DataFrame:
    """``df`` of ``encode`` with the column decoded; null token_ids give an empty text."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())
    others = [c for c in df.columns if c.lower() != "decoded"]
    at = [c.lower() for c in others].index("token_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _tokens(spec.value)
        for batch in (b for whole in batches for b in _slices(whole)):
            texts = [joined(token, i or b"") for i in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*others, "decoded"]
            )

    schema = df.select(*[f"`{c}`" for c in others]).schema.add("decoded", "string")
    return df.select(*[f"`{c}`" for c in others]).mapInArrow(run, schema)
