"""Alignment against a plain walk over the library's tokens."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from monthgrain.llm import alignment
from monthgrain.llm.queries import BYTE_LEVEL, PIECES, QUERIES

TEXTS = [
    "Hello world, naïve café 12,345!  two  spaces\n\nand\tlines ",
    "",
    None,
    "<|endoftext|> and </s> are plain <unk> text",
    "日本語のテキスト \U0001f600 ok",
    " leading space",
    "Hello world, naïve café",
    "Hello world, naïve café",
    "word " * 40_000 + "  tail",
    "x" * 3000,
    "a▁b",  # the second vocabulary writes spaces like this, so its bytes differ
    "  ​\x00 odd",
]


def brute(texts):
    """Rows by a walk over bytes, with tokens from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = []
    for text in texts:
        empty = (0, 0, 0, "", Counter())
        if not text:
            rows.append(empty)
            continue
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        # a character of a byte-level token is a byte of the text
        bytes_a, at = [], 0
        for i in ids_a:
            bytes_a.append((" " + text).encode()[at : at + len(a.id_to_token(i))])
            at += len(a.id_to_token(i))
        ids_b = b.encode(text)
        bytes_b = [
            bytes([int(b.id_to_piece(i)[1:-1], 16)])
            if b.is_byte(i)
            else b.id_to_piece(i).replace("▁", " ").encode()
            for i in ids_b
        ]
        whole = (" " + text).encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            rows.append(empty)
            continue
        owner_a = [k for k, t in enumerate(bytes_a) for _ in t]
        owner_b = [k for k, t in enumerate(bytes_b) for _ in t]
        links = dict.fromkeys(zip(owner_a, owner_b))
        cuts = sorted(
            set(np.cumsum([len(t) for t in bytes_a])) & set(np.cumsum([len(t) for t in bytes_b]))
        )
        groups, start = [], 0
        for cut in cuts:
            own = [
                ",".join(str(ids[k]) for k in dict.fromkeys(owner[start:cut]))
                for ids, owner in ((ids_a, owner_a), (ids_b, owner_b))
            ]
            groups.append("|".join(own))
            start = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        pairs = Counter((ids_a[x], ids_b[y]) for x, y in links)
        rows.append((len(ids_a), len(ids_b), len(groups), digest, pairs))
    held = Counter(pair for row in rows for pair in row[4])
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    return [
        (*row[:3], row[3], sum(row[4].values()),
         sum(n for p, n in row[4].items() if held[p] == best[p[0]]),
         sum(n * held[p] for p, n in row[4].items()))
        for row in rows
    ]


@pytest.mark.parametrize("block", [1, 500, alignment.BLOCK])
def test_counts_equal_a_plain_walk(documents, block):
    docs = documents(*TEXTS)
    found = alignment.link_counts(docs.repartition(3), BYTE_LEVEL, PIECES, block=block)
    assert found.columns[:2] == ["doc_id", "lang"] and "text" not in found.columns
    names = ("n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum")
    rows = [tuple(r[c] for c in names) for r in found.orderBy("doc_id").collect()]
    assert rows == brute(TEXTS)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    found = QUERIES["op12_alignment"](spark, folder).orderBy("doc_id").collect()
    names = ("n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum")
    assert [tuple(r[c] for c in names) for r in found] == brute([r.text for r in texts])


def test_links_of_places(documents):
    rows = alignment.align(documents("naïve café 日本", None, ""), BYTE_LEVEL, PIECES, shared=True)
    first, *empty = rows.orderBy("doc_id").collect()
    a, b = alignment.side(BYTE_LEVEL), alignment.side(PIECES)
    shared = {(x, y) for x, g in enumerate(first.a_group) for y, h in enumerate(first.b_group) if g == h}
    assert {(r.a, r.b) for r in first.shared_links} == shared
    assert {(r.a, r.b) for r in first.links} <= shared
    for k, token in enumerate(first.a_ids):
        assert sum(r.n_bytes for r in first.links if r.a == k) == len(a.token_bytes[token])
    for k, token in enumerate(first.b_ids):
        assert sum(r.n_bytes for r in first.links if r.b == k) == len(b.token_bytes[token])
    assert all(not r.a_ids and not r.links and not r.shared_links for r in empty)


def test_products_equal_dense_ones():
    draw = np.random.default_rng(1)
    x, y = draw.integers(0, 3, (7, 5)), draw.integers(0, 3, (5, 6))

    def rows(dense):
        ptr = np.concatenate(([0], np.cumsum((dense > 0).sum(1))))
        return alignment.Rows(ptr, np.nonzero(dense)[1], dense[dense > 0], dense.shape[1])

    def dense(m):
        out = np.zeros((len(m.ptr) - 1, m.width), int)
        out[m.row_of_entries(), m.cols] = m.values
        return out

    assert (dense(rows(x).times(rows(y))) == x @ y).all()
    assert (dense(rows(x).transposed()) == x.T).all()


def test_empty_repeated_and_odd_rows(spark, documents):
    none = documents("x").where("false")
    assert alignment.link_counts(none, BYTE_LEVEL, PIECES).collect() == []
    odd = spark.createDataFrame(
        [(None, "same text", 1), (None, "same text", 1), (5, "same text", 2)],
        "doc_id long, text string, n_links int",
    )
    rows = alignment.link_counts(odd, BYTE_LEVEL, PIECES).collect()
    assert len(rows) == 3 and {r.count_sum for r in rows} == {3 * rows[0].n_links}
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE_LEVEL


def test_ranks_equal_the_tokenizers_library_for_every_character():
    """Inside a word, alone, doubled, and before digits and full stops."""
    ranked = alignment.side(BYTE_LEVEL)
    library = alignment._by_tokenizers(BYTE_LEVEL)
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(characters), 8192):
        texts = [f"a{c}b {c} {c}{c}1{c}." for c in characters[at : at + 8192]]
        assert ranked.ids(texts) == library([" " + t for t in texts])


def test_words_forgotten_and_learnt_again(documents, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    monkeypatch.setattr(alignment, "PIECE", 40)
    found = alignment.link_counts(documents(*TEXTS).coalesce(1), BYTE_LEVEL, PIECES)
    names = ("n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum")
    assert [tuple(r[c] for c in names) for r in found.orderBy("doc_id").collect()] == brute(TEXTS)
