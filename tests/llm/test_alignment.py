"""Alignment of two tokenizers: against both libraries on whole texts and against counting by hand."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import accumulate

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from viewpulse.llm import alignment, queries, segments

SF = "/root/testdata/sf0.001"
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

BITS = [
    "a", "B", "the", "é", "é", " ", "  ", "\n", "\n\n", "\t", "'s", "12", "...", "<s>", "<|endoftext|>", "<0x0A>", "日本", "🙂", "\x00", "ing", "tion",
    "    ", "he", "l", "o", "​", "ſ", " " * 20, "ab" * 9, "====", "----", "́", ".", " foo", "\nbar", " ", "\u0085", "a" * 40,
]


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(BYTES)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        back = {chr(c): b for b, c in segments.byte_alphabet().items()}
        self.a_bytes = lambda i: bytes(back[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text: str | None) -> list[tuple[list[int], list[int]]]:
        if not text:
            return []
        sides = [(ids, [of(i) for i in ids]) for ids, of in ((self.a.encode(f" {text}", add_special_tokens=False).ids, self.a_bytes), (self.b.encode(text), self.b_bytes))]
        if any(b"".join(x) != f" {text}".encode() for _, x in sides):
            return []
        ends = [list(accumulate(map(len, x))) for _, x in sides]
        common = sorted(set(ends[0]) & set(ends[1]))
        out = [([], []) for _ in common]
        for side, ((ids, _), own) in enumerate(zip(sides, ends, strict=True)):
            for i, group in zip(ids, np.searchsorted(common, own).tolist(), strict=True):
                out[group][side].append(i)
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def spelled(groups) -> str:
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def expected(plain: Plain, rows: list[tuple]) -> list[tuple]:
    """doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum. rows: (doc_id, text)."""
    cut = [(i, plain.groups(t)) for i, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in cut]
    count = Counter(p for c in links for p in c)
    best: dict[int, int] = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (i, g), c in zip(cut, links, strict=True):
        top = sum(n for p, n in c.items() if count[p] == best[p[0]])
        total = sum(n * count[p] for p, n in c.items())
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), spelled(g), top, total))
    return sorted(out, key=repr)


def found(rows) -> list[tuple]:
    names = "doc_id n_a n_b n_groups n_links groups n_best count_sum".split()
    return sorted((tuple(r[n] for n in names) for r in rows), key=repr)


def test_products_are_those_of_full_matrices(monkeypatch):
    r = np.random.default_rng(4)
    for products in (1, 7, 1 << 20):
        monkeypatch.setattr(alignment, "PRODUCTS", products)
        for _ in range(20):
            a, b = r.integers(0, 3, (r.integers(0, 9), 7)), r.integers(0, 2, (7, r.integers(1, 9)))
            sparse = [alignment.incidence(*np.nonzero(m), m.shape) for m in (a > 0, b)]
            got = alignment.product(*sparse)
            dense = np.zeros((len(a), b.shape[1]), int)
            dense[got.rows, got.columns] = got.values
            assert (dense == (a > 0).astype(int) @ b).all() and (got.values > 0).all()


def test_overlaps_and_groups():
    shared = alignment.overlaps(np.array([2, 1, 4, 1]), np.array([1, 2, 3, 2]))
    assert [(i, j, v) for i, j, v in zip(shared.rows, shared.columns, shared.values)] == [(0, 0, 1), (0, 1, 1), (1, 1, 1), (2, 2, 3), (2, 3, 1), (3, 3, 1)]
    assert [x.tolist() for x in alignment.groups_of(shared)] == [[0, 0, 1, 1], [0, 0, 1, 1]]


def test_alignment_of_odd_texts(spark, plain):
    r = random.Random(3)
    texts = ["".join(r.choice(BITS) for _ in range(r.randint(0, 14))) for _ in range(1500)]
    texts += [None, "", " ", "  ", "\n", " \n", "▁x a b", "a ▁b", "x﻿y", *["said twice"] * 3]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found(alignment.align(docs, BYTES, PIECES).collect()) == expected(plain, rows)


def test_query(spark, plain):
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = expected(plain, [tuple(g) for g in given])
    rows = queries.op12_alignment(spark, SF).collect()
    got = sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) for r in rows), key=repr)
    assert got == [(*w[:5], brute.sha(w[5]) if w[5] else "", *w[6:]) for w in want]


def test_awkward_rows(spark, plain):
    docs = brute.awkward_documents(spark)
    rows = [tuple(d) for d in docs.select("doc_id", "text").collect()]
    assert found(alignment.align(docs, BYTES, PIECES).collect()) == expected(plain, rows)
    assert alignment.align(brute.empty_documents(spark), BYTES, PIECES).count() == 0
    bare = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert found(alignment.align(bare, BYTES, PIECES).collect()) == [(1, 0, 0, 0, 0, "", 0, 0), (2, 0, 0, 0, 0, "", 0, 0)]
