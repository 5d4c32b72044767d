"""Token counts by the transducer: against the sentencepiece library, however texts are cut."""

from __future__ import annotations

import random

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from viewpulse.llm import queries, transducer

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")

BITS = [
    "a", "B", "the", "é", "é", " ", "  ", "\n", "\t", "▁", "▁▁", "'s", "12", "...", "<s>", "</s>", "<0x0A>", "<unk>", "日本", "🙂", "\x00", "ing", "tion",
    "    ", "he", "l", "o", "w", "or", "ld", "​", "ſ", " " * 20, "ab" * 9, "====", "----", "́", "﻿", " ", "�",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(17)
    return ["".join(r.choice(BITS) for _ in range(r.randint(0, 30))) for _ in range(4000)] + [None, "", " ", " " * 150]


@pytest.mark.parametrize("size, chunk", [(1 << 21, 1024), (1000, 30), (60, 5), (7, 2)])
def test_counts_are_the_librarys(library, texts, monkeypatch, size, chunk):
    monkeypatch.setattr(transducer, "SLICE", size)
    monkeypatch.setattr(transducer, "CHUNK", chunk)
    some = texts if size > 100 else texts[-1500:]
    assert list(transducer.transducer(PIECES).counts(some)) == [len(library.encode(t or "")) for t in some]


def test_forgetting_states_changes_nothing(library, texts, monkeypatch):
    monkeypatch.setattr(transducer, "MOST_STATES", 200)
    monkeypatch.setattr(transducer, "SLICE", 500)
    own = transducer.Transducer(PIECES)
    assert list(own.counts(texts[:1000])) == [len(library.encode(t or "")) for t in texts[:1000]]


def test_chunk_maps_compose(texts, monkeypatch):
    """A map entered in any border state says what a run from there gives; the scan says what the whole run gives."""
    monkeypatch.setattr(transducer, "CHUNK", 20)
    own = transducer.transducer(PIECES)
    text = own._symbols("".join(t or "" for t in texts[:60]))
    begins, at, added, states = own.chunk_maps(text, np.zeros(1, np.int64), np.array([own.start]))
    ends = np.append(begins[1:], len(text))
    for i in range(1, len(begins)):
        for k, border in enumerate(own.borders):
            assert own._one(border, text[begins[i] : ends[i]].tolist()) == (states[i, k], added[i, k])
    total, place = transducer.scan(at, added)
    for i in range(len(begins) - 1):
        state, tokens = own._one(own.start, text[: ends[i]].tolist())
        assert (state, tokens) == (own.borders[place[i, 0]], total[i, 0])


def test_long_texts_without_borders(library):
    r = random.Random(2)
    for text in ("x" * 30_000, "".join(r.choice("abcdefghij日本語テキスト") for _ in range(30_000)), "=" * 9999, " " * 20_000):
        assert list(transducer.transducer(PIECES).counts([text])) == [len(library.encode(text))]


def test_query(spark, library):
    given = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op11_token_counts(spark, SF).collect()
    assert len(rows) == len(given)
    for r in rows:
        n = len(library.encode(given[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(given[r.doc_id].encode()), n, n > 4096)


def test_awkward_rows(spark, library):
    docs = brute.awkward_documents(spark)
    rows = transducer.count_tokens(docs, PIECES).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(library.encode(d.text or "")) for d in docs.collect())
    assert [(r.n_bytes, r.n_tokens, r.over_limit) for r in rows if r.doc_id in (1, 2)] == [(0, 0, False)] * 2
    assert sum(r.over_limit for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 2
    assert transducer.count_tokens(brute.empty_documents(spark), PIECES).count() == 0
