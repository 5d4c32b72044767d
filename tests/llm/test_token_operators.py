"""BPE, token files, packing: against the tokenizers library, and on awkward rows."""

from __future__ import annotations

import random
import subprocess
import sys
import zlib
from itertools import pairwise
from pathlib import Path

import brute
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from viewpulse.llm import bpe, packing, queries, segments, token_files

SF = "/root/testdata/sf0.001"
WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")

#: Pieces at whose joints a tokenizer may or may not cut.
BITS = [
    "a", "B", "the", "é", "é", "≠", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "\u0085", "'s", "'", "'S", "''ll", "12", "³", "½",
    ".", "...", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "Σ", "ΑΣ", "İ", "ß", "日本", "🙂", "\x00", "\x1c", "#", "-", "​", "ſ", "K", "﻿",
]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    return ["".join(r.choice(BITS) for _ in range(r.randint(0, 14))) for _ in range(3000)] + [None, "", " "]


def library(path: str, given: list) -> list[list[int]]:
    return [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in given], add_special_tokens=False)]


def coded(parts) -> list[list[int]]:
    return [ids[a:b].tolist() for ids, bounds, *_ in parts for a, b in pairwise(bounds)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_segments_give_the_librarys_ids(texts, path):
    raw = [t if t is None else t.encode() for t in texts]
    assert coded(segments.LibraryEncoder(path).encode(raw)) == library(path, texts)


def test_own_merges_give_the_librarys_ids(texts):
    raw = [t if t is None else t.encode() for t in texts]
    want = library(WORD, texts)
    parts = list(bpe.Coder(WORD).code(raw))
    assert coded(parts) == want
    decode = Tokenizer.from_file(WORD).decode
    assert [t.decode() for _, _, some in parts for t in some] == [decode(ids, skip_special_tokens=False) for ids in want]


def test_small_slices_change_nothing(texts, monkeypatch):
    raw = [t if t is None else t.encode() for t in texts[:500]]
    whole = coded(segments.LibraryEncoder(BYTE).encode(raw))
    monkeypatch.setattr(segments, "SLICE_BYTES", 50)
    monkeypatch.setattr(segments, "REMEMBERED", 20)
    assert coded(segments.LibraryEncoder(BYTE).encode(raw)) == whole


def test_bpe_query(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids = dict(zip([r.doc_id for r in given], library(WORD, [r.text for r in given]), strict=True))
    decode = Tokenizer.from_file(WORD).decode
    for r in queries.op3_bpe(spark, SF).collect():
        own = ids[r.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(own), brute.sha(" ".join(map(str, own))))
        assert r.decoded_sha256 == brute.sha(decode(own, skip_special_tokens=False))


def test_bpe_of_awkward_rows(spark):
    docs = brute.awkward_documents(spark)
    out = bpe.encode_decode(docs, WORD).collect()
    want = library(WORD, [r.text for r in docs.collect()])
    assert sorted(list(r.ids) for r in out) == sorted(want)
    assert [r.decoded for r in out if r.doc_id in (1, 2, 3)] == ["", "", ""]
    assert bpe.encode_decode(brute.empty_documents(spark), WORD).count() == 0


def packed_rows(pieces) -> None:
    """Every sequence is gapless from 0 and no longer than the window."""
    by: dict[int, list] = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append(p)
    for own in by.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [0, *np.cumsum([p.length for p in own])[:-1].tolist()]
        assert sum(p.length for p in own) <= packing.WINDOW and min(p.length for p in own) > 0


def covered(pieces, ids: dict) -> None:
    """The pieces of a document are all its ids, each once."""
    by: dict[int, list] = {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
    assert set(by) == set(ids)
    for i, own in by.items():
        own.sort(key=lambda p: p.start)
        whole = np.array([*ids[i], packing.END_ID], np.uint32)
        assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1].tolist()]
        assert sum(p.length for p in own) == len(whole) == own[0].doc_tokens
        assert all(p.ids_crc32 == zlib.crc32(whole[p.start : p.start + p.length].tobytes()) for p in own)


def test_packing_query(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    pieces = queries.op4_packing(spark, SF).collect()
    packed_rows(pieces)
    covered(pieces, dict(zip([r.doc_id for r in given], library(BYTE, [r.text for r in given]), strict=True)))
    n = len({p.sequence_id for p in pieces})
    assert sum(p.length for p in pieces) > 0.99 * n * packing.WINDOW


def test_packing_joins_related_documents(spark):
    r = random.Random(3)
    topics = [[f"{a}{b}" for a in "bcdfg" for b in stems] for stems in (["olar", "atio"], ["unge", "irst"], ["emel", "okka"])]
    rows = [(i, " ".join(r.choice(topics[i % 3]) for _ in range(60))) for i in range(180)]
    pieces = packing.pack_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), BYTE).collect()
    packed_rows(pieces)
    by: dict[int, list[int]] = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append(p.doc_id % 3)
    same = sum(max(map(t.count, range(3))) for t in by.values())
    assert same > 0.85 * len(pieces)


def test_packing_finds_beyond_512_documents(spark):
    """Documents of a topic whose heaviest terms differ lie far apart in a shard's order; a window's seed still finds them."""
    words = sorted(t[1:] for t in Tokenizer.from_file(BYTE).get_vocab() if t.startswith("Ġ") and t[1:].isascii() and t[1:].isalpha() and t[1:].islower() and len(t) > 4)
    r = random.Random(8)
    r.shuffle(words)
    topics, own = [words[k * 30 : k * 30 + 30] for k in range(80)], words[2400:]
    rows = [(i, " ".join(["", *[own[i]] * 30, *r.sample(topics[i % 80], 28)])) for i in range(80 * 18)]
    pieces = packing.pack_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), BYTE).collect()
    packed_rows(pieces)
    covered(pieces, dict(zip([i for i, _ in rows], library(BYTE, [t for _, t in rows]), strict=True)))
    by: dict[int, list[int]] = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append(p.doc_id % 80)
    same = sum(max(t.count(k) for k in t) for t in by.values())
    assert same > 0.75 * len(pieces), same / len(pieces)


def test_packing_gives_leftovers_a_second_round():
    """What finds nothing related in its shard is given back whole, and packed with anything in the last round."""
    corpus = packing.Corpus(np.array([0.1, 2, 2, 2, 2, 2]), 100.0)
    terms = [np.array(t, np.uint16) for t in ([0, 1], [0, 1], [0, 2], [0, 3])]
    docs = [packing.Document(i, 60, np.full(60, i, np.uint16), t, np.ones(2, np.uint32)) for i, t in enumerate(terms)]
    windows = packing.Windows(0, 100)
    left = windows.block(corpus, docs, last=False)
    assert {p[0] for p in windows.pieces} == {0, 1} and sum(p[2] for p in windows.pieces) == 100
    assert sorted((d.doc_id, len(d.tail)) for d in left) == [(1, 20), (2, 60), (3, 60)]
    last = packing.Windows(1, 100)
    assert last.block(corpus, left, last=True) == [] and sum(p[2] for p in last.pieces) == 140


def test_index_ranks_by_bm25():
    docs = [np.array(t, np.uint16) for t in ([1, 2, 3], [2, 4], [5], [1, 2])]
    counts = [np.array(c, np.uint16) for c in ([1, 1, 4], [2, 1], [3], [1, 1])]
    tokens = [6, 3, 3, 2]
    df = np.bincount(np.concatenate(docs), minlength=8)
    corpus = packing.Corpus(np.log1p((4 - df + 0.5) / (df + 0.5)), 3.5)
    index = packing.Index(corpus, docs, counts, tokens)
    want = [sum(corpus.weights(t[k : k + 1], c[k : k + 1].astype(float), n)[0] for k in range(len(t)) if t[k] in (1, 2)) for t, c, n in zip(docs, counts, tokens, strict=True)]
    assert index.neighbours(np.array([1, 2], np.uint16)).tolist() == sorted(range(4), key=lambda i: -want[i])
    index.unused[3] = False
    assert 3 not in index.neighbours(np.array([1, 2, 7], np.uint16))


@pytest.mark.parametrize("frequent", [1, 6, 1000])
def test_the_ranking_is_that_of_scores_added_by_hand(monkeypatch, frequent):
    """Rows, postings and shrinking change neither which documents come first nor their order."""
    monkeypatch.setattr(packing, "FREQUENT", frequent)
    r = np.random.default_rng(6)
    for n in (3, 70, 400):
        chance = np.concatenate([np.full(20, 0.8), np.full(150, 0.06)])
        has = r.random((n, len(chance))) < chance
        has[:, 0] = True
        has[1] = has[0]
        docs = [np.flatnonzero(row).astype(np.uint16) for row in has]
        counts = [r.integers(1, 9, len(d)).astype(np.uint32) for d in docs]
        counts[1] = counts[0]
        tokens = r.integers(20, 200, n)
        tokens[1] = tokens[0]
        df = has.sum(0)
        corpus = packing.Corpus(np.log1p((n - df + 0.5) / (df + 0.5)), 60.0)
        index = packing.Index(corpus, docs, counts, tokens.tolist())
        weights = np.zeros(has.shape)
        for i in range(n):
            weights[i, docs[i]] = corpus.weights(docs[i], counts[i].astype(float), tokens[i])
        for seed in range(n):
            index.unused[seed] = False
            score = np.round(weights[:, docs[seed]].sum(1), 9)
            shares = has[:, has[seed] & corpus.telling].any(1)
            want = [i for i in np.argsort(-score, kind="stable").tolist() if index.unused[i]]
            assert np.round(score[index.neighbours(docs[seed])], 9).tolist() == score[want].tolist()
            for most in (1, 5, 64):
                got = index.neighbours(docs[seed], related=True, most=most).tolist()
                near = [i for i in want if shares[i]]
                assert score[got].tolist() == score[near[: len(got)]].tolist() and all(shares[got])
                assert len(got) >= min(most, len(near))
            if seed % 7 == 0:
                index.shrink()


def test_packing_of_awkward_rows(spark):
    docs = brute.awkward_documents(spark)
    pieces = packing.pack_documents(docs, BYTE, block_docs=3).collect()
    packed_rows(pieces)
    ids = library(BYTE, [r.text for r in docs.collect()])
    assert sum(p.length for p in pieces) == sum(map(len, ids)) + len(ids)
    assert sum(p.doc_id is None for p in pieces) >= 2
    assert packing.pack_documents(brute.empty_documents(spark), BYTE).count() == 0


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, tmp_path, encoding):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    target = str(tmp_path / "tokens")
    layout = token_files.Layout(encoding=encoding, row_group_bytes=256 << 10, page_bytes=8 << 10)
    token_files.write_tokens(given, target, WORD, end_id=2, files=3, layout=layout)
    rows = sorted(given.select("doc_id", "text").collect())
    start, want = 0, {}
    for r, ids in zip(rows, library(WORD, [r.text for r in rows]), strict=True):
        ended = np.array([*ids, 2], np.uint32)
        want[r.doc_id] = (start, len(ended), zlib.crc32(ended.tobytes()))
        start += len(ended)
    found = token_files.checksums(token_files.read_tokens(spark, target)).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in found} == want
    some = token_files.read_tokens(spark, target, 20, 29, ids=False).collect()
    assert {r.doc_id: r.start for r in some} == {i: w[0] for i, w in want.items() if 20 <= i <= 29}
    files = sorted((tmp_path / "tokens").glob("part-*.parquet"))
    kept = [pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist() for f in files]
    assert sum(kept, []) == [r.doc_id for r in rows]
    ids = [pq.ParquetFile(f).metadata.row_group(0).column(4) for f in files]
    assert all(c.has_column_index and c.has_offset_index for c in ids)
    assert all(("RLE_DICTIONARY" if encoding == "dictionary" else "DELTA_BINARY_PACKED") in c.encodings for c in ids)


def test_token_files_of_awkward_rows(spark, tmp_path):
    docs = brute.awkward_documents(spark)
    target = str(tmp_path / "tokens")
    token_files.write_tokens(docs, target, WORD, end_id=2)
    rows = token_files.read_tokens(spark, target).collect()
    want = sorted([*ids, 2] for ids in library(WORD, [r.text for r in docs.collect()]))
    assert sorted(list(r.ids) for r in rows) == want
    spans = sorted((r.start, r.n_tokens) for r in rows)
    assert [s for s, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1].tolist()]
    assert max(r.start for r in rows if r.doc_id is None) < min(r.start for r in rows if r.doc_id is not None)
    token_files.write_tokens(brute.empty_documents(spark), str(tmp_path / "none"), WORD, end_id=2)
    assert token_files.checksums(token_files.read_tokens(spark, str(tmp_path / "none"))).count() == 0


def test_an_index_soon_lets_go_of_used_documents():
    """It held them until they were half, and each window's ranking went over them."""
    docs = [np.array([0, 1 + i], np.uint16) for i in range(40)]
    corpus = packing.Corpus(np.full(41, 1.0), 2.0)
    index = packing.Index(corpus, docs, [np.ones(2, np.uint32)] * 40, [2] * 40)
    index.unused[:12] = False
    index.shrink()
    assert index.held.tolist() == list(range(12, 40))
    assert sorted(index.neighbours(docs[0])) == list(range(12, 40))


@pytest.mark.parametrize("n", [1, 5, 70_000])
def test_terms_of_many_documents_at_once(n):
    """Documents beyond 16 bits too; the largest id is 65,535."""
    r = np.random.default_rng(n)
    bounds = np.concatenate([[0], np.cumsum(r.integers(1, 5, n))])
    ids = np.where(r.random(bounds[-1]) < 0.5, 65_535, r.integers(0, 3, bounds[-1])).astype(np.uint32)
    terms, counts = packing._terms(ids, bounds)
    for i in {*range(0, n, 997), n - 1}:
        t, c = np.unique(ids[bounds[i] : bounds[i + 1]], return_counts=True)
        assert np.frombuffer(terms[i].as_py(), "<u2").tolist() == t.tolist() and np.frombuffer(counts[i].as_py(), "<u4").tolist() == c.tolist()


def test_a_worker_hands_freed_memory_back():
    """Freed below something that stays, it was kept by the worker for as long as that lived."""
    code = """
import numpy as np
from viewpulse.llm import shipping

def held():
    return int(open("/proc/self/statm").read().split()[1]) * 4096 / 1e6

stays = []

def work(batches):
    made = [np.ones(100_000, np.uint8) for _ in range(2000)]
    stays.append(np.ones(100_000, np.uint8))
    yield from batches

before = held()
list(getattr(shipping, "tidied", lambda f: f)(work)(iter([1])))
print(held() - before)
"""
    root = Path(packing.__file__).resolve().parents[2]
    run = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert float(run.stdout) < 50


def test_new_ascii_words_go_straight_to_the_model(monkeypatch):
    """Each new word was stripped, matched and spelled first."""
    words = [b"plain", b" plain", b" Ingrandou", b"x", b" x", b"hahehe" * 7]
    encoder = segments.LibraryEncoder(BYTE)
    monkeypatch.setattr(segments, "PLAIN_LETTERS", None)
    monkeypatch.setattr(segments, "spelled", None)
    found = [np.frombuffer(v, np.uint32).tolist() for v in encoder.memo.all(words)]
    assert found == [encoder.tokenizer.encode(w.decode(), add_special_tokens=False).ids for w in words]
    assert encoder.memo.all(words) == [encoder.memo.known[w] if len(w) <= segments.SHORT else encoder._ids(w) for w in words]
    # A wide space behind a space is no certain cut, another character beyond ASCII is.
    text = "a \u3000b \u00e9c \u20acd  e".encode()
    cuts = np.flatnonzero(segments.byte_cuts(np.frombuffer(text, np.uint8), np.array([len(text)]))).tolist()
    assert [text[i : i + 3] for i in cuts] == [" \u00e9".encode(), b" e"]
