"""Byte-pair encoding and decoding with a public vocabulary.

A word starts as a doubly linked list of symbols. A priority queue holds the possible merges by rank, then position; a
merge whose symbols have changed meanwhile is stale and skipped. Decoding joins the vocabulary's strings of the ids. Words
are merged once per worker as long as they are remembered (`segments`). One narrow pass without a shuffle.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from viewpulse.llm.segments import PLAIN_LETTERS, REMEMBERED, Memo, gather, packed, segment, slices, spelled, word_cuts
from viewpulse.llm.shipping import in_arrow


class Merger:
    """Vocabulary and merge ranks of a tokenizer file whose words carry an end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        model = described["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[self.vocabulary[a], self.vocabulary[b]] = (rank, self.vocabulary[a + b])
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.strings = {i: s for s, i in [*self.vocabulary.items(), *self.specials.items()]}

    def merge(self, word: str) -> list[int]:
        """Ids of one word, given in the vocabulary's byte alphabet."""
        vocabulary, merges = self.vocabulary, self.merges
        symbols = [vocabulary[c] for c in word[:-1]]
        symbols.append(vocabulary[word[-1] + self.suffix])
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        queue = []
        for at in range(n - 1):
            found = merges.get((symbols[at], symbols[at + 1]))
            if found:
                queue.append((found[0], at, symbols[at], symbols[at + 1], found[1]))
        heapify(queue)
        while queue:
            _, at, left, right, merged = heappop(queue)
            beside = after[at]
            if symbols[at] != left or beside >= n or symbols[beside] != right:
                continue
            symbols[at], symbols[beside] = merged, -1
            after[at] = follows = after[beside]
            if follows < n:
                before[follows] = at
                found = merges.get((merged, symbols[follows]))
                if found:
                    heappush(queue, (found[0], at, merged, symbols[follows], found[1]))
            comes = before[at]
            if comes >= 0:
                found = merges.get((symbols[comes], merged))
                if found:
                    heappush(queue, (found[0], comes, symbols[comes], merged, found[1]))
        return [s for s in symbols if s >= 0]

    def text_of(self, ids: Sequence[int]) -> str:
        """Strings of the ids. The file names no decoder, so they are joined by a space, marks and specials included."""
        return " ".join(self.strings[i] for i in ids)


class Coder:
    """Encodes and decodes whole texts."""

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.merger = Merger(path)
        self.specials = [s.encode() for s in self.merger.specials]
        self.between = re.compile("(" + "|".join(map(re.escape, self.merger.specials)) + ")")
        self.memo = Memo(self._piece, REMEMBERED // 2)  # two values a segment

    def ids(self, text: str) -> list[int]:
        """Ids of any text: special tokens apart, then normalised, split into words and merged."""
        out: list[int] = []
        for part in self.between.split(text):
            if part in self.merger.specials:
                out.append(self.merger.specials[part])
            else:
                for word, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part)):
                    out += self.merger.merge(word)
        return out

    def _piece(self, piece: bytes) -> tuple[bytes, bytes]:
        """Packed ids and decoded string of a segment, which ends in the space that follows it."""
        text = piece.decode("utf-8", "replace")
        body = text.strip(" \t\n\x0b\x0c\r")
        if not body:
            return b"", b""
        found = self.merger.merge(spelled(body.lower())) if PLAIN_LETTERS.fullmatch(body) else self.ids(text)
        return packed(found), f"{self.merger.text_of(found)} ".encode() if found else b""

    def code(self, texts: Sequence[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
        """Slices of consecutive texts: ids in a row, where each text's ids begin, and the decoded texts."""
        for part in slices(texts):
            pieces = segment(part, word_cuts, self.specials)
            found = self.memo.all(pieces.values)
            ids, bounds = gather([f[0] for f in found], pieces)
            strings = [f[1] for f in found]
            codes = pieces.codes.tolist()
            bounds_of = pieces.starts.tolist()
            decoded = [b"".join([strings[c] for c in codes[a:b]])[:-1] for a, b in zip(bounds_of, bounds_of[1:], strict=False)]
            yield ids, bounds, decoded


@cache
def coder(path: str) -> Coder:
    """One per worker process."""
    return Coder(path)


def _code(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for ids, bounds, texts in coder(path).code(batch.column("text").cast(pa.binary()).to_pylist()):
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
                keys = batch.column("doc_id").slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([keys, lists, pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "ids", "decoded"])

    return run


def encode_decode(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, ids array<int> and `decoded` text of every document, for the tokenizer file at `path`.

    The file has to be readable at the same place on every worker. A null or empty text, or one of white space, has no ids
    and decodes to "". Rows without `doc_id` and repeated rows each get their row; other columns are ignored; an empty table
    gives no rows. The strings of special tokens in a text become their ids, as the library does by default.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return in_arrow(rows, _code(path), "doc_id long, ids array<int>, decoded string")
