"""Quality rules on repetition: how much of a text lies in duplicated n-grams and lines.

Rolling hashes of several n-gram lengths are computed in numpy over a document's words; characters inside n-grams that occur
again are counted once each. One narrow pass without a shuffle; memory is that of one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.shipping import in_arrow

#: White space between words, and characters counted as symbols.
WORD_SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PERCENT = 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict: shares of the characters of words that may lie in duplicated n-grams or lines or in words that
    repeat the one before, and of symbols."""

    ngram_shares: tuple[tuple[int, float], ...] = ((5, 0.25), (6, 0.25), (7, 0.24), (8, 0.24), (9, 0.23), (10, 0.23))
    line_share: float = 0.30
    stutter_share: float = 0.20
    symbol_share: float = 0.05


RULES = Rules()


def windows(ids: np.ndarray, n: int) -> np.ndarray:
    """Rolling polynomial hash of every window of n words (modulo 2**64)."""
    count = len(ids) - n + 1
    h = np.zeros(count, np.uint64)
    for k in range(n):
        h = h * _FACTOR + ids[k : k + count]
    return h


def repeated_words(ids: np.ndarray, n: int) -> np.ndarray:
    """Mask of the words that lie in a window of n words found twice or more; the first one counts too."""
    mask = np.zeros(len(ids), bool)
    if len(ids) < n:
        return mask
    h = windows(ids, n)
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    same = ranked[1:] == ranked[:-1]
    # Equal hashes are checked word by word.
    for k in range(n):
        at = np.flatnonzero(same)
        same[at] = ids[order[at] + k] == ids[order[at + 1] + k]
    again = np.zeros(len(h), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[: len(h)] += again
    edges[n : n + len(h)] -= again
    return np.cumsum(edges)[:-1] > 0


def _code_points(words: list[bytes]) -> np.ndarray:
    """Code points of each word: bytes that do not continue a character."""
    joined = np.frombuffer(b"".join(words), np.uint8)
    starts = np.concatenate(([0], np.cumsum((joined & 0xC0) != 0x80)))
    ends = np.cumsum([len(w) for w in words])
    return np.diff(np.concatenate(([0], starts[ends])))


@dataclass
class Measures:
    n_words: int = 0
    word_chars: int = 0
    n_symbols: int = 0
    n_dup_lines: int = 0
    n_repeat_words: int = 0
    dup_line_chars: int = 0
    stutter_chars: int = 0
    dup_ngram_chars: tuple[int, ...] = ()
    base_failed: bool = True
    kept: bool = False


def measure(text: bytes | None, rules: Rules = RULES) -> Measures:
    text = text or b""
    m = Measures(dup_ngram_chars=(0,) * len(rules.ngram_shares))
    words = text.split()
    m.n_words = len(words)
    if words:
        ranks = {w: i for i, w in enumerate(dict.fromkeys(words))}
        ids = np.fromiter((ranks[w] for w in words), np.uint64, len(words)) + np.uint64(1)
        chars = _code_points(words)
        m.word_chars = int(chars.sum())
        m.n_symbols = len(text) - len(text.translate(None, SYMBOLS))
        m.stutter_chars = int(chars[1:][ids[1:] == ids[:-1]].sum())
        seen: set[bytes] = set()
        for line in text.split(b"\n"):
            if line in seen:
                m.n_dup_lines += 1
                kept = line.translate(None, WORD_SPACE)
                m.dup_line_chars += len(kept.decode("utf-8", "replace"))
            elif line and not line.isspace():
                seen.add(line)
        m.n_repeat_words = int(repeated_words(ids, REPEAT_WINDOW).sum())
        # A longer n-gram can only repeat where the shortest one does.
        m.dup_ngram_chars = tuple(int(chars[repeated_words(ids, n)].sum()) if m.n_repeat_words else 0 for n, _ in rules.ngram_shares)
    m.base_failed = m.n_words < MIN_WORDS or 100 * m.n_repeat_words > MAX_REPEAT_PERCENT * m.n_words
    m.kept = not m.base_failed and verdict(m, rules)
    return m


def verdict(m: Measures, rules: Rules) -> bool:
    within = all(c <= share * m.word_chars for c, (_, share) in zip(m.dup_ngram_chars, rules.ngram_shares, strict=True))
    others = ((m.dup_line_chars, rules.line_share), (m.stutter_chars, rules.stutter_share), (m.n_symbols, rules.symbol_share))
    return within and all(c <= share * m.word_chars for c, share in others)


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", "stutter_chars"]
_FLAGS = ["base_failed", "kept"]


def _measure(rules: Rules, wanted: pa.Schema, passed: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t.as_py(), rules) for t in batch.column("_text").cast(pa.binary())]
            columns = [batch.column(c) for c in passed]
            columns += [pa.array([getattr(m, c) for m in found], pa.int64()) for c in _COUNTS]
            columns.append(pa.array([list(m.dup_ngram_chars) for m in found], pa.list_(pa.int64())))
            columns += [pa.array([getattr(m, c) for m in found], pa.bool_()) for c in _FLAGS]
            yield pa.RecordBatch.from_arrays(columns, names=[*passed, *wanted])

    return run


def measure_repetition(documents: DataFrame, rules: Rules = RULES) -> DataFrame:
    """doc_id and the measures of every document, in one row each.

    `dup_ngram_chars` goes by `rules.ngram_shares`. A null or empty text has no words and fails. Rows without `doc_id` and
    repeated rows each get their row. Lines are compared as they are, with their white space. Other columns are ignored; an
    empty table gives no rows.
    """
    ddl = ", ".join([*[f"{c} long" for c in _COUNTS], "dup_ngram_chars array<long>", *[f"{c} boolean" for c in _FLAGS]])
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("_text"))
    return in_arrow(rows, _measure(rules, [*_COUNTS, "dup_ngram_chars", *_FLAGS], ["doc_id"]), f"doc_id long, {ddl}")


def keep_by_rules(documents: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The rows of `documents` that pass, unchanged. Texts do not leave their partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            yield batch.filter(pa.array([measure(t.as_py(), rules).kept for t in texts], pa.bool_()))

    return in_arrow(documents, run, documents.schema)
