"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A text is read as its distinct words in lower case. Every n-gram of characters inside a word, word ends included, adds its
weight; n-grams share a fixed number of hashed weights. A weight is the product of the n-gram's log-count ratio between
toxic and other training texts and a coefficient fitted by logistic regression.

The fit uses a bounded sample of labelled rows: up to `Training.toxic` and `Training.others` documents, the first by a hash
of their id, so it is the same in every run and does not grow. The sample's ids are broadcast to find its texts, so no text
is shuffled, neither to train nor to score. Scoring is one narrow pass over all whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.segments import segment, slices, word_cuts
from viewpulse.llm.shipping import in_arrow


@dataclass(frozen=True)
class Training:
    """Bounds of the sample and settings of the fit."""

    toxic: int = 800
    others: int = 1600
    ngrams: tuple[int, ...] = (4, 5, 6, 7, 8)
    buckets: int = 1 << 20
    min_documents: int = 3
    smoothing: float = 1.0
    penalty: float = 1.0
    steps: int = 20


TRAINING = Training()


@dataclass(frozen=True)
class Model:
    ngrams: tuple[int, ...]
    weights: np.ndarray
    bias: float


def ngram_buckets(words: Sequence[str], ngrams: Sequence[int], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of every word, and the index of its word. Words are padded with a space on either side."""
    joined = " " + "  ".join(words) + " "
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    word_of = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    found, owners = [], []
    hashes = np.zeros(len(chars), np.uint64)
    for n in range(1, max(ngrams) + 1):
        hashes = hashes[: len(chars) - n + 1] * np.uint64(0x100000001B3) + chars[n - 1 :]
        if n in ngrams:
            inside = np.flatnonzero(word_of[: len(hashes)] == word_of[n - 1 :])
            mixed = (hashes[inside] ^ (hashes[inside] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            found.append(((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32))
            owners.append(word_of[inside])
        if len(hashes) <= 1:
            break
    return (np.concatenate(found), np.concatenate(owners)) if found else (np.zeros(0, np.int32), np.zeros(0, np.int32))


def _readable(pieces: list[bytes]) -> tuple[np.ndarray, list[str]]:
    """Of the segments of a slice: the word each stands for (-1 without a letter or digit), and the words."""
    known: dict[str, int] = {}
    which = []
    joined = b"\x00".join(pieces)
    if joined.count(0) >= len(pieces) > 0:
        joined = b"\x00".join(piece.replace(b"\x00", b"?") for piece in pieces)
    for word in joined.decode("utf-8", "replace").lower().split("\x00") if pieces else ():
        word = word.strip()
        readable = word.isalpha() or any(map(str.isalnum, word))
        which.append(known.setdefault(word, len(known)) if readable else -1)
    return np.array(which, np.int64), list(known)


def distinct_words(texts: Sequence[bytes | None]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, int]]:
    """Slices of consecutive texts: words, then pairs (text, word) without repetition, and the number of texts."""
    for part in slices(texts):
        pieces = segment(part, word_cuts, ())
        which, words = _readable(pieces.values)
        of_text = np.repeat(np.arange(len(part)), np.diff(pieces.starts))
        word = which[pieces.codes] if len(words) else np.zeros(len(of_text), np.int64) - 1
        pairs = np.unique(of_text[word >= 0] * max(len(words), 1) + word[word >= 0])
        yield words, pairs // max(len(words), 1), pairs % max(len(words), 1), len(part)


def scores(texts: Sequence[bytes | None], model: Model) -> Iterator[np.ndarray]:
    """Probability of being toxic, for slices of consecutive texts."""
    for words, text, word, n in distinct_words(texts):
        found, owners = ngram_buckets(words, model.ngrams, len(model.weights))
        per_word = np.bincount(owners, model.weights[found], len(words)) if words else np.zeros(0)
        total = np.bincount(text, per_word[word], n) if len(text) else np.zeros(n)
        yield 1 / (1 + np.exp(-np.clip(total + model.bias, -500, 500)))


def fit(documents: Sequence[Sequence[str]], toxic: Sequence[bool], training: Training = TRAINING, weigh_others: float = 1.0) -> Model:
    """Model from the distinct words of training texts. `weigh_others`: weight of a text that is not toxic."""
    y = np.asarray(toxic, float)
    if not y.sum() or y.all():
        # Nothing to tell apart: every score is the label all rows have, 0 without any.
        return Model(training.ngrams, np.zeros(training.buckets), 500.0 if len(y) and y.all() else -500.0)
    ids: dict[str, int] = {}
    word = np.fromiter((ids.setdefault(w, len(ids)) for d in documents for w in d), np.int32)
    text = np.repeat(np.arange(len(documents), dtype=np.int32), [len(d) for d in documents])
    words = list(ids)
    del ids

    # One length of n-grams at a time, twice: to count and, when it is known which are frequent enough, to keep those.
    inside, outside = np.zeros(training.buckets), np.zeros(training.buckets)
    in_toxic = np.bincount(word, y[text], len(words))
    in_others = np.bincount(word, (1 - y)[text], len(words))
    for n in training.ngrams:
        bucket, owner = ngram_buckets(words, (n,), training.buckets)
        inside += np.bincount(bucket, in_toxic[owner], training.buckets)
        outside += np.bincount(bucket, in_others[owner], training.buckets)
    a, n_toxic, n_others = training.smoothing, y.sum(), (1 - y).sum()
    active = np.flatnonzero(inside + outside >= training.min_documents)
    ratio = np.log((inside[active] + a) / (n_toxic + 2 * a)) - np.log((outside[active] + a) / (n_others + 2 * a))
    dense = np.full(training.buckets, -1, np.int32)
    dense[active] = np.arange(len(active))
    kept = []
    for n in training.ngrams:
        bucket, owner = ngram_buckets(words, (n,), training.buckets)
        feature = dense[bucket]
        kept.append((feature[feature >= 0], owner[feature >= 0]))
    feature, owner = (np.concatenate(parts) for parts in zip(*kept, strict=True))
    n_words = len(words)
    del words, kept, bucket, inside, outside
    to_words, to_features = Sums(owner, feature, n_words), Sums(feature, owner, len(active))
    to_texts, from_texts = Sums(text, word, len(y)), Sums(word, text, n_words)
    row_weights = np.where(y > 0, 1.0, weigh_others)
    row_weights /= row_weights.sum()

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        z = to_texts(to_words(p[:-1] * ratio)) + p[-1]
        error = row_weights * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
        value = float((row_weights * (np.logaddexp(0, z) - y * z)).sum() + training.penalty / 2 / len(y) * (p[:-1] ** 2).sum())
        return value, np.append(to_features(from_texts(error)) * ratio + training.penalty / len(y) * p[:-1], error.sum())

    p = minimise(loss, np.zeros(len(active) + 1), training.steps)
    weights = np.zeros(training.buckets)
    weights[active] = p[:-1] * ratio
    return Model(training.ngrams, weights, float(p[-1]))


class Sums:
    """For pairs (to, source): sums of the sources' values at each of `size` places, in a layout made once."""

    def __init__(self, to: np.ndarray, source: np.ndarray, size: int):
        order = np.argsort(to, kind="stable")
        self.source, self.size = source[order], size
        self.places, self.starts = np.unique(to[order], return_index=True)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size)
        if len(self.places):
            out[self.places] = np.add.reduceat(values[self.source], self.starts)
        return out


def minimise(loss, p: np.ndarray, steps: int, memory: int = 6) -> np.ndarray:
    """L-BFGS with step halving."""
    value, slope = loss(p)
    kept: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        q, passed = slope.copy(), []
        for s, d, rho in reversed(kept):
            passed.append(rho * s.dot(q))
            q -= passed[-1] * d
        if kept:
            s, d, _ = kept[-1]
            q *= s.dot(d) / d.dot(d)
        for (s, d, rho), alpha in zip(kept, reversed(passed), strict=True):
            q += (alpha - rho * d.dot(q)) * s
        rate, gain = 1.0, slope.dot(q)
        if gain < 1e-12:
            break
        for _ in range(30):
            new_value, new_slope = loss(p - rate * q)
            if new_value <= value - 1e-4 * rate * gain:
                break
            rate /= 2
        else:
            break
        s, d = -rate * q, new_slope - slope
        if s.dot(d) > 1e-12:
            kept = [*kept[1 - memory :], (s, d, 1 / s.dot(d))]
        p, value, slope = p + s, new_value, new_slope
    return p


def held_out(doc_id: Column) -> Column:
    """Rows that never take part in training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(labels: DataFrame, training: Training) -> tuple[DataFrame, float]:
    """doc_id, toxic of the rows to train on, and how many others there are for each in the sample, relative to toxic ones."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    one = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.max("toxic") > 0).alias("toxic"))
    seen = dict(one.groupBy("toxic").count().collect())
    chosen = [
        one.filter(F.col("toxic") == flag).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for flag, n in ((True, training.toxic), (False, training.others))
    ]
    shares = {flag: min(n, seen.get(flag, 0)) / max(seen.get(flag, 0), 1) for flag, n in ((True, training.toxic), (False, training.others))}
    return chosen[0].unionByName(chosen[1]), (shares[True] / shares[False]) if shares[False] else 1.0


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            words, _, word, _ = next(distinct_words([text]))
            found.append([words[k] for k in word])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.string()))], names=["doc_id", "toxic", "words"])


def train(documents: DataFrame, labels: DataFrame, training: Training = TRAINING) -> Model:
    """Fit on a bounded sample of `labels` (doc_id, toxic), which the caller has rid of held-out rows.

    Rows of labels without id or label are left out; of several labels of a document the toxic one counts; of several texts
    of an id the smallest list of words. Without toxic rows every score is 0, without others 1.
    """
    sample, weigh = _sample(labels, training)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    found = in_arrow(rows, _words, "doc_id long, toxic boolean, words array<string>").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("words").alias("words"))
    taken = sorted(found.collect())
    return fit([r.words for r in taken], [r.toxic for r in taken], training, weigh)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.concatenate([np.zeros(0), *scores(batch.column("text").cast(pa.binary()).to_pylist(), shared.value)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    return run


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5) of every document, in one row each.

    A null or empty text has no n-grams and gets the score of the bias alone. Rows without `doc_id` and repeated rows each
    get their row; other columns, languages and sources among them, are ignored. An empty table gives no rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return in_arrow(rows, _score(shared), "doc_id long, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of `documents` that are not predicted toxic, unchanged."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.concatenate([np.zeros(0), *scores(batch.column("text").cast(pa.binary()).to_pylist(), shared.value)])
            yield batch.filter(pa.array(found < 0.5))

    return in_arrow(documents, run, documents.schema)
