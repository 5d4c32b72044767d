"""Lexical retrieval packing: fill token windows with documents that resemble each other.

Every document's whole windows stand alone; what is left of it, its tail, shares a window. Terms are token ids, so document
frequencies over the whole corpus fit into one bounded array. Documents are range-partitioned by their most telling terms,
which brings related ones together and splits any crowd of them by a hash. A partition, bounded by its postings, gets one
BM25 inverted index: the window's seed is the query, its best unused neighbours fill the window in turn, the one that does
not fit is cut, and its rest seeds the next window. Related is what shares a term with the seed that less than half of the
corpus has. A window that runs out of related documents is undone: its tails are partitioned again by their next telling
terms and only there, when nothing related is left once more, unrelated ones fill up. Only a last window is padded.

Tokenizing happens once; its result (tails, terms and checksums, no texts) is written to shared storage.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.segments import library_encoder
from viewpulse.llm.shipping import in_arrow
from viewpulse.sources.tables import settle

WINDOW = 1024
END_ID = 0
#: Postings (distinct terms of documents) of a shard. Ranges are cut by sampling; an index never holds over twice as many.
SHARD_POSTINGS = 1 << 20
#: A term that more than one in so many documents of an index have is a row of its matrix.
FREQUENT = 10
#: Neighbours sorted at a time; a window that takes more of them asks again.
NEAREST = 64
#: Partition number from which on the second round counts its windows.
SECOND = 1 << 20
KEYED_ROWS = 2000
K1, B = 1.2, 0.75

_TOKENS = "doc_id long, doc_tokens long, sums array<long>, tail binary, terms binary, counts binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_LEFT = "tail binary, terms binary, counts binary"


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())


def _terms(ids: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Distinct ids of each document, ascending, and how often each is there; documents lie between each two `bounds`."""
    n = len(bounds) - 1
    kind = np.uint32 if n <= 1 << 16 else np.uint64
    keys = np.sort(np.repeat(np.arange(n, dtype=kind) << kind(16), np.diff(bounds)) | ids.astype(kind, copy=False))
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    begins = np.searchsorted(first, bounds)
    terms, counts = (keys[first] & kind(0xFFFF)).astype("<u2"), np.diff(np.append(first, len(keys))).astype("<u4")
    return tuple(pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((begins * v.itemsize).astype(np.int32)), pa.py_buffer(v)]) for v in (terms, counts))


def _tokenize(path: str, window: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path)
        for batch in batches:
            at = 0
            for ids, bounds in encoder.encode(batch.column("text").cast(pa.binary()).to_pylist()):
                n = len(bounds) - 1
                ended = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(n + 1)
                terms, counts = _terms(ended, bounds)
                rows: list[tuple] = []
                for a, b in itertools.pairwise(bounds.tolist()):
                    whole = (b - a) // window * window
                    sums = [crc(ended[k : k + window]) for k in range(a, a + whole, window)]
                    rows.append((b - a, sums, ended[a + whole : b].astype("<u2").tobytes()))
                sizes, sums, tails = zip(*rows, strict=True)
                columns = [batch.column("doc_id").slice(at, n), pa.array(sizes, pa.int64()), pa.array(sums, pa.list_(pa.int64()))]
                columns += [pa.array(tails, pa.binary()), terms, counts]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "doc_tokens", "sums", "tail", "terms", "counts"])
                at += n

    return run


def _frequencies(size: int):
    """Per task: documents by term; at `size` the documents, behind it their tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size + 2, np.int64)
        for batch in batches:
            terms = np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<u2")
            found[:size] += np.bincount(terms, minlength=size)
            found[size] += batch.num_rows
            found[size + 1] += sum(batch.column("doc_tokens").to_pylist())
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["term", "n"])

    return run


@dataclass(frozen=True)
class Corpus:
    """BM25 statistics of all documents."""

    idf: np.ndarray
    mean_tokens: float

    @property
    def telling(self) -> np.ndarray:
        """Terms that less than half of the documents have: those of positive weight in BM25 as first published."""
        return self.idf > np.log(2)

    def weights(self, terms: np.ndarray, counts: np.ndarray, tokens: np.ndarray | int) -> np.ndarray:
        return self.idf[terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * tokens / self.mean_tokens))


#: How ids of tails and terms, and counts, are stored.
KINDS = {"tail": "<u2", "terms": "<u2", "counts": "<u4"}


def _numbers(batch: pa.RecordBatch, column: str) -> list[np.ndarray]:
    return [np.frombuffer(v, KINDS[column]) for v in batch.column(column).to_pylist()]


def _telling(corpus: Corpus, terms: list[np.ndarray], counts: list[np.ndarray], tokens: list[int], after: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The two terms of the largest weight of each document behind the first `after`, ties to smaller terms; 0 if there is none."""
    sizes = np.array([len(t) for t in terms])
    starts = np.cumsum(sizes) - sizes
    flat = np.concatenate(terms)
    w = corpus.weights(flat, np.concatenate(counts).astype(np.float64), np.repeat(np.array(tokens), sizes))
    found = []
    for _ in range(after + 2):
        top = np.flatnonzero(w == np.repeat(np.maximum.reduceat(w, starts), sizes))
        at = top[np.searchsorted(top, starts)]
        found.append(np.where(w[at] > -np.inf, flat[at], 0).astype(np.int32))
        w[at] = -np.inf
    return found[-2], found[-1]


def _keyed(shared, after: int):
    """Adds the two most telling terms of each document behind the first `after`. Every document has a term, its end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, KEYED_ROWS):
                batch = whole.slice(at, KEYED_ROWS)
                terms, counts = (_numbers(batch, c) for c in ("terms", "counts"))
                keys = _telling(shared.value, terms, counts, batch.column("doc_tokens").to_pylist(), after)
                yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, keys)], names=[*batch.schema.names, "k1", "k2"])

    return run


class Index:
    """Inverted index of the documents of one shard.

    Terms that a good part of the documents have are rows of a matrix, which add up as vectors; the others have postings. Both
    hold unused documents only, as far as `shrink` has got, and number them anew.
    """

    def __init__(self, corpus: Corpus, terms: list[np.ndarray], counts: list[np.ndarray], tokens: list[int]):
        sizes = np.array([len(t) for t in terms])
        flat = np.concatenate(terms)
        of = np.repeat(np.arange(len(terms)), sizes)
        w = corpus.weights(flat, np.concatenate(counts).astype(np.float64), np.repeat(np.array(tokens), sizes))
        order = np.argsort(flat, kind="stable")
        self.vocabulary, begins = np.unique(flat[order], return_index=True)
        self.telling = corpus.telling[self.vocabulary]
        self.unused = np.ones(len(terms), bool)
        self._hold(np.arange(len(terms)), of[order], w[order], np.append(begins, len(flat)))

    def _hold(self, held: np.ndarray, docs: np.ndarray, w: np.ndarray, bounds: np.ndarray) -> None:
        """`held`: the documents' places in the shard; postings of `docs` (places in `held`) between each two `bounds`."""
        self.held, self.docs, self.w, self.bounds = held, docs, w, bounds
        self.cuts = bounds.tolist()
        frequent = np.flatnonzero(np.diff(bounds) * FREQUENT > len(held))
        self.row = np.full(len(self.vocabulary), -1)
        self.row[frequent] = np.arange(len(frequent))
        # At most `FREQUENT` times as many cells as there are postings.
        self.rows = list(np.zeros((len(frequent), len(held))))
        for r, (a, b) in enumerate(zip(bounds[frequent].tolist(), bounds[frequent + 1].tolist(), strict=True)):
            self.rows[r][docs[a:b]] = w[a:b]

    def shrink(self) -> None:
        """Drop used documents once they are a fifth of those held."""
        keep = self.unused[self.held]
        if int(keep.sum()) * 5 > len(self.held) * 4:
            return
        numbers = np.cumsum(keep) - 1
        stay = keep[self.docs]
        before = np.concatenate([[0], np.cumsum(stay)])
        self._hold(self.held[keep], numbers[self.docs[stay]], self.w[stay], before[self.bounds])

    def _sum(self, at: np.ndarray) -> np.ndarray:
        """Weights of the terms at these places of the vocabulary, for each document held."""
        rows = self.row[at]
        spans = [slice(self.cuts[i], self.cuts[i + 1]) for i in at[rows < 0].tolist()]
        if spans:
            docs, w = (np.concatenate([x[s] for s in spans]) for x in (self.docs, self.w))
            total = np.bincount(docs, w, len(self.held)).astype(np.float64, copy=False)
        else:
            total = np.zeros(len(self.held))
        for r in rows[rows >= 0].tolist():
            total += self.rows[r]
        return total

    def neighbours(self, query: np.ndarray, related: bool = False, most: int | None = None) -> np.ndarray:
        """Unused documents, best first by BM25 for the query's terms; ties in the order of the shard. `related`: only those
        that share a telling term with the query. `most`: so many at least, if there are."""
        at = np.searchsorted(self.vocabulary, query)
        at[at == len(self.vocabulary)] = 0
        at = at[self.vocabulary[at] == query]
        telling = self._sum(at[self.telling[at]])
        wanted = self.unused[self.held]
        left = np.flatnonzero(wanted & (telling > 0) if related else wanted)
        if not len(left):
            return left
        scores = (telling + self._sum(at[~self.telling[at]]))[left]
        if most is not None and len(left) > most:
            first = scores >= np.partition(scores, -most)[-most]
            left, scores = left[first], scores[first]
        return self.held[left[np.argsort(-scores, kind="stable")]]


@dataclass
class Document:
    doc_id: int | None
    tokens: int
    tail: np.ndarray
    terms: np.ndarray
    counts: np.ndarray


class Windows:
    """Fills windows one after another and notes where each piece lies."""

    def __init__(self, part: int, window: int):
        self.next_id, self.window = part << 32, window
        self.filled, self.pieces = 0, []
        self.seed: np.ndarray | None = None
        self.members: list[tuple[Document, int]] = []

    def whole(self, doc_id: int | None, tokens: int, sums: list[int]) -> None:
        for k, s in enumerate(sums):
            self.pieces.append((doc_id, k * self.window, self.window, s, tokens, self.next_id, 0))
            self.next_id += 1
        # The open window, if any, takes the next number.

    def place(self, doc: Document) -> bool:
        """Put a tail into the open window, its rest into the next one. True if a window was closed."""
        at, closed = 0, False
        while at < len(doc.tail):
            if not self.filled:
                self.open_id, self.next_id = self.next_id, self.next_id + 1
                self.seed, self.members, self.opened = doc.terms, [], len(self.pieces)
            self.members.append((doc, at))
            take = min(len(doc.tail) - at, self.window - self.filled)
            start = doc.tokens - len(doc.tail) + at
            self.pieces.append((doc.doc_id, start, take, crc(doc.tail[at : at + take]), doc.tokens, self.open_id, self.filled))
            at += take
            self.filled += take
            if self.filled == self.window:
                self.filled, closed = 0, True
        return closed

    def undo(self) -> list[Document]:
        """Take the open window back; its documents, as far as they are not in closed windows."""
        if not self.filled:
            return []
        del self.pieces[self.opened :]
        self.filled = 0
        return [Document(d.doc_id, d.tokens, d.tail[at:], d.terms, d.counts) for d, at in self.members]

    def block(self, corpus: Corpus, docs: list[Document], last: bool) -> list[Document]:
        """Pack documents. Unless it is the `last` round, those of windows that related ones do not fill are given back."""
        index = Index(corpus, [d.terms for d in docs], [d.counts for d in docs], [d.tokens for d in docs])
        following, given_back = 0, []
        while index.unused.any():
            if not self.filled:
                while not index.unused[following]:
                    following += 1
                index.unused[following] = False
                self.place(docs[following])
                continue
            index.shrink()
            found = index.neighbours(self.seed, related=True, most=NEAREST)
            if not len(found) and not last:
                given_back += self.undo()
                continue
            for i in found if len(found) else index.neighbours(self.seed, most=NEAREST):
                index.unused[i] = False
                if self.place(docs[i]):
                    break
        return given_back if last else given_back + self.undo()

    def flush(self, given_back: list[Document]) -> pa.RecordBatch:
        """Pieces, and behind them what is given back, with its tail."""
        names = [c.split()[0] for c in f"{_PIECES}, {_LEFT}".split(", ")]
        rows = [(*p, None, None, None) for p in self.pieces]
        for d in given_back:
            rows.append((d.doc_id, *[None] * 3, d.tokens, *[None] * 2, *[getattr(d, c).astype(kind).tobytes() for c, kind in KINDS.items()]))
        columns = zip(*rows, strict=True) if rows else [[]] * 10
        kinds = [*[pa.int64()] * 7, *[pa.binary()] * 3]
        out = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)
        self.pieces = []
        return out


def _pack(shared, window: int, postings: int, block_docs: int | None, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, windows = shared.value, Windows(TaskContext.get().partitionId() + SECOND * last, window)
        docs: list[Document] = []
        held = 0
        for batch in batches:
            terms, tails, found = (_numbers(batch, c) for c in ("terms", "tail", "counts"))
            keys = (batch.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "sums"))
            for doc_id, tokens, sums, t, tail, n in zip(*keys, terms, tails, found, strict=True):
                windows.whole(doc_id, tokens, sums)
                if len(tail):
                    docs.append(Document(doc_id, tokens, tail, t, n))
                    held += len(t)
                if held >= 2 * postings or (block_docs and len(docs) == block_docs):
                    yield windows.flush(windows.block(corpus, docs, last))
                    docs, held = [], 0
        yield windows.flush(windows.block(corpus, docs, last) if docs else [])

    return run


def pack_documents(
    documents: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, block_docs: int | None = None, shard_postings: int = SHARD_POSTINGS
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids by the tokenizer file at `path` (up to 65,536 ids) and `end_id`; each id lies in one piece. A null
    or empty text has only the end id. Rows without `doc_id` and repeated rows are documents of their own. Other columns are
    ignored; an empty table gives no rows. `block_docs`: documents of an index, if not all of a shard.
    """
    spark = documents.sparkSession
    size = library_encoder(path).tokenizer.get_vocab_size()
    if max(size, end_id + 1) > 1 << 16:
        raise ValueError("ids are kept in 16 bits")
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    tokens = settle(in_arrow(rows, _tokenize(path, window, end_id), _TOKENS))
    counted = in_arrow(tokens.select("terms", "doc_tokens"), _frequencies(size), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = np.zeros(size + 2, np.int64)
    for term, n in counted.collect():  # at most one row for each id of the vocabulary
        found[term] = n
    docs, total = found[size : size + 2].tolist()
    idf = np.log1p((docs - found[:size] + 0.5) / (found[:size] + 0.5))
    shared = spark.sparkContext.broadcast(Corpus(idf, max(total, 1) / max(docs, 1)))
    order = [F.col("k1"), F.col("k2"), F.xxhash64("tail", "doc_id"), F.col("doc_id")]

    def packed(rows: DataFrame, postings: int, last: bool) -> DataFrame:
        # What is given back has been with those that share its first two telling terms.
        keyed = in_arrow(rows, _keyed(shared, 2 * last), f"{_TOKENS}, k1 int, k2 int")
        shards = keyed.repartitionByRange(max(1, -(-postings // shard_postings)), *order).sortWithinPartitions(*order)
        return in_arrow(shards, _pack(shared, window, shard_postings, block_docs, last), f"{_PIECES}, {_LEFT}")

    first = settle(packed(tokens, int(found[:size].sum()), False))
    left = first.filter("tail IS NOT NULL").selectExpr("doc_id", "doc_tokens", "CAST(array() AS array<long>) AS sums", "tail", "terms", "counts")
    postings = left.agg(F.sum(F.length("terms"))).first()[0] or 0
    second = packed(left, postings // 2, True)
    names = [c.split()[0] for c in _PIECES.split(", ")]
    return first.filter("tail IS NULL").select(names).unionByName(second.select(names))
