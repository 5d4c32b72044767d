"""Alignment of two tokenizers on the same bytes, and how often their token ids meet in a corpus.

Texts are cut into segments where both tokenizers are certain to cut; each distinct segment of a slice of texts is aligned
once. Token-byte incidence matrices A and B of many segments are built by hand in compressed rows. The row products A·Bᵀ
(Gustavson: each row of the result is gathered from the rows of Bᵀ that the row of A names) are the overlap links with the
bytes shared. Where the overlaps of a token begin behind all earlier ones, a group begins. The products of the group
incidences (ids of A by groups, groups by ids of B) are the shared-group links, summed for each pair of ids.

Corpus-wide counts without sending every document's pairs around: a task lists the pairs of a slice once (with the documents
that hold each) and keeps a document's links as places in that list. Only lists are counted, ranked and joined; then a slice's
documents and its list are cogrouped. A slice is a few MB of text, or one longer text, so no group grows with the corpus.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from viewpulse.llm.segments import byte_alphabet, byte_cuts, segment, slices
from viewpulse.llm.shipping import in_arrow, ship
from viewpulse.sources.tables import settle

#: Products gathered at once, and bytes given to a tokenizer at once.
PRODUCTS, RUN_BYTES = 1 << 20, 1 << 14
SPACE = "▁"
SPACE_BYTES = SPACE.encode()
#: Last bytes of segments that the next one can be joined to: ASCII letters, digits and marks.
SOLID = frozenset(range(33, 127))


@dataclass(frozen=True)
class Csr:
    """A sparse matrix in compressed rows."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.columns, minlength=self.width))))
        return Csr(starts, self.rows[order], self.values[order], len(self.starts) - 1)


def incidence(rows: np.ndarray, columns: np.ndarray, shape: tuple[int, int]) -> Csr:
    """How often each column stands in each row, from any list of places."""
    keys, counts = np.unique(rows.astype(np.int64) * shape[1] + columns, return_counts=True)
    at, columns = np.divmod(keys, max(1, shape[1]))
    return Csr(np.concatenate(([0], np.cumsum(np.bincount(at, minlength=shape[0])))), columns, counts, shape[1])


def product(a: Csr, b: Csr) -> Csr:
    """a·b by rows: the rows of `b` that a row of `a` names, times its values, gathered and summed by column."""
    each = np.diff(b.starts)[a.columns]
    ends = np.concatenate(([0], np.cumsum(each)))[a.starts]
    n = len(a.starts) - 1
    sizes, columns, values = np.zeros(n, np.int64), [], []
    first = 0
    while first < n:
        # As many rows as give some number of products, one at least.
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + PRODUCTS, side="right")) - 1)
        own = slice(a.starts[first], a.starts[last])
        count = each[own]
        at = np.arange(count.sum()) + np.repeat(b.starts[a.columns[own]] - (np.cumsum(count) - count), count)
        row = np.repeat(np.repeat(np.arange(first, last), np.diff(a.starts[first : last + 1])), count)
        keys, sums = row * b.width + b.columns[at], np.repeat(a.values[own], count) * b.values[at]
        if len(keys) and (keys[1:] < keys[:-1]).any():
            order = np.argsort(keys, kind="stable")
            keys, sums = keys[order], sums[order]
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        sizes[first:last] = np.bincount(keys[new] // max(1, b.width) - first, minlength=last - first)
        columns.append(keys[new] % max(1, b.width))
        values.append(np.add.reduceat(sums, new) if len(new) else sums)
        first = last
    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (columns, values)]
    return Csr(np.concatenate(([0], np.cumsum(sizes))), *joined, b.width)


def token_bytes(lengths: np.ndarray) -> Csr:
    """Tokens by the bytes they cover, for tokens that stand one behind the other."""
    starts = np.concatenate(([0], np.cumsum(lengths)))
    return Csr(starts, np.arange(starts[-1]), np.ones(starts[-1], np.int32), int(starts[-1]))


def overlaps(a_lengths: np.ndarray, b_lengths: np.ndarray) -> Csr:
    """Bytes shared by each token of A and each token of B over the same bytes."""
    return product(token_bytes(a_lengths), token_bytes(b_lengths).transposed())


def groups_of(shared: Csr) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B: a group begins where no overlap goes back behind the last one's."""
    firsts, lasts = shared.columns[shared.starts[:-1]], shared.columns[shared.starts[1:] - 1]
    a = np.cumsum(firsts > np.concatenate(([-1], lasts[:-1]))) - 1
    b = np.zeros(shared.width, np.int64)
    b[shared.columns] = a[shared.rows]
    return a, b


@dataclass(frozen=True)
class Aligned:
    """Many segments. `fits`: both token sequences spell it. The links of segment i are `ends[i]` to `ends[i + 1]` of `pairs`
    (2^32 times id of A plus id of B) and `times` (how many links each pair makes)."""

    fits: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    spelled: list[str]
    ends: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def joint_cuts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where both cut: before a space behind another character or before a line feed, where the byte-level one cuts."""
    cuts = byte_cuts(data, ends)
    before = np.concatenate(([0], data[:-1]))
    # 0x81 may end the character that counts as a space for the other tokenizer.
    return cuts & ((data == 10) | ((data == 32) & (before != 32) & (before != 0x81)))


class Aligner:
    """A: a byte-level tokenizer file, over a space and the text. B: a sentencepiece model that adds the space."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        # Strings of special tokens in a text are plain text.
        self.a.encode_special_tokens = True
        back = {chr(c): b for b, c in byte_alphabet().items()}
        self.a_bytes = {i: bytes(back[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items() if all(c in back for c in t)}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [self._b_bytes(i) for i in range(self.b.get_piece_size())]
        self.space = self.b.piece_to_id(SPACE)
        if any("\n" in self.b.id_to_piece(i) for i in range(self.b.get_piece_size())):
            raise ValueError("a piece with a line feed: texts cannot be cut there")
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_sizes[list(self.a_bytes)] = list(map(len, self.a_bytes.values()))
        self.b_sizes = np.array(list(map(len, self.b_bytes)))

    def _b_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()

    def _b_ids(self, text: str) -> list[int]:
        """Ids of a text that begins at a cut: behind a space the model's own, behind a line feed without the space it adds."""
        if text[0] == " ":
            return self.b.encode(text[1:]) if len(text) > 1 else [self.space]
        ids = self.b.encode(text)
        assert ids[0] == self.space
        return ids[1:]

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments in a row on either side."""
        given = [t.decode() for t in texts]
        a = [e.ids for e in self.a.encode_batch(given, add_special_tokens=False)]
        return tuple(np.fromiter(chain.from_iterable(x), np.int64) for x in (a, map(self._b_ids, given)))

    def align(self, texts: list[bytes]) -> Aligned:
        """Segments that begin at joint cuts."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        fits = np.fromiter((SPACE_BYTES not in t for t in texts), bool, len(texts))
        runs = self._runs([t for t, f in zip(texts, fits.tolist(), strict=True) if f])
        a, b = self.tokens(runs)
        if not self._spells(b"".join(runs), a, b):
            # Some segment is not what its tokens spell: each is looked at alone.
            fits = np.array([f and self._spells(t, *self.tokens([t])) for t, f in zip(texts, fits.tolist(), strict=True)], bool)
            a, b = self.tokens(self._runs([t for t, f in zip(texts, fits.tolist(), strict=True) if f]))
        return self._links(fits, np.where(fits, sizes, 0), a, b)

    @staticmethod
    def _runs(texts: list[bytes]) -> list[bytes]:
        """Segments joined to longer texts where the joints are certain cuts too."""
        runs: list[bytes] = []
        part: list[bytes] = []
        size = 0
        for t in texts:
            part.append(t)
            size += len(t)
            if size >= RUN_BYTES or t[-1] not in SOLID:
                runs.append(b"".join(part))
                part, size = [], 0
        return [*runs, b"".join(part)] if part else runs

    def _spells(self, text: bytes, a: np.ndarray, b: np.ndarray) -> bool:
        return all(b"".join(map(of.__getitem__, ids.tolist())) == text for of, ids in ((self.a_bytes, a), (self.b_bytes, b)))

    def _links(self, fits: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> Aligned:
        """All links of segments of `sizes` bytes (0: without tokens) from the ids that spell them one behind the other."""
        n = len(sizes)
        lengths = [self.a_sizes[a], self.b_sizes[b]]
        own = np.repeat(np.arange(n), sizes)
        # The segment of a token is that of its first byte.
        a_segment, b_segment = (own[np.cumsum(x) - x] for x in lengths)
        a_group, b_group = groups_of(overlaps(*lengths))
        n_groups = int(a_group[-1]) + 1 if len(a) else 0
        # Ids of a segment by its groups: the product has a row for each id of A in a segment.
        (a_type, a_id), (b_type, b_id) = self._types(a_segment, a), self._types(b_segment, b)
        links = product(incidence(a_type, a_group, (len(a_id), n_groups)), incidence(b_type, b_group, (len(b_id), n_groups)).transposed())
        a_id, at = a_id & 0xFFFFFFFF, a_id >> 32
        ends = links.starts[np.searchsorted(at, np.arange(n + 1))]
        pairs = (a_id[links.rows] << 32) | (b_id[links.columns] & 0xFFFFFFFF)
        n_a, n_b = (np.bincount(x, minlength=n) for x in (a_segment, b_segment))
        first = np.searchsorted(a_segment, np.arange(n + 1))
        bounds = np.append(a_group, n_groups)[first]
        spelled = self._spelled(a, a_group, b, b_group, n_groups)
        cut = bounds.tolist()
        texts = [spelled[x] if y == x + 1 else ";".join(spelled[x:y]) for x, y in zip(cut, cut[1:], strict=False)]
        return Aligned(fits, n_a, n_b, np.diff(bounds), texts, ends, pairs, links.values)

    @staticmethod
    def _types(segments: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the distinct ids of its segment each token is; 2^32 times segment plus id of these."""
        keys, kind = np.unique((segments << 32) | ids, return_inverse=True)
        return kind, keys

    @staticmethod
    def _spelled(a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, n: int) -> list[str]:
        """`a1,a2|b1` of each group."""
        sides = []
        for ids, group in ((a, a_group), (b, b_group)):
            texts = list(map(str, ids.tolist()))
            at = np.searchsorted(group, np.arange(n + 1)).tolist()
            sides.append([texts[x] if y == x + 1 else ",".join(texts[x:y]) for x, y in zip(at, at[1:], strict=False)])
        return [f"{x}|{y}" for x, y in zip(*sides, strict=True)]


@cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process."""
    return Aligner(a_path, b_path)


def _sums(each: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(each)))
    return total[starts[1:]] - total[starts[:-1]]


def _align_slice(own: Aligner, texts: list[bytes]) -> tuple[dict[str, np.ndarray | list], np.ndarray, np.ndarray]:
    """Columns of the texts of a slice, its distinct pairs and the texts that hold each."""
    pieces = segment([b" " + t if t else t for t in texts], joint_cuts, [])
    found = own.align(pieces.values)
    n, starts, codes = len(texts), pieces.starts, pieces.codes
    fits = (_sums(~found.fits[codes], starts) == 0) & (np.diff(starts) > 0)
    spelled, at, bounds = found.spelled, codes.tolist(), starts.tolist()
    columns: dict = {"groups": [";".join([spelled[c] for c in at[x:y]]) if f else "" for f, x, y in zip(fits.tolist(), bounds, bounds[1:], strict=False)]}
    columns |= {k: _sums(getattr(found, k)[codes], starts) * fits for k in ("n_a", "n_b", "n_groups")}
    pairs, pool = np.unique(found.pairs, return_inverse=True)
    row = np.repeat(np.arange(n), np.diff(starts))
    used = fits[row]
    row, code = row[used], codes[used]
    each = np.diff(found.ends)[code]
    places = np.arange(each.sum()) + np.repeat(found.ends[code] - (np.cumsum(each) - each), each)
    keys = np.repeat(row, each) * max(1, len(pairs)) + pool[places]
    order = np.argsort(keys, kind="stable")
    keys, links = keys[order], found.times[places][order]
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    links = np.add.reduceat(links, new) if len(new) else links
    row, place = np.divmod(keys[new], max(1, len(pairs)))
    ends = np.searchsorted(row, np.arange(n + 1))
    columns |= {"n_links": _sums(links, ends), "places": (ends, place), "links": (ends, links)}
    return columns, pairs, np.bincount(place, minlength=len(pairs))


ROW = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, places array<int>, links array<long>, pairs array<long>, held array<long>"


def _align(a_path: str, b_path: str):
    """Rows of documents, and for each slice (`block`) one more row with its pairs."""

    def lists(ends: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, block = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        names = [c.split()[0] for c in ROW.split(", ")]
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text").cast(pa.binary()).to_pylist()):
                n = len(texts)
                found, pairs, held = _align_slice(own, texts)
                numbers = [pa.array(found[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")]
                rows = [pa.array(np.full(n, block)), batch.column("doc_id").slice(at, n), *numbers, pa.array(found["groups"], pa.string())]
                rows += [lists(*found["places"], pa.int32()), lists(*found["links"], pa.int64())]
                yield pa.RecordBatch.from_arrays([*rows, *[pa.nulls(n, pa.list_(pa.int64()))] * 2], names=names)
                whole = np.array([0, len(pairs)])
                void = [pa.nulls(1, c.type) for c in rows[1:]]
                yield pa.RecordBatch.from_arrays([rows[0].slice(0, 1), *void, lists(whole, pairs, pa.int64()), lists(whole, held, pa.int64())], names=names)
                block, at = block + 1, at + n

    return run


def _tally(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """n_best and count_sum of a slice's documents, from the counts of the slice's pairs."""
    place = counts["place"].to_numpy()
    size = int(place.max(initial=-1)) + 1
    count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    count[place], best[place] = counts["n"].to_numpy(), counts["best"].to_numpy()
    lists = rows["places"].combine_chunks()
    ends, at = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()
    links = rows["links"].combine_chunks().flatten().to_numpy()
    out = rows.drop_columns(["block", "places", "links"])
    for name, each in (("n_best", best), ("count_sum", count)):
        out = out.append_column(name, pa.array(_sums(each[at] * links, ends), pa.int64()))
    return out


def align(documents: DataFrame, a_path: str, b_path: str, carry: dict[str, Column] | None = None) -> DataFrame:
    """How two tokenizers cut every document, and how usual the pairs of ids they link are.

    Returns doc_id, n_a, n_b (tokens), n_groups, n_links (token pairs that share a group), the columns of `carry`, n_best
    (links whose count is the highest of their id of A in the corpus) and count_sum (counts of all links). The count of a pair
    of ids is the number of rows that hold it linked. `carry` is made from column `groups`, the alignment as
    `a1,a2|b1;a3|b2,b3`; by default it is that column itself.

    A null or empty text, and one whose joined token bytes on either side are not a space and the text, has no tokens: zeros
    and empty `groups`. Rows without `doc_id` and repeated rows are rows of their own, in the counts too. Other columns are
    ignored; an empty table gives no rows. Both files have to be readable at the same place on every worker.
    """
    carry = carry or {"groups": F.col("groups")}
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = in_arrow(rows, _align(a_path, b_path), ROW)
    numbers = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    found = settle(found.select("block", *numbers, *[c.alias(k) for k, c in carry.items()], "places", "links", "pairs", "held"))
    listed = found.filter("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "of"))
    listed = settle(listed.select("block", "place", F.col("of.pairs").alias("pair"), F.col("of.held").alias("held")).filter("held > 0"))
    totals = listed.groupBy("pair").agg(F.sum("held").alias("n"))
    # An id of A meets at most as many ids as B has.
    of_a = W.partitionBy(F.shiftright("pair", 32))
    ranked = totals.withColumn("best", (F.col("n") == F.max("n").over(of_a)).cast("int"))
    counts = listed.select("block", "place", "pair").join(ranked, "pair").select("block", "place", "n", "best")
    kept = found.filter("pairs IS NULL").select("block", *numbers, *carry, "places", "links")
    ship(documents.sparkSession)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.drop("block", "places", "links").schema)
    return kept.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_tally, f"{kinds}, n_best long, count_sum long")
