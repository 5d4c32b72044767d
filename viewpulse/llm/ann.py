"""Nearest neighbours by inner product over shifted Hilbert curves.

Vectors are projected on a few random orthonormal directions, shifted and put on a grid, once for each curve; their Hilbert
key orders them. Spark range-partitions all vectors by curve and key. A query is compared with the windows of keys around it
on every curve; the results are merged and ranked by exact scores. That gives each query a bound: the score of its k-th
neighbour so far.

Windows alone find what lies close. In vectors without structure, most of the k nearest lie far off and no order keeps them
together, so the search is completed exactly: blocks of the first curve are compared with chunks of queries, and what
reaches a query's bound joins the ranking. A block no query of a chunk can gain from (by its centre and radius) is skipped.
`complete=False` leaves this out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from viewpulse.llm.shipping import in_arrow
from viewpulse.sources.tables import settle

K = 20
CURVES = 4
AXES = 8
GRID_BITS = 7
WINDOW_ROWS = 1024
BLOCK_ROWS = 4096
CHUNK_QUERIES = 512
SAMPLE = 4096
SEED = 42
#: Matrix products differ in their last digits by position; what is this close to a bound is scored again, pair by pair.
SLACK = 1e-9

_FOUND = "query_id long, vec_id long, score double"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with integer coordinates of `bits` bits, one column for each axis."""
    x = [c.astype(np.int64) for c in cells.T]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = (key << 1) | (((c ^ turn) >> b) & 1)
    return key


@dataclass(frozen=True)
class Curves:
    """Projection, scale and shift of each curve."""

    axes: list[np.ndarray]
    low: list[np.ndarray]
    width: list[np.ndarray]
    shift: list[np.ndarray]

    def keys(self, curve: int, vectors: np.ndarray) -> np.ndarray:
        # Half of the grid holds the sample's range, the shift moves it inside the other half.
        at = (vectors @ self.axes[curve] - self.low[curve]) / self.width[curve]
        side = (1 << GRID_BITS) - 1
        return hilbert_keys(np.clip((at + self.shift[curve]) / 2 * side, 0, side), GRID_BITS)


def fit_curves(sample: np.ndarray, curves: int, dimension: int) -> Curves:
    random = np.random.default_rng(SEED)
    made: tuple[list, list, list, list] = ([], [], [], [])
    for _ in range(curves):
        axes = np.linalg.qr(random.standard_normal((dimension, dimension)))[0][:, :AXES]
        on = sample @ axes if len(sample) else np.zeros((1, axes.shape[1]))
        width = on.max(0) - on.min(0)
        for part, value in zip(made, (axes, on.min(0), np.where(width > 0, width, 1.0), random.random(axes.shape[1])), strict=True):
            part.append(value)
    return Curves(*made)


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, vector array<double> of the rows that take part, one for each id."""
    v = F.col("embedding").cast("array<double>")
    sound = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("vector")).filter(F.col("vec_id").isNotNull() & v.isNotNull() & sound)
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dimension)


def _on_curves(shared, dimension: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        curves: Curves = shared.value
        for batch in batches:
            vectors = _matrix(batch.column("vector"), dimension)
            raw = pa.array([v.tobytes() for v in vectors], pa.binary())
            for c in range(len(curves.axes)):
                columns = [pa.array(np.full(len(vectors), c, np.int32)), pa.array(curves.keys(c, vectors)), batch.column("vec_id"), raw]
                yield pa.RecordBatch.from_arrays(columns, names=["curve", "key", "vec_id", "raw"])

    return run


@dataclass
class Block:
    ids: np.ndarray
    vectors: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[int, Block]]:
    """Consecutive rows of one curve, `rows` at most."""
    curve, ids, raw = None, [], []

    def cut() -> tuple[int, Block]:
        return curve, Block(np.array(ids, np.int64), np.frombuffer(b"".join(raw)).reshape(len(ids), -1))

    for batch in batches:
        for c, i, r in zip(*(batch.column(n).to_pylist() for n in ("curve", "vec_id", "raw")), strict=True):
            if ids and (c != curve or len(ids) == rows):
                yield cut()
                ids, raw = [], []
            curve = c
            ids.append(i)
            raw.append(r)
    if ids:
        yield cut()


def best(queries: Block, rows: Block, k: int, bounds: np.ndarray | None = None) -> pa.RecordBatch:
    """The k best rows for each query that reach its bound: by exact score, ties to smaller ids, a query's own id left out."""
    products = queries.vectors @ rows.vectors.T
    products[queries.ids[:, None] == rows.ids[None, :]] = -np.inf
    least = np.full(len(queries.ids), -np.inf)
    if len(rows.ids) > k:
        least = np.partition(products, -k, axis=1)[:, -k]
    if bounds is not None:
        least = np.maximum(least, bounds)
    slack = SLACK * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
    q, r = np.nonzero((products >= (least - slack)[:, None]) & (products > -np.inf))
    exact = (queries.vectors[q] * rows.vectors[r]).sum(axis=1)
    order = np.lexsort((rows.ids[r], -exact, q))
    q, r, exact = q[order], r[order], exact[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    q, r, exact = q[rank < k], r[rank < k], exact[rank < k]
    return pa.RecordBatch.from_arrays([pa.array(queries.ids[q]), pa.array(rows.ids[r]), pa.array(exact)], names=["query_id", "vec_id", "score"])


def _windows(k: int, every: int, rows: int):
    def search(around: list[Block], middle: Block) -> pa.RecordBatch:
        asked = middle.ids % every == 0
        near = Block(np.concatenate([b.ids for b in around]), np.concatenate([b.vectors for b in around]))
        return best(Block(middle.ids[asked], middle.vectors[asked]), near, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        curve, held = None, []
        for c, block in _blocks(batches, rows):
            if c != curve:
                if held:
                    yield search(held, held[-1])
                curve, held = c, []
            held = [*held[-2:], block]
            if len(held) > 1:
                yield search(held, held[-2])
        if held:
            yield search(held[-2:], held[-1])

    return run


def _pack_blocks(rows: int):
    schema = ["block", "ids", "vectors"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for n, (_, b) in enumerate(_blocks(batches, rows)):
            yield pa.RecordBatch.from_arrays([pa.array([part + n]), pa.array([b.ids.tobytes()]), pa.array([b.vectors.tobytes()])], names=schema)

    return run


def _complete(k: int, dimension: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"]).reshape(-1, dimension))
                asked = row["queries"]
                queries = Block(np.array([x["vec_id"] for x in asked]), np.frombuffer(b"".join(x["raw"] for x in asked)).reshape(-1, dimension))
                bounds = np.array([-np.inf if x["bound"] is None else x["bound"] for x in asked])
                centre = block.vectors.mean(0)
                radius = np.sqrt(((block.vectors - centre) ** 2).sum(1).max())
                reach = queries.vectors @ centre + np.sqrt((queries.vectors**2).sum(1)) * radius
                gain = reach + SLACK * (1 + np.abs(reach)) >= bounds
                if gain.any():
                    yield best(Block(queries.ids[gain], queries.vectors[gain]), block, k, bounds[gain])

    return run


def nearest(embeddings: DataFrame, k: int = K, every: int = 20, curves: int = CURVES, complete: bool = True, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best others for each vector whose id is divisible by `every`.

    Nearness is the inner product in double precision, ties go to the smaller id. Null and zero vectors, those with null or
    non-finite components, rows without `vec_id` and vectors of another length than most take no part. Rows that share an
    id count once, with the smallest of their vectors. With fewer than k candidates all are returned; an empty table gives
    no rows. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = settle(usable(embeddings))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimension, total = lengths["n"], lengths["count"]
    rows = rows.filter(F.size("vector") == dimension)
    sample = np.array([r.vector for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()])
    shared = spark.sparkContext.broadcast(fit_curves(sample, curves, dimension))
    keyed = settle(in_arrow(rows, _on_curves(shared, dimension), "curve int, key long, vec_id long, raw binary"))
    order = ["curve", "key", "vec_id"]
    parts = max(1, -(-total * curves // (16 * window_rows)))
    windows = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = in_arrow(windows, _windows(k, every, window_rows), _FOUND)
    if complete:
        found = settle(found)
        found = found.unionByName(_rest(keyed, found, k, every, dimension, total))
    ranked = found.distinct().withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _rest(keyed: DataFrame, found: DataFrame, k: int, every: int, dimension: int, total: int) -> DataFrame:
    """All that reaches the bounds of the queries, from every block of the first curve."""
    own = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = found.distinct().withColumn("rank", F.row_number().over(own)).filter(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
    one = keyed.filter("curve = 0")
    queries = one.filter(F.col("vec_id") % every == 0).join(kth, F.col("vec_id") == F.col("query_id"), "left")
    chunks = max(1, -(-total // every // CHUNK_QUERIES))
    chunked = queries.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).alias("chunk")).agg(F.collect_list(F.struct("vec_id", "raw", "bound")).alias("queries"))
    parts = max(1, -(-total // (4 * BLOCK_ROWS)))
    ranged = one.repartitionByRange(parts, "key", "vec_id").sortWithinPartitions("key", "vec_id")
    blocks = in_arrow(ranged, _pack_blocks(BLOCK_ROWS), "block long, ids binary, vectors binary")
    # The stated queries against all rows: every block meets every chunk, in tasks of a chunk and a share of the blocks.
    met = blocks.select("*", F.pmod(F.xxhash64("block"), F.lit(parts)).alias("share"), F.explode(_numbers(chunks)).alias("chunk"))
    copies = chunked.select("*", F.explode(_numbers(parts)).alias("share"))
    return in_arrow(met.join(copies, ["chunk", "share"]).select("ids", "vectors", "queries"), _complete(k, dimension), _FOUND)


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))
