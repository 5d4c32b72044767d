"""Token ids as Parquet list columns: written in `doc_id` order, read selectively.

Texts are range-partitioned by `doc_id` (ties and missing ids by a hash of the text, so no range outgrows a task), sorted
and tokenized where they end up. The writer gets row groups and pages of a set size and an encoding for the ids: dictionary
(indices of 16 bits for such vocabularies) or delta. Parquet writes page indexes; with rows in `doc_id` order a reader that
filters on it fetches the pages of the wanted documents only, and one that selects metadata never touches the ids.

Positions in the whole sequence need no pass over all rows: each task counts its ids as it writes, and the totals of the
tasks, one number for each file, are added up and stored beside the files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from viewpulse.llm.segments import library_encoder
from viewpulse.llm.shipping import in_arrow
from viewpulse.llm.sizing import ranges


#: Bytes of the documents table for a range, and the folder beside the files (which readers of these skip) with their totals.
RANGE_BYTES = 256 << 20
TOTALS = "_totals"


@dataclass(frozen=True)
class Layout:
    """How ids are stored. `encoding`: "dictionary" or "delta"."""

    encoding: str = "dictionary"
    row_group_bytes: int = 32 << 20
    page_bytes: int = 256 << 10
    dictionary_bytes: int = 1 << 20
    compression: str = "zstd"

    def options(self) -> dict[str, str]:
        if self.encoding not in ("dictionary", "delta"):
            raise ValueError(f"unknown encoding {self.encoding}")
        return {
            "parquet.block.size": str(self.row_group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.dictionary.page.size": str(self.dictionary_bytes),
            "parquet.enable.dictionary": str(self.encoding == "dictionary").lower(),
            # The second format version stores integers without a dictionary as deltas.
            "parquet.writer.version": "PARQUET_2_0",
            "compression": self.compression,
        }


LAYOUT = Layout()


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = library_encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            at = 0
            for ids, bounds in encoder.encode(batch.column("text").cast(pa.binary()).to_pylist()):
                n = len(bounds) - 1
                ended = np.insert(ids, bounds[1:], end_id).view(np.int32)
                ends = bounds + np.arange(n + 1)
                columns = [
                    batch.column("doc_id").slice(at, n),
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(start + ends[:-1]),
                    pa.array(np.diff(ends)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ended)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "start_in_part", "n_tokens", "ids"])
                start += int(ends[-1])
                at += n

    return run


def write_tokens(documents: DataFrame, target: str, path: str, end_id: int, files: int | None = None, layout: Layout = LAYOUT) -> None:
    """Encode every text with the tokenizer file at `path`, end it with `end_id` and write `target` in `doc_id` order.

    Rows without `doc_id` come first; rows of one id stand together, ordered by a hash of their text. A null or empty text
    has only the end id. Repeated rows are all written. Other columns are left out. An empty table gives an empty `target`.
    `files` is the number of ranges; by default Spark's, or more where the table is larger than `RANGE_BYTES` for each.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    order = [F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))]
    n = files or ranges(documents, RANGE_BYTES)
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"
    in_arrow(ranged, _encode(path, end_id), schema).write.options(**layout.options()).parquet(target)
    # A row for each range; readers of a few documents need not add up all of them.
    spark.read.parquet(target).groupBy("part").agg(F.sum("n_tokens").alias("n")).write.parquet(f"{target}/{TOTALS}")


def read_tokens(spark: SparkSession, target: str, first: int | None = None, last: int | None = None, ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and, if wanted, ids, of the documents in a range of ids."""
    rows = spark.read.parquet(target)
    totals = spark.read.parquet(f"{target}/{TOTALS}")
    # One row for each file, so a window over all of them is small.
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    bases = totals.select("part", before.alias("base"))
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    wanted = ["doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", *(["ids"] if ids else [])]
    return rows.join(F.broadcast(bases), "part").select(*wanted)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        values = memoryview(lists.values.to_numpy().astype("<u4", copy=False)).cast("B")
        at = (lists.offsets.to_numpy().astype(np.int64) * 4).tolist()
        sums = [zlib.crc32(values[a:b]) for a, b in zip(at, at[1:], strict=False)]
        columns = [*[batch.column(c) for c in ("doc_id", "start", "n_tokens")], pa.array(sums, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of rows from `read_tokens`: the CRC of the ids as little-endian 32-bit integers."""
    return in_arrow(tokens, _checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
