"""Line deduplication: lines found in many documents stay in one of them only.

Built-in expressions only. Lines are exploded with their position, normalised and hashed; documents are counted per hash;
lines of frequent hashes are dropped everywhere but in the largest `doc_id` that holds them; what is left of a document is
put together again in the order of positions.

Only hashes travel in the counting shuffles. The distinct count is first dealt out by (hash, document), so a line that a
third of all documents share is counted by many tasks. Texts are shuffled once, to meet the positions they lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.sources.tables import settle

#: White space stripped from both ends of a line, and the letters that are lower-cased.
LINE_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

MIN_CHARS = 40
MIN_DOCS = 5


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(LINE_SPACE)), UPPER, LOWER)


def _long_lines(documents: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, text_hash, pos, h1, h2 of every line with a key of at least `min_chars` code points."""
    # The hash of the text is made below the explosion: beside it, it would be made again for every line.
    split = documents.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), lines_of(F.col("text")).alias("lines"))
    lines = split.select("doc_id", "text_hash", F.posexplode("lines").alias("pos", "line"))
    keyed = lines.filter(F.char_length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
    # Two hashes with different starts: 128 bits, so that lines of a large corpus do not meet by chance.
    return keyed.filter(F.char_length("key") >= min_chars).select(
        "doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), F.col("key")).alias("h2")
    )


def _dropped(documents: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """Per doc_id and text: the positions that go."""
    lines = settle(_long_lines(documents, min_chars))
    frequent = (
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct(F.struct("doc_id")).alias("docs"), F.max("doc_id").alias("holder"))
        .filter(F.col("docs") >= min_docs)
        .select("h1", "h2", "holder")
    )
    # A table of its own leaves the join free to split the lines of a hot hash among tasks.
    frequent = settle(frequent)
    lost = lines.join(frequent, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("holder")))
    return lost.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("gone"))


def dedup_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, counts: bool = True) -> DataFrame:
    """`documents` with `text` shortened, plus `n_lines` (before) and `n_dropped` if `counts`.

    A null or empty text is one empty line and comes out as "". Rows without `doc_id` count as one document, which never
    keeps a line that one with an id holds; if only they hold it, nothing goes. Repeated rows and rows that share an id are
    one document to the count and lose the same lines. A text whose lines all go is "". The work grows with the lines of a
    text, however many it loses. Other columns pass through; with `counts`, columns of these two names are replaced.
    """
    gone = _dropped(documents, min_chars, min_docs).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("gone").alias("_gone")
    )
    # The lines travel instead of the text, so it is split once, below the join, and positions are looked up in an array.
    rest = [F.col(f"`{c}`") for c in documents.columns if c != "text"]
    row = documents.select(
        F.struct(*rest).alias("_d"), lines_of(F.col("text")).alias("_lines"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_own_hash")
    )
    same = F.col("_d.doc_id").eqNullSafe(F.col("_id")) & (F.col("_own_hash") == F.col("_hash"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(F.transform(left, lambda i: F.get(F.col("_lines"), i)))
    counted = {
        "n_lines": F.size("_lines").cast("bigint"),
        "n_dropped": F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint"),
    } if counts else {}
    passed = [F.array_join(kept, "\n").alias(c) if c == "text" else F.col(f"_d.`{c}`") for c in documents.columns if c not in counted]
    return row.join(gone, same, "left").select(*passed, *[c.alias(n) for n, c in counted.items()])
