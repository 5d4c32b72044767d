"""Merkle manifest of a table: a root over all rows, and for each row a proof that leads from its leaf to the root.

Rows are leaves (hashed by Spark's own expressions, so texts never reach Python), in one binary tree for each `lang`; the
trees' roots, in the order of `lang`, are the leaves of a last tree. Leaves are numbered within their tree by a range sort:
each task's rows are counted, and the sums of the tasks before give the offsets.

2^`bits` consecutive nodes are a superblock. A first exchange reduces each to one node; these nodes are reduced in the same
way until a tree is one superblock. On the way back, the nodes of a superblock and the row with the outer siblings that all
of them need are cogrouped: one function finishes the local reduction, joins local and outer siblings to proofs and folds.
No group is larger than a superblock, however many rows a `lang` has; nothing but the greatest tree size reaches the driver.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from viewpulse.llm.shipping import ship
from viewpulse.llm.sizing import ranges
from viewpulse.sources.tables import settle

BITS = 10
#: Bytes of the documents table whose leaves are sorted in one task.
RANGE_BYTES = 256 << 20
#: Every row whose id's crc32 is divisible by this is tampered with in the trial.
TAMPERED = 7

NODE = "tree string, idx long, size long, digest string"
WAY = "tree string, idx long, way array<string>, top string"


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def part(value: Column) -> Column:
    """A value's share of a leaf: `-` if null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(n_chars: Column) -> Column:
    return F.sha2(F.concat(part(F.col("doc_id")), part(F.col("source")), part(F.col("lang")), part(n_chars), part(F.col("text"))), 256)


def number(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """`rows` with idx (position within `tree` by `order`, from 0) and size (rows of the tree)."""
    key = ["tree", *order]
    sorted_rows = rows.repartitionByRange(n, *key).sortWithinPartitions(*key)
    # Written with the positions: a task that is run again later reads the same ones.
    held = settle(sorted_rows.withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()}))
    runs = held.groupBy("tree", "_part").agg(F.min("_pos").alias("_first"), F.count("*").alias("_n"))
    own = W.partitionBy("tree")
    before = F.sum("_n").over(own.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    starts = runs.select("tree", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(own).alias("size"))
    placed = held.join(starts, ["tree", "_part"])
    return placed.select(*rows.columns, (F.col("_pos") + F.col("_shift")).alias("idx"), "size")


def depth(size: int) -> int:
    """Levels above the leaves of a tree."""
    return (int(size) - 1).bit_length()


def climb(level: list[str]) -> list[str]:
    """The nodes above: every two consecutive ones hashed, a last single one too."""
    return [_hash("".join(level[i : i + 2])) for i in range(0, len(level), 2)]


def levels_of(nodes: pd.DataFrame, bits: int) -> list[list[str]]:
    """The levels of one superblock, from its nodes to its root or the tree's."""
    levels = [nodes["digest"].tolist()]
    for _ in range(min(bits, depth(nodes["size"].iat[0]))):
        levels.append(climb(levels[-1]))
    return levels


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """What stands beside the way up from node `at`: `L` or `R` and the digest, or nothing where a node is alone."""
    way = []
    for level in levels[:-1]:
        beside = at ^ 1
        way.append(("L" if beside < at else "R") + level[beside] if beside < len(level) else "")
        at >>= 1
    return way


def fold(digest: str, way: list[str]) -> str:
    """The root that `digest` and the siblings on its way lead to."""
    for beside in way:
        digest = _hash(beside[1:] + digest if beside[:1] == "L" else digest + beside[1:])
    return digest


def _reduce(bits: int):
    def run(nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("idx")
        tree, at, size = nodes["tree"].iat[0], int(nodes["idx"].iat[0]), int(nodes["size"].iat[0])
        above = [tree, at >> bits, (size + (1 << bits) - 1) >> bits, levels_of(nodes, bits)[-1][0]]
        return pd.DataFrame([above], columns=["tree", "idx", "size", "digest"])

    return run


def _join_ways(bits: int):
    def run(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("idx")
        levels, beyond, top = levels_of(nodes, bits), list(outer["way"].iat[0]), outer["top"].iat[0]
        rows = [[t, i, siblings(levels, at) + beyond, top] for at, (t, i) in enumerate(zip(nodes["tree"], nodes["idx"], strict=True))]
        return pd.DataFrame(rows, columns=["tree", "idx", "way", "top"])

    return run


def _prove(bits: int):
    def run(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("idx")
        levels, beyond = levels_of(leaves, bits), [*outer["way"].iat[0], *outer["last_way"].iat[0]]
        subroot, root = outer["top"].iat[0], outer["root"].iat[0]
        after = "".join(s[1:] for s in beyond)
        proofs, folded = [], []
        for at, (own, changed) in enumerate(zip(leaves["digest"], leaves["changed"], strict=True)):
            way = siblings(levels, at)
            proofs.append(_hash("".join(s[1:] for s in way) + after))
            folded.append(fold(changed or own, way + beyond))
        out = leaves[["doc_id"]].assign(leaf=leaves["digest"], subroot=subroot, root=root, proof_sha256=proofs, folded_root=folded)
        return out.assign(verified=out["folded_root"] == root)

    return run


def _blocks_of(nodes: DataFrame, bits: int, *more: str) -> DataFrame:
    return nodes.select("tree", "idx", "size", "digest", F.shiftright("idx", bits).alias("block"), *more)


def _reduced(nodes: DataFrame, bits: int) -> DataFrame:
    """One node for each superblock of `nodes`."""
    return settle(_blocks_of(nodes, bits).groupBy("tree", "block").applyInPandas(_reduce(bits), NODE))


def _ways(nodes: DataFrame, bits: int) -> DataFrame:
    """tree, idx, way (siblings up to the tree's root), top (that root) of every node."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    if most <= 1:
        return nodes.select("tree", "idx", F.array().cast("array<string>").alias("way"), F.col("digest").alias("top"))
    outer = _ways(_reduced(nodes, bits), bits).withColumnRenamed("idx", "block").groupBy("tree", "block")
    return settle(_blocks_of(nodes, bits).groupBy("tree", "block").cogroup(outer).applyInPandas(_join_ways(bits), WAY))


def manifest(documents: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, leaf, subroot (of its `lang`), root, proof_sha256, folded_root and verified of every row.

    `folded_root` is what the row's leaf and its siblings lead to; in every row whose id's crc32 is divisible by `TAMPERED`
    the leaf is that of the row with `n_chars` raised by one, which `verified` has to reveal. A null in any column is `-` in
    the leaf; a null `n_chars` stays null, so such a row verifies. Rows without `lang` are a tree of their own, the first.
    Rows without `doc_id` come first in their tree and are not tampered with; rows of one id are ordered by their leaves, and
    repeated rows are leaves of their own. An empty table gives no rows. Other columns are ignored.
    """
    ship(documents.sparkSession)
    tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    rows = documents.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-")).alias("tree"),
        leaf(F.col("n_chars")).alias("digest"),
        F.when(tampered, leaf(more)).alias("changed"),
    )
    leaves = settle(number(rows, ["doc_id", "digest"], ranges(documents, RANGE_BYTES)))
    blocks = _ways(_reduced(leaves, bits), bits)
    subroots = blocks.filter("idx = 0").select(F.lit("").alias("tree"), F.col("tree").alias("own"), F.col("top").alias("digest"))
    last = settle(number(subroots, ["own"], ranges(subroots, RANGE_BYTES)))
    ends = last.join(_ways(last, bits), ["tree", "idx"]).select(F.col("own").alias("tree"), F.col("way").alias("last_way"), F.col("top").alias("root"))
    outer = blocks.withColumnRenamed("idx", "block").join(ends, "tree")
    kind = documents.select("doc_id").schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    inner = _blocks_of(leaves, bits, "doc_id", "changed").groupBy("tree", "block")
    return inner.cogroup(outer.groupBy("tree", "block")).applyInPandas(_prove(bits), schema)
