"""SimHash near-duplicates: fingerprints over word shingles, linked through pigeonhole blocks.

A 64-bit fingerprint is cut into `max_bits + 3` blocks. Two fingerprints that differ in at most `max_bits` bits agree on at
least three blocks, so they meet in the table of that combination; its key holds about 38 bits, which keeps chance meetings
rare however many documents there are. Pairs that meet are verified by their Hamming distance.

Copies share a fingerprint and are one node, whatever their number. Near copies can still crowd one block: above
`PAIR_ROWS` members no pairs are made. Their fingerprints are linked exactly in another way: each is listed under every
fingerprint one bit away and under itself, two are at most two bits apart if and only if they share such an entry, and an
entry has 65 members at most. Components are found by alternating star contractions, whose rows never exceed the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.shipping import in_arrow
from viewpulse.sources.tables import settle

BITS = 64
SHINGLE = 3
SEED = 42
MAX_BITS = 2
PAIR_ROWS = 64
CHUNK = 1 << 15

#: Near-duplicates by similarity: words of a shingle, least Jaccard similarity, share of such pairs that blocks bring together
#: (those further above are found more surely), 64-bit words of a fingerprint, pivots of a crowded block.
SIMILAR_SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.98
WIDE = 4
#: A block of up to so many nodes makes all its pairs as rows. A larger one links each node to its pivots first; what these do
#: not join is compared inside tasks, chunk against chunk, so that no pair of the block is left out and none becomes a row.
SIMILAR_PAIR_ROWS = 6
PIVOTS = 2
CHUNK_NODES = 512
CHUNK_BYTES = 8 << 20


def fingerprint(text: bytes | None, words_per_shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a UTF-8 text; 0 without words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - words_per_shingle + 1)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        part = words[at : min(at + CHUNK, n) + words_per_shingle - 1]
        shingles = map(b" ".join, zip(*[part[k:] for k in range(words_per_shingle)], strict=False)) if len(words) >= words_per_shingle else [b" ".join(words)]
        h = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def _fingerprints(words_per_shingle: int, keys: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = [fingerprint(t.as_py(), words_per_shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], pa.array(found, pa.int64())], schema=schema)

    return run


def fingerprints(documents: DataFrame, words_per_shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, fp of every document."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.col("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])
    return in_arrow(rows, _fingerprints(words_per_shingle, ["doc_id", "text_hash"], schema), "doc_id long, text_hash long, fp long")


def block_masks(max_bits: int = MAX_BITS) -> list[int]:
    """Signed masks, one for each choice of three of `max_bits + 3` blocks."""
    n = max_bits + 3
    cuts = [BITS * k // n for k in range(n + 1)]
    blocks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    masks = [a | b | c for a, b, c in combinations(blocks, 3)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _near(a: str, b: str, max_bits: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def links(fps: DataFrame, max_bits: int = MAX_BITS, pair_rows: int = PAIR_ROWS) -> DataFrame:
    """Links (a < b) whose connected components are those of all pairs at most `max_bits` apart.

    `fps` has distinct values in `fp`. Pairs are complete in blocks of up to `pair_rows`; in larger ones each entry of the
    one-bit neighbourhood is a star, which holds for `max_bits` up to 2.
    """
    if max_bits > 2:
        raise ValueError("neighbourhoods of one bit link distances up to 2")
    tables = [F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(block_masks(max_bits))]
    blocks = fps.select("fp", F.inline(F.array(*tables)))
    met = blocks.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1")
    met = settle(met)
    two = met.filter("n = 2").select("a", "b")
    more = settle(blocks.join(met.filter("n > 2").select("t", "key", "n"), ["t", "key"]))
    small = more.filter(F.col("n") <= pair_rows).select("t", "key", "fp")
    left, right = small.withColumnRenamed("fp", "a"), small.withColumnRenamed("fp", "b")
    some = left.join(right, ["t", "key"]).filter("a < b").select("a", "b")
    crowded = more.filter(F.col("n") > pair_rows).select("fp").distinct()
    steps = [0, *[(1 << k) - (1 << BITS if k == BITS - 1 else 0) for k in range(BITS)]]
    entries = crowded.select("fp", F.explode(F.array(*[F.lit(s) for s in steps])).alias("step"))
    stars = entries.groupBy(F.col("fp").bitwiseXOR(F.col("step")).alias("entry")).agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    starred = stars.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a < b")
    return two.unionByName(some).unionByName(starred).filter(_near("a", "b", max_bits)).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: every node of `edges` (a, b), with the smallest node it is connected to."""
    now = settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if seen == state or not seen["n"]:
            break
        state = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle(large)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        turned = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = lowest.select("u", F.col("m").alias("v"))
        now = settle(reduce(DataFrame.unionByName, [turned, kept]).distinct())
    # A star now has its smallest node in the middle.
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(documents: DataFrame, words_per_shingle: int = SHINGLE, max_bits: int = MAX_BITS, pair_rows: int = PAIR_ROWS) -> DataFrame:
    """doc_id, text_hash, fp, keeper (doc_id, text_hash of the document that stands for the component), one row per document.

    Null and empty texts and texts of white space have the fingerprint zero, which links like any other. Rows without
    `doc_id` take part; they stand for a component only if none in it has an id (then the smallest hash of a text does).
    Repeated rows each get a row. An empty table gives no rows. Other columns are ignored.
    """
    rows = settle(fingerprints(documents, words_per_shingle))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "text_hash"))
    classes = settle(rows.groupBy("fp").agg(first.alias("first")))
    nodes = components(links(classes.select("fp"), max_bits, pair_rows))
    labelled = classes.join(nodes, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    keepers = labelled.groupBy("root").agg(F.min("first").alias("keeper"))
    of_class = labelled.join(keepers, "root").select("fp", "keeper")
    return rows.join(of_class, "fp").select("doc_id", "text_hash", "fp", F.struct("keeper.doc_id", "keeper.text_hash").alias("keeper"))


def wide_fingerprint(text: bytes | None, words_per_shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """SimHash of `WIDE` 64-bit words, and the sorted hashes of the text's distinct shingles."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(WIDE, np.uint64), np.zeros(0, np.uint64)
    found = []
    for at in range(0, max(1, len(words) - words_per_shingle + 1), CHUNK):
        part = words[at : at + CHUNK + words_per_shingle - 1]
        shingles = map(b" ".join, zip(*[part[k:] for k in range(words_per_shingle)], strict=False)) if len(words) >= words_per_shingle else [b" ".join(words)]
        found.append(np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], np.uint64))
    grams = np.unique(np.concatenate(found))
    counts = np.zeros((WIDE, BITS), np.int64)
    for at in range(0, len(grams), CHUNK):
        h = grams[at : at + CHUNK]
        for k in range(WIDE):
            counts[k] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            # The next word is made from the last one by a 64-bit mixer.
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.packbits(counts * 2 > len(grams), axis=1, bitorder="little").view(np.uint64).ravel(), grams


def _wide(words_per_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [wide_fingerprint(t.as_py(), words_per_shingle)[0].tobytes() for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(found, pa.binary())], names=["doc_id", "text_hash", "wide"])

    return run


def _grams(words_per_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [wide_fingerprint(t.as_py(), words_per_shingle)[1].tobytes() for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], names=["node", "grams"])

    return run


def _tables(masks: np.ndarray):
    """Key of every class in every table: a hash of the fingerprint's bits that the table looks at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = np.frombuffer(b"".join(batch.column("wide").to_pylist()), np.uint64).reshape(-1, WIDE)
            for t, mask in enumerate(masks):
                key = np.zeros(len(wide), np.uint64)
                for k in range(WIDE):
                    key = (key ^ (wide[:, k] & mask[k])) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(wide), t, np.int32)), pa.array(key.view(np.int64)), batch.column("node")], names=["t", "key", "node"])

    return run


def _near_enough(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, WIDE) for c in ("wide_a", "wide_b"))
            near = np.bitwise_count(a ^ b).sum(axis=1) <= max_bits
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def _similar(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("grams_a").to_pylist(), batch.column("grams_b").to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                kept.append(shared >= similarity * (len(a) + len(b) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


def plan_tables(classes: int, similarity: float, recall: float) -> np.ndarray:
    """Masks of the tables: as many bits as keep chance meetings rare among so many classes, and as many tables as find a
    pair of the least similarity with the probability `recall`.

    A bit of two SimHashes differs with the angle of their shingle sets over pi.
    """
    same = 1 - np.arccos(2 * similarity / (1 + similarity)) / np.pi
    bits = max(12, int(np.ceil(np.log2(max(classes, 2)))) + 1)
    tables = int(np.ceil(np.log(1 - recall) / np.log(1 - same**bits)))
    random = np.random.default_rng(SEED)
    masks = np.zeros((tables, WIDE), np.uint64)
    for mask in masks:
        for bit in random.choice(WIDE * BITS, bits, replace=False):
            mask[bit // BITS] |= np.uint64(1) << np.uint64(bit % BITS)
    return masks


def candidates(classes: DataFrame, masks: np.ndarray, pair_rows: int = SIMILAR_PAIR_ROWS) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a < b) of nodes that share a block, and the rows (t, key, node) of crowded blocks.

    A block of over `pair_rows` nodes is crowded: its pairs are those with `PIVOTS` of its nodes, the others are for
    `crowd_links`.
    """
    blocks = in_arrow(classes.select("node", "wide"), _tables(masks), "t int, key long, node long")
    blocks = settle(blocks)
    met = settle(blocks.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("a"), F.max("node").alias("b")).filter("n > 1"))
    more = settle(blocks.join(met.filter("n > 2").select("t", "key", "n"), ["t", "key"]))
    small = more.filter(F.col("n") <= pair_rows).select("t", "key", "node")
    left, right = small.withColumnRenamed("node", "a"), small.withColumnRenamed("node", "b")
    some = left.join(right, ["t", "key"]).filter("a < b").select("a", "b")
    crowded = more.filter(F.col("n") > pair_rows).select("t", "key", "node")
    chosen = [F.min_by("node", F.xxhash64("node", "t", F.lit(i))).alias(f"p{i}") for i in range(PIVOTS)]
    pivots = settle(crowded.groupBy("t", "key").agg(*chosen).select("t", "key", F.array(*[f"p{i}" for i in range(PIVOTS)]).alias("pivots")))
    starred = crowded.join(pivots, ["t", "key"]).select("node", F.explode("pivots").alias("pivot")).filter("node <> pivot")
    starred = starred.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    return met.filter("n = 2").select("a", "b").unionByName(some).unionByName(starred).distinct(), crowded


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows of one block and pair of chunks, from sorted batches."""
    open_rows: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("t", "key", "i", "j")])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for at, end in zip(cuts, cuts[1:], strict=False):
            key = tuple(keys[:, at].tolist())
            if key != last and open_rows:
                yield pa.Table.from_batches(open_rows)
                open_rows = []
            last = key
            open_rows.append(batch.slice(at, end - at))
    if open_rows:
        yield pa.Table.from_batches(open_rows)


def _facing(group: pa.Table, max_bits: int) -> tuple[np.ndarray, Iterator[tuple[int, np.ndarray]]]:
    """Root of each row, and row by row the later rows it is to be compared with: near enough, and of other chunks if there are two."""
    wide = np.frombuffer(b"".join(group.column("wide").to_pylist()), np.uint64).reshape(-1, WIDE)
    chunk, roots = group.column("chunk").to_numpy(), group.column("root").to_numpy().copy()
    two = group.column("i")[0] != group.column("j")[0]

    def rows() -> Iterator[tuple[int, np.ndarray]]:
        for x in range(len(wide) - 1):
            others = roots[x + 1 :] != roots[x]
            if two:
                others &= chunk[x + 1 :] != chunk[x]
            others = np.flatnonzero(others) + x + 1
            if len(others):
                yield x, others[np.bitwise_count(wide[others] ^ wide[x]).sum(axis=1) <= max_bits]

    return roots, rows()


def _live(max_bits: int):
    """t, key, node of the nodes that are near enough to a node of another root in their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            live = np.zeros(group.num_rows, bool)
            for x, others in _facing(group, max_bits)[1]:
                live[others] = True
                live[x] |= len(others) > 0
            if live.any():
                yield from group.select(["t", "key", "node"]).filter(pa.array(live)).combine_chunks().to_batches()

    return run


def _joined(max_bits: int, similarity: float):
    """Links that join what is similar in a group: no link between rows that are joined already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            grams = [np.frombuffer(g, np.uint64) for g in group.column("grams").to_pylist()]
            nodes, sizes = group.column("node").to_numpy(), np.array([len(g) for g in grams])
            ids = np.split(np.unique(np.concatenate(grams), return_inverse=True)[1], np.cumsum(sizes)[:-1])
            mark = np.zeros(sizes.sum() + 1, bool)
            found: list[tuple[int, int]] = []
            roots, facing = _facing(group, max_bits)
            for x, others in facing:
                least, most = np.minimum(sizes[others], sizes[x]), np.maximum(sizes[others], sizes[x])
                others = others[(least >= similarity * most) & (least > 0)]
                if not len(others):
                    continue
                mark[ids[x]] = True
                shared = np.add.reduceat(mark[np.concatenate([ids[y] for y in others])], np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
                mark[ids[x]] = False
                for y in others[shared >= similarity * (sizes[x] + sizes[others] - shared)].tolist():
                    if roots[y] != roots[x]:
                        found.append((int(nodes[x]), int(nodes[y])))
                        roots[roots == roots[y]] = roots[x]
            columns = zip(*found, strict=True) if found else [[]] * 2
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["a", "b"])

    return run


def _chunked(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of blocks once for each pair of chunks (i <= j) that their chunk is in, sorted. `sizes`: t, key, chunks."""
    dealt = rows.join(sizes, ["t", "key"]).withColumn("chunk", F.pmod(F.xxhash64("node", "t"), "chunks"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    met = met.withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")).drop("chunks", "other")
    return met.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")


def crowd_links(crowded: DataFrame, roots: DataFrame, wide: DataFrame, grams_of, max_bits: int, similarity: float) -> DataFrame | None:
    """Links (a, b) between similar nodes of crowded blocks whose `roots` (node, root) differ; None if no two are near enough.

    Every such pair of a block is compared. A block is cut into chunks of bounded size, each pair of chunks is one group of
    rows, and pairs exist only inside a task: first by fingerprint, then, of the nodes left, by their shingles.
    `grams_of(nodes)` gives node, grams.
    """
    rooted = crowded.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rooted.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    sizes = sizes.select("t", "key", F.ceil(F.col("n") / CHUNK_NODES).alias("chunks"))
    rows = _chunked(settle(rooted.join(wide, "node")), settle(sizes))
    live = settle(in_arrow(rows, _live(max_bits), "t int, key long, node long").distinct())
    if live.isEmpty():
        return None
    grams = settle(grams_of(live.select("node").distinct()))
    left = live.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(wide, "node").join(grams, "node")
    size = F.greatest(F.count(F.lit(1)) / CHUNK_NODES, F.sum(F.length("grams")) / CHUNK_BYTES)
    sizes = live.join(grams, "node").groupBy("t", "key").agg(F.greatest(F.ceil(size), F.lit(1)).alias("chunks"))
    return in_arrow(_chunked(left, settle(sizes)), _joined(max_bits, similarity), "a long, b long")


def _tied(linked: DataFrame, marked: DataFrame) -> DataFrame:
    """Links (a, b) from the node of each text to that of the text which stands for its component in `linked`."""
    node_of = marked.select("text_hash", "node").distinct()
    to = linked.select("text_hash", F.col("keeper.text_hash").alias("_keeper")).filter(F.col("text_hash") != F.col("_keeper")).distinct()
    met = to.join(node_of.toDF("text_hash", "a"), "text_hash").join(node_of.toDF("_keeper", "b"), "_keeper")
    return met.filter("a <> b").select("a", "b").distinct()


def similar_documents(
    documents: DataFrame, words_per_shingle: int = SIMILAR_SHINGLE, similarity: float = SIMILARITY, recall: float = RECALL, pair_rows: int = SIMILAR_PAIR_ROWS,
    linked: DataFrame | None = None,
) -> DataFrame:
    """doc_id, text_hash, keeper, one row per document: near-duplicates by the Jaccard similarity of their word shingles.

    Two bits apart are only the closest copies: at a similarity of 0.8 a seventh of all bits differ. So fingerprints are
    wide, blocks are choices of their bits, pairs that share a block are verified by Hamming distance and then by the exact
    similarity of the two texts. All pairs of a block are, unless links have joined the two by then. Awkward rows are treated as in `near_duplicates`; texts without words are copies of each
    other.

    `linked` is what `near_duplicates` gives for the same documents: its components hold, whatever the similarity inside them,
    and the links found here join them.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.col("text"))
    marked = settle(in_arrow(rows, _wide(words_per_shingle), "doc_id long, text_hash long, wide binary").withColumn("node", F.xxhash64("wide")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "text_hash"))
    classes = settle(marked.groupBy("node").agg(first.alias("first"), F.min("wide").alias("wide")))
    masks = plan_tables(classes.count(), similarity, recall)
    wide = classes.select("node", "wide")
    pairs, crowded = candidates(classes, masks, pair_rows)
    pairs = pairs.join(wide.toDF("a", "wide_a"), "a").join(wide.toDF("b", "wide_b"), "b")
    differ = np.arccos(2 * similarity / (1 + similarity)) / np.pi * WIDE * BITS
    max_bits = int(differ + 3 * np.sqrt(differ))
    near = settle(in_arrow(pairs, _near_enough(max_bits), "a long, b long"))

    def grams_of(nodes: DataFrame) -> DataFrame:
        wanted = classes.join(nodes, "node").select("node", F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        grams = in_arrow(rows.join(wanted, same).select("node", "text"), _grams(words_per_shingle), "node long, grams binary")
        return grams.groupBy("node").agg(F.min("grams").alias("grams"))

    grams = settle(grams_of(near.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
    checked = near.join(grams.toDF("a", "grams_a"), "a").join(grams.toDF("b", "grams_b"), "b")
    links = settle(in_arrow(checked, _similar(similarity), "a long, b long"))
    if linked is not None:
        links = settle(links.unionByName(_tied(linked, marked)))
    found = components(links)
    more = crowd_links(crowded, found, wide, grams_of, max_bits, similarity)
    if more is not None:
        found = components(links.unionByName(more))
    labelled = classes.join(found, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    keepers = labelled.groupBy("root").agg(F.min("first").alias("keeper"))
    of_class = settle(labelled.join(keepers, "root").select("node", F.struct("keeper.doc_id", "keeper.text_hash").alias("keeper")))
    return marked.join(of_class, "node").select("doc_id", "text_hash", "keeper")


def drop_near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """The rows of `documents` that stand for their group of similar documents; of repeated rows one stays. Options are those
    of `similar_documents`."""
    stay = similar_documents(documents, **options).filter(F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("text_hash") == F.col("keeper.text_hash")))
    stay = stay.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    row = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_d"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"))
    same = F.col("_d.doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash"))
    return row.join(stay, same).groupBy("_id", "_hash").agg(F.any_value("_d").alias("_d")).select("_d.*")
