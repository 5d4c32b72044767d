"""Writers for date-partitioned Parquet tables.

Parquet has no row-level merge, so a merge reads the partitions it touches, writes the result to a staging table on shared
storage and then overwrites exactly these partitions. Nothing is read and overwritten in one plan. The overwrite itself
commits date by date: a job lost during it leaves some dates new and some old, and the staging table stays. Merges and
replacements give the same rows when run again, so running the step again completes it.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager, nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.functions.dates import DateLike, back
from viewpulse.operators.upsert import upsert, upsert_newer
from viewpulse.schemas import ALL_TABLES, Table
from viewpulse.sources.files import scan


#: Bits of a cluster column's rank, and rows its quantiles are taken from.
RANK_BITS, SAMPLE_ROWS = 6, 20_000
#: Codec of stored and staging tables: a third smaller than Spark's default.
CODEC = "zstd"
LOCAL_MASTER = r"local(\[.*\])?"
_own: dict[str, str] = {}
_settled: dict[str, list[str]] = {}


def folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, root: str, table: Table) -> bool:
    fs, p = folder(spark, f"{root}/{table.path}")
    return fs.exists(p)


def stage_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: spark.checkpoint.dir. Only a local session may fall back to its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    # One process and one disk only in local[n]; local-cluster and all else have executors of their own.
    if not re.fullmatch(LOCAL_MASTER, spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _own.setdefault(spark.sparkContext.applicationId, f"{tempfile.gettempdir()}/viewpulse-stage-{uuid.uuid4().hex}")


def scratch(spark: SparkSession) -> str:
    """A new folder name for one run's intermediate tables."""
    return f"{stage_root(spark)}/viewpulse-{uuid.uuid4().hex}"


def settle(df: DataFrame, partition: str | None = None) -> DataFrame:
    """Write `df` to a staging table and read it back: cuts lineage and computes shared inputs once.

    The table stays, since results are computed later from it; `release` removes those of a session.
    """
    staged, path = _stage(df, partition)
    _settled.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return staged


def release(spark: SparkSession) -> None:
    """Remove the tables `settle` has left, when what was made from them has been read or written."""
    for path in _settled.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


@contextmanager
def settled(df: DataFrame) -> Iterator[DataFrame]:
    """As `settle`; the staging table goes when the block has succeeded. After a failure it stays for recovery."""
    staged, path = _stage(df)
    yield staged
    remove(df.sparkSession, path)


def _stage(df: DataFrame, partition: str | None = None) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch(spark)
    if partition:
        df.hint("rebalance", F.col(partition)).write.partitionBy(partition).parquet(path, compression=CODEC)
    else:
        df.write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns), path


def remove(spark: SparkSession, path: str) -> None:
    fs, p = folder(spark, path)
    fs.delete(p, True)


def by_partition(df: DataFrame, table: Table) -> DataFrame:
    """Rows of a date together, so a date is a few files; AQE splits big dates and joins small ones."""
    return df.hint("rebalance", F.col(table.partition)) if table.partition else df


def _bounds(df: DataFrame, columns: list[str], keys: Sequence[str]) -> list[list]:
    """For each column, values that cut it into 2^`RANK_BITS` ranges of about equal rows, from a sample of `SAMPLE_ROWS` rows:
    those of the smallest hashes of keys and columns, so the same rows give the same sample. A bound on the hash that leaves
    about twice as many keeps the sort from growing with the table."""
    counts = df.agg(*[F.count(c) for c in columns]).first()
    return [_cuts(df, c, F.xxhash64(*dict.fromkeys([*keys, *columns])), n) for c, n in zip(columns, counts, strict=True)]


def _cuts(df: DataFrame, column: str, mark: Column, rows: int) -> list:
    drawn = df.filter(F.col(column).isNotNull()).select(F.col(column), mark.alias("_h"))
    if rows > 4 * SAMPLE_ROWS:
        drawn = drawn.filter(F.col("_h") < -(1 << 63) + (1 << 64) * 2 * SAMPLE_ROWS // rows)
    values = sorted(r[0] for r in drawn.orderBy("_h", column).limit(SAMPLE_ROWS).collect())
    return sorted({values[i * len(values) >> RANK_BITS] for i in range(1, 1 << RANK_BITS)}) if values else []


def _rank(value: Column, cuts: list, below: int = 0) -> Column:
    """How many of the cuts are at or below the value, by halving; 0 for null."""
    if not cuts:
        return F.lit(below)
    half = len(cuts) // 2
    upper, lower = _rank(value, cuts[half + 1 :], below + half + 1), _rank(value, cuts[:half], below)
    return F.when(value >= F.lit(cuts[half]), upper).otherwise(lower)


def _interleaved(ranks: list[Column]) -> Column:
    """The bits of the ranks in turn, highest first: near in all of them is near in this."""
    n = len(ranks)
    bits = [F.shiftleft(F.shiftright(r, i).bitwiseAND(F.lit(1)).cast("bigint"), i * n + n - 1 - j) for i in range(RANK_BITS) for j, r in enumerate(ranks)]
    return reduce(lambda a, b: a + b, bits)


def clustered(df: DataFrame, table: Table, files: int | None = None) -> DataFrame:
    """Layout by date and cluster columns: min/max statistics let readers skip files and row groups.

    With several cluster columns, the bits of their quantile ranks are interleaved, so that a filter on any one of them
    prunes, not only on the first. The hash at the end lets a range boundary fall inside one hot user, who would otherwise be a
    single task and file.
    """
    cols = list(table.cluster)
    order = [table.partition, *cols] if table.partition else cols
    placed = df
    if len(cols) > 1:
        # A column, as an expression in an order is computed anew for both sides of each comparison.
        ranks = [_rank(F.col(c), cuts) for c, cuts in zip(cols, _bounds(df, cols, table.keys), strict=True)]
        placed = placed.withColumn("_near", _interleaved(ranks))
        order = [*order[: -len(cols)], "_near", *cols]
    # The hash of a row is taken where its range is found; as a column it would be shuffled, and nothing compresses it.
    ranges = [*order, F.xxhash64(*table.keys)]
    ranged = placed.repartitionByRange(files, *ranges) if files else placed.repartitionByRange(*ranges)
    return ranged.sortWithinPartitions(*order).drop("_near")


def _write(df: DataFrame, root: str, table: Table, mode: str) -> None:
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema]).write.mode("overwrite")
    if table.partition:
        out = out.partitionBy(table.partition).option("partitionOverwriteMode", mode)
    out.parquet(f"{root}/{table.path}", compression=CODEC)


def overwrite(df: DataFrame, root: str, table: Table) -> None:
    """First load, or a full rewrite from other tables."""
    _write(by_partition(df, table), root, table, "static")


def replace_days(df: DataFrame, root: str, table: Table) -> None:
    """Replace the dates present in `df` and leave the others: recovery of single days."""
    _write(by_partition(df, table), root, table, "dynamic")


def replace_range(df: DataFrame, root: str, table: Table, first: DateLike, last: DateLike | None = None) -> None:
    """Make `df` the whole content of the dates first..last (without `last`: of all later dates): what it lacks goes."""
    with settled(df) as staged:
        kept = {str(d) for d in partition_dates(staged, table.partition)}
        replace_days(staged, root, table)
        held = [d for d in stored_dates(df.sparkSession, root, table) if str(first) <= d and (last is None or d <= str(last))]
        _drop(df.sparkSession, root, table, set(held) - kept)


def on_dates(df: DataFrame, table: Table, dates: Iterable) -> DataFrame:
    """Rows of the listed partition dates, null among them if listed; the list prunes the folders that are read."""
    dates = list(dates)
    part = F.col(table.partition)
    known = part.isin([d for d in dates if d is not None])
    return df.filter(F.coalesce(known, F.lit(True)) if None in dates else known)


def replace_groups(fresh: DataFrame, root: str, table: Table, groups: DataFrame, dates: Iterable) -> None:
    """Make `fresh` all there is of the key groups in `groups`, which lie on `dates`; other groups and dates stay.

    The other rows of these dates are carried over, not computed again. A date that is left without rows goes.
    """
    spark, dates = fresh.sparkSession, list(dates)
    if not dates:
        return
    if not exists(spark, root, table):
        overwrite(fresh, root, table)
        return
    held = on_dates(scan(spark, root, table), table, dates)
    same = reduce(lambda a, b: a & b, [held[c].eqNullSafe(groups[c]) for c in groups.columns])
    with settled(held.join(groups, same, "left_anti").unionByName(fresh.select(*table.columns))) as merged:
        replace_days(merged, root, table)
        _drop(spark, root, table, set(dates) - set(partition_dates(merged, table.partition)))


def append(df: DataFrame, root: str, table: Table) -> None:
    out = by_partition(df, table).select(*table.columns).write.mode("append")
    (out.partitionBy(table.partition) if table.partition else out).parquet(f"{root}/{table.path}", compression=CODEC)


def rewrite(df: DataFrame, root: str, table: Table) -> None:
    """Replace a whole table with a result computed from itself."""
    with settled(df) as staged:
        overwrite(staged, root, table)


def stored_dates(spark: SparkSession, root: str, table: Table) -> list[str]:
    """Dates of a stored table, from its folders; no file is opened. The folder of missing dates is left out."""
    if not exists(spark, root, table):
        return []
    fs, p = folder(spark, f"{root}/{table.path}")
    values = [s.getPath().getName().partition("=")[2] for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(v for v in values if v and not v.startswith("__"))


def partition_dates(df: DataFrame, column: str) -> list:
    """Distinct partition dates: one row per day of data."""
    return [r[0] for r in df.select(column).distinct().collect()]


def upsert_table(
    source: DataFrame, root: str, table: Table, newer: str | None = None, match_days: int | None = None, is_settled: bool = False
) -> None:
    """Merge `source` into a stored table by its keys, creating it on first use.

    A key can move to another date. All dates are searched for it, reading only key columns; `match_days` limits the search
    to that many days around the source's dates where a key cannot be older. Only dates with a changed row are rewritten.
    A source that is a table already (`is_settled`) is read again instead of being written to a staging table first.
    """
    spark = source.sparkSession
    if not exists(spark, root, table):
        overwrite(source, root, table)
        return
    columns = source.select(*table.columns)
    with nullcontext(columns) if is_settled else settled(columns) as rows:
        if table.partition:
            _merge_days(rows, root, table, newer, match_days)
        else:
            rewrite(_merge(scan(spark, root, table), rows, table, newer), root, table)


def _merge(target: DataFrame, source: DataFrame, table: Table, newer: str | None) -> DataFrame:
    return upsert_newer(target, source, table.keys, newer) if newer else upsert(target, source, table.keys)


def _merge_days(source: DataFrame, root: str, table: Table, newer: str | None, match_days: int | None) -> None:
    spark, part = source.sparkSession, table.partition
    touched = set(partition_dates(source, part))
    known = [d for d in touched if d is not None]
    if not touched:
        return
    bounds = (back(min(known), match_days), back(max(known), -match_days)) if known and match_days is not None else (None, None)
    target = scan(spark, root, table, *bounds)
    if part not in table.keys:
        keys = source.select(*table.keys)
        same = reduce(lambda a, b: a & b, [target[k].eqNullSafe(keys[k]) for k in table.keys])
        touched |= set(partition_dates(target.join(keys, same, "left_semi"), part))
    held = F.col(part).isin([d for d in touched if d is not None])
    if None in touched:
        held = F.coalesce(held, F.lit(True))
    with settled(_merge(target.filter(held), source, table, newer)) as merged:
        replace_days(merged, root, table)
        # A date whose last row moved elsewhere is not in the result and has to go as a whole.
        _drop(spark, root, table, touched - set(partition_dates(merged, part)))


def _drop(spark: SparkSession, root: str, table: Table, dates: Iterable) -> None:
    for d in dates:
        value = "__HIVE_DEFAULT_PARTITION__" if d is None else d
        remove(spark, f"{root}/{table.path}/{table.partition}={value}")


def drop_days(spark: SparkSession, root: str, table: Table, first: DateLike, last: DateLike) -> None:
    """Remove the partitions of a range of dates, e.g. before a replay."""
    _drop(spark, root, table, [d for d in stored_dates(spark, root, table) if str(first) <= d <= str(last)])


def retain(spark: SparkSession, root: str, table: Table, today: DateLike, days: int) -> None:
    """Keep the last `days` days."""
    drop_days(spark, root, table, "0001-01-01", back(today, days))


def optimize(spark: SparkSession, root: str, table: Table, first: DateLike | None = None, last: DateLike | None = None) -> None:
    """Rewrite a table, or some of its dates, in clustered order."""
    with settled(scan(spark, root, table, first, last)) as staged:
        _write(clustered(staged, table), root, table, "dynamic" if table.partition else "static")


def register(spark: SparkSession, root: str, table: Table, name: str) -> None:
    """Put a stored table into the session catalog, with its declared schema and partitions."""
    cut = f"PARTITIONED BY ({table.partition})" if table.partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({table.ddl}) USING {table.format} {cut} LOCATION '{root}/{table.path}'")
    if table.partition:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def create_lake(spark: SparkSession, root: str, wanted: Iterable[Table] = ALL_TABLES) -> None:
    """All stored tables under their layer as database (`curated.dim_user`, ...), so SQL can be run against them."""
    for table in wanted:
        layer, name = table.path.split("/")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        register(spark, root, table, f"{layer}.{name}")


def analyze(spark: SparkSession, name: str) -> None:
    """Column statistics for the optimizer."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def export_csv(report: DataFrame, path: str) -> None:
    """A report as one CSV file with header, written by one task: for reports of a row per segment or a top-n list only."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
