"""An append-only log of a stream's batches, with compaction beside it.

Each batch is one folder, a run, that nothing rewrites: a batch that is delivered again replaces just itself. Readers resolve
what copies of a row in several runs come to (the latest copy, the union of sketches). Compaction merges consecutive runs of
about one length into one, so a row is rewritten as often as the number of runs has digits, and a table that takes a batch
every few seconds stays a few dozen runs. A run counts once its marker file is there: what a lost job has left is not seen, and
the next compaction writes it again. Runs that a merged one contains are not read any more, but go only at the next
compaction, when the readers that had listed them have ended.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from viewpulse.sources.tables import folder, remove

Run = tuple[int, int]
Resolve = Callable[[DataFrame], DataFrame]

#: Runs of about one length that are merged into one.
FAN_IN = 8
_NAME = re.compile(r"run=(\d+)-(\d+)")
_DONE = "_SUCCESS"


def _path(root: str, run: Run) -> str:
    return f"{root}/run={run[0]:012d}-{run[1]:012d}"


def append(stream: DataFrame, root: str, checkpoint: str, prepare: Resolve, **trigger) -> StreamingQuery:
    """Write what `prepare` makes of each batch as a run of its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(_path(root, (batch_id, batch_id)))

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def runs(spark: SparkSession, root: str) -> list[Run]:
    """Runs that are complete: one name for each, no file is opened."""
    fs, path = folder(spark, root)
    if not fs.exists(path):
        return []
    named = [(_NAME.fullmatch(s.getPath().getName()), s.getPath().toString()) for s in fs.listStatus(path)]
    return sorted((int(m[1]), int(m[2])) for m, p in named if m and fs.exists(folder(spark, f"{p}/{_DONE}")[1]))


def visible(complete: Sequence[Run]) -> list[Run]:
    """Those that no other contains. Runs are made of consecutive ones, so they contain each other or do not meet."""
    found: list[Run] = []
    for run in sorted(complete, key=lambda r: (r[0], -r[1])):
        if not found or run[0] > found[-1][1]:
            found.append(run)
    return found


def _read(spark: SparkSession, root: str, some: Sequence[Run], schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*[_path(root, r) for r in some]) if some else spark.createDataFrame([], schema)


def read(spark: SparkSession, root: str, schema, resolve: Resolve) -> DataFrame:
    """The log's rows, resolved."""
    return resolve(_read(spark, root, visible(runs(spark, root)), schema))


def _tier(run: Run, fan_in: int) -> int:
    n, tier = run[1] - run[0] + 1, 0
    while n >= fan_in:
        n, tier = n // fan_in, tier + 1
    return tier


def mergeable(seen: Sequence[Run], fan_in: int) -> list[Run]:
    """The oldest `fan_in` neighbours of one tier; none if there are not so many."""
    for at in range(len(seen) - fan_in + 1):
        some = list(seen[at : at + fan_in])
        if len({_tier(r, fan_in) for r in some}) == 1:
            return some
    return []


def compact(spark: SparkSession, root: str, schema, resolve: Resolve, fan_in: int = FAN_IN) -> int:
    """Merge runs as long as there are `fan_in` neighbours of one tier; how many merges were made."""
    complete = runs(spark, root)
    for run in set(complete) - set(visible(complete)):
        remove(spark, _path(root, run))
    merges = 0
    while some := mergeable(visible(runs(spark, root)), fan_in):
        merged = resolve(_read(spark, root, some, schema))
        merged.write.mode("overwrite").parquet(_path(root, (some[0][0], some[-1][1])))
        merges += 1
    return merges
