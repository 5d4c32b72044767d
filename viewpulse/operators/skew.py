"""Keeping hot keys out of single tasks.

`hot_keys` finds keys above a bound of rows from a hash sample of the rows: nothing is counted for the others, so the pass is
one narrow scan, and the result is a table, however many hot keys there are. The sample is a function of the rows, so a rerun
finds the same keys. Where a key has as many rows as the bound, 64 of them are expected in the sample and 32 are asked for:
such a key is missed with a probability below 3e-5 (Chernoff), one of twice the bound with one below 1e-23. A key that is
missed, or taken for hot without being it, changes the plan of its group and never the result.

Rows of hot keys are told by a join with that table, which Spark broadcasts when its files are small. Only these rows are
treated differently: `with_neighbour` (lead/lag) and `last_known` (running last value) cut a hot group into time slots. Inside
a slot an ordinary window runs; across slots only the edge rows of each slot are compared. Results equal the uncut window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from viewpulse.functions.dates import epoch_seconds
from viewpulse.sources.tables import settle

MIN_HOT_ROWS = 1_000_000
SLOT_SECONDS = 60
#: Rows of a key of exactly the bound that the sample is expected to hold.
EXPECTED = 64
_BUCKETS = 1 << 30


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], by: Sequence[str], min_rows: int = MIN_HOT_ROWS) -> DataFrame | None:
    """Table of the hashes (`k`) of the key values with more than about `min_rows` rows; None if there are none.

    `by` are columns that tell rows apart: the sample is drawn by their hash. Up to a bound of `EXPECTED` rows every row is in
    the sample and the count is exact. Two keys of one hash would only be cut needlessly.
    """
    share = min(1.0, EXPECTED / max(1, min_rows))
    drawn = df if share == 1 else df.filter(F.pmod(F.xxhash64(F.lit("sample"), *by), F.lit(_BUCKETS)) < int(share * _BUCKETS))
    counted = drawn.groupBy(_hash(keys).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    found = settle(counted.filter(F.col("n") > (min_rows if share == 1 else EXPECTED // 2 - 1)).select("k"))
    return None if found.isEmpty() else found


def marked(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Add `_hot`: whether the row's key is in the table of hot keys."""
    listed = hot.select(F.col("k").alias("_hot_key"))
    return df.join(listed, _hash(keys) == F.col("_hot_key"), "left").withColumn("_hot", F.col("_hot_key").isNotNull()).drop("_hot_key")


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    take: Sequence[str],
    at: str,
    hot: DataFrame | None = None,
    forward: bool = True,
    slot_seconds: int = SLOT_SECONDS,
) -> DataFrame:
    """Add `next_<c>` (or `prev_<c>`) for each taken column: lead/lag over `keys` ordered by `order`.

    `order` has to start with the timestamp `at`.
    """
    name, step = ("next", F.lead) if forward else ("prev", F.lag)
    whole = W.partitionBy(*keys).orderBy(*order)

    def neighbours(w) -> dict[str, Column]:
        return {f"{name}_{c}": step(c).over(w) for c in take}

    if hot is None:
        return df.withColumns(neighbours(whole))

    slot = F.when(F.col("_hot"), F.floor(epoch_seconds(F.col(at)) / slot_seconds)).otherwise(F.lit(0))
    inner = W.partitionBy(*keys, "_slot").orderBy(*order)
    cut = (
        marked(df, keys, hot)
        .withColumn("_slot", slot)
        .withColumns(
            {**neighbours(inner), "_after": F.lead(F.lit(1)).over(inner), "_before": F.lag(F.lit(1)).over(inner)}
        )
    )
    known = F.col("_after" if forward else "_before").isNotNull()
    edge = F.col("_after").isNull() | F.col("_before").isNull()
    extra = ["_hot", "_slot", "_after", "_before"]
    settled = cut.filter(~F.col("_hot") | known)
    # At most two rows per slot are left of a hot group, so this window stays small whatever the group's size.
    crossing = cut.filter(F.col("_hot") & edge).withColumns(neighbours(whole)).filter(~known)
    return settled.unionByName(crossing).drop(*extra)


def last_known(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    at: str,
    into: str,
    hot: DataFrame | None = None,
    slot_seconds: int = SLOT_SECONDS,
    hot_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add `into`: the latest non-null `value` at or before each row, per `keys` ordered by `order`.

    `hot` lists values of `hot_by`, by default of `keys`.
    """

    def running(w) -> Column:
        return F.last(value, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))

    if hot is None:
        return df.withColumn(into, running(W.partitionBy(*keys).orderBy(*order)))

    slot = F.when(F.col("_hot"), F.floor(epoch_seconds(F.col(at)) / slot_seconds)).otherwise(F.lit(0))
    inner = W.partitionBy(*keys, "_slot").orderBy(*order)
    cut = (
        marked(df, hot_by or keys, hot)
        .withColumn("_slot", slot)
        .withColumns({into: running(inner), "_after": F.lead(F.lit(1)).over(inner)})
    )
    # One row per slot of a hot group: what the slot ends with, carried to the later slots.
    across = W.partitionBy(*keys).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        cut.filter(F.col("_hot") & F.col("_after").isNull())
        .select(*keys, "_slot", F.last(into, ignorenulls=True).over(across).alias("_carried"))
        .select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_slot").alias("_c_slot"), "_carried")
    )
    same = F.col("_slot") == F.col("_c_slot")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    wanted = [*df.columns, into]
    filled = cut.filter("_hot").join(carried, same, "left").withColumn(into, F.coalesce(into, "_carried"))
    return cut.filter("NOT _hot").select(*wanted).unionByName(filled.select(*wanted))
