"""User history: change rows to validity intervals (slowly changing dimension, type 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from viewpulse.functions.dates import clock
from viewpulse.functions.keys import row_hash, surrogate_key
from viewpulse.operators.skew import with_neighbour
from viewpulse.schemas import DIM_USER, OPEN_END, RAW_USERS

_ATTRIBUTES = [c for c in RAW_USERS.columns if c != "last_updated_ts"]
_VERSION = [*_ATTRIBUTES, "row_hash", "valid_from"]


def versions(cdc: DataFrame) -> DataFrame:
    """CDC rows as candidate versions. Rows without a user or a time cannot be placed in a history."""
    return (
        cdc.filter(F.col("user_id").isNotNull() & F.col("last_updated_ts").isNotNull())
        .withColumn("row_hash", row_hash())
        .withColumn("valid_from", F.col("last_updated_ts"))
    )


def scd2_changes(dim: DataFrame, cdc: DataFrame) -> DataFrame:
    """CDC rows of users that are new or whose tracked attributes differ from the current version."""
    current = dim.filter("is_current").select(F.col("user_id").alias("_u"), F.col("row_hash").alias("_h"))
    candidates = versions(cdc)
    joined = candidates.join(current, F.col("user_id") == F.col("_u"), "left")
    changed = F.col("_u").isNull() | ~F.col("row_hash").eqNullSafe(F.col("_h"))
    return joined.filter(changed).select(*cdc.columns, "row_hash")


def scd2_apply(dim: DataFrame | None, cdc: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """The dimension after `cdc`; without `dim`, its first load.

    One plan over history and changes: rows are put in order of their update time, repeats of the same attributes are
    dropped, and each version ends where the next begins. Several changes per user in one batch, late changes and reruns
    all come out as if the rows had arrived one by one.
    """
    rows = versions(cdc).select(*_VERSION, F.lit(1).alias("_new"))
    if dim is not None:
        rows = dim.select(*_VERSION, F.lit(0).alias("_new")).unionByName(rows)

    # One version per user and instant; of two rows with the same time the incoming one counts.
    pick = W.partitionBy("user_id", "valid_from").orderBy(F.desc("_new"), F.desc("row_hash"), *_ATTRIBUTES)
    single = rows.withColumn("_pick", F.row_number().over(pick)).filter(F.col("_pick") == 1).drop("_pick", "_new")

    def beside(df: DataFrame, column: str, forward: bool) -> DataFrame:
        return with_neighbour(df, ["user_id"], ["valid_from"], [column], "valid_from", hot, forward)

    opened = beside(single, "row_hash", forward=False).filter(~F.col("row_hash").eqNullSafe(F.col("prev_row_hash")))
    closed = beside(opened.drop("prev_row_hash"), "valid_from", forward=True)
    return closed.select(
        surrogate_key(F.col("user_id"), F.col("valid_from")).alias("user_surr_key"),
        *_VERSION,
        F.coalesce("next_valid_from", clock(OPEN_END)).alias("valid_to"),
        F.col("next_valid_from").isNull().alias("is_current"),
    ).select(*DIM_USER.columns)
