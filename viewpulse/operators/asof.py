"""Lookups of what was valid at a given time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.functions.dates import week_start
from viewpulse.operators.skew import SLOT_SECONDS, last_known

#: Parts that rows without a user are dealt into.
NULL_FAN_OUT = 4096


def attach_at_date(df: DataFrame, dim: DataFrame, date: str, columns: Sequence[str], hot: DataFrame | None = None) -> DataFrame:
    """User attributes valid at the start of `date`. Rows without a user or a date are kept with nulls."""
    return attach_at_event(df.withColumn("_at", F.col(date).cast("timestamp_ntz")), dim, columns, "_at", hot).drop("_at")


def attach_at_event(
    events: DataFrame,
    dim: DataFrame,
    columns: Sequence[str],
    at: str = "server_ts",
    hot: DataFrame | None = None,
    slot_seconds: int = SLOT_SECONDS,
) -> DataFrame:
    """User attributes valid when each event happened. Anonymous events are kept with nulls.

    Versions and events of a user are put into one order of time and each event takes the last version before it, so a user
    with many of both makes no pairs. Anonymous events are dealt out by their time, as no version concerns them. `hot` comes
    from `hot_keys` of `user_id`.
    """
    apart = F.when(F.col("user_id").isNull(), F.pmod(F.xxhash64(at), F.lit(NULL_FAN_OUT))).otherwise(F.lit(0))
    version = F.struct(F.col("valid_to").alias("until"), *columns).alias("_version")
    starts = dim.select("user_id", F.col("valid_from").alias(at), F.lit(0).cast("bigint").alias("_apart"), F.lit(0).alias("_kind"), version)
    rows = events.withColumns({"_apart": apart, "_kind": F.lit(1)})
    ordered = last_known(
        starts.unionByName(rows, allowMissingColumns=True), ["user_id", "_apart"], [at, "_kind"], "_version", at, "_valid", hot, slot_seconds, ["user_id"]
    )
    holds = F.col("_valid.until") > F.col(at)
    placed = ordered.filter("_kind = 1").withColumns({c: F.when(holds, F.col(f"_valid.{c}")) for c in columns})
    return placed.select(*events.columns, *columns)


def watch_time_by_plan(playback: DataFrame, dim: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Watch time per user, week and the plan at viewing time: an upgrade in mid-week splits the week."""
    known = playback.filter(F.col("user_id").isNotNull())
    with_plan = attach_at_event(known, dim, ["current_plan"], hot=hot)
    return with_plan.groupBy(
        "user_id", week_start(F.col("event_date")).alias("week_start_date"), F.coalesce("current_plan", F.lit("unknown")).alias("plan")
    ).agg(F.sum("watch_time_sec").alias("total_watch_time_sec"), F.count("event_id").alias("event_count"))


def link_devices(events: DataFrame, hot: DataFrame | None = None, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """Add linked_user_id: the event's own user, else the last user seen on its device up to then.

    `hot` comes from `hot_keys` of `device_id`.
    """
    linked = last_known(
        events, ["device_id"], ["server_ts", "event_id"], "user_id", "server_ts", "_linked", hot, slot_seconds
    )
    own = F.when(F.col("device_id").isNull(), F.col("user_id")).otherwise(F.col("_linked"))
    return linked.withColumn("linked_user_id", own).drop("_linked")
