"""Typing, late flag and deduplication of playback events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from viewpulse.functions.dates import clock

# Latest server time wins; the rest makes the choice total, so reruns pick the same copy.
COPY_ORDER = [
    "content_id", "event_type", "session_id", "device_id", "platform", "country_code", "position_sec", "user_id",
]


def late_flag() -> Column:
    """More than one calendar day between event and server date. Unknown times are not late."""
    lag = F.datediff(F.to_date("server_ts"), F.to_date("event_ts"))
    return F.coalesce(lag > 1, F.lit(False))


def type_events(raw: DataFrame, ingest_ts) -> DataFrame:
    return raw.withColumns(
        {
            "event_date": F.to_date("event_ts"),
            "is_late_arrival": late_flag(),
            "_ingest_ts": clock(ingest_ts),
        }
    )


def latest_copy(events: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per key, the one with the greatest server_ts.

    Spark plans `row_number() = 1` with a group limit on the map side, so an event repeated a billion times still sends one
    row per task into the shuffle.
    """
    ties = [F.asc(c) for c in COPY_ORDER if c in events.columns]
    order = [F.desc("server_ts"), F.desc("event_ts"), *ties]
    w = W.partitionBy(key).orderBy(*order)
    return events.withColumn("_copy", F.row_number().over(w)).filter(F.col("_copy") == 1).drop("_copy")


def dedup_events(raw: DataFrame, ingest_ts) -> DataFrame:
    """Raw events to staging rows. Typed after the choice, so that what follows from a row is not shuffled with it."""
    return type_events(latest_copy(raw), ingest_ts)


def type_sessions(raw: DataFrame, ingest_ts) -> DataFrame:
    """App sessions arrive clean: add the date and the load time."""
    return raw.withColumns({"session_date": F.to_date("session_start_ts"), "_ingest_ts": clock(ingest_ts)})
