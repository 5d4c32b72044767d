"""Session facts, and sessions inferred from inactivity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from viewpulse.functions.dates import epoch_seconds
from viewpulse.schemas import FCT_SESSIONS

GAP_SECONDS = 30 * 60


def session_titles(playback: DataFrame) -> DataFrame:
    """Playback facts folded to one row per session, user, device, platform, date and title.

    Facts that come from the watch-time window lie by session and title already and are folded without a shuffle.
    """
    return playback.groupBy("session_id", "user_id", "device_id", "platform", "event_date", "content_id").agg(
        F.min("server_ts").alias("first_ts"),
        F.max("server_ts").alias("last_ts"),
        F.sum("watch_time_sec").alias("watch_time_sec"),
        F.count("event_id").alias("events"),
    )


def session_facts(playback: DataFrame, is_folded: bool = False) -> DataFrame:
    """One row per session, user, device, platform and date. Anonymous sessions are kept.

    Facts that are folded by title already (`is_folded`) are not folded again.
    """
    titles = playback if is_folded else session_titles(playback)
    return (
        titles.groupBy("session_id", "user_id", "device_id", "platform", F.col("event_date").alias("session_date"))
        .agg(
            F.min("first_ts").alias("session_start_ts"),
            F.max("last_ts").alias("session_end_ts"),
            F.sum("watch_time_sec").alias("total_watch_time_sec"),
            F.count("content_id").alias("distinct_content_count"),
            F.sum("events").alias("event_count"),
        )
        .select(*FCT_SESSIONS.columns)
    )


def gap_sessions(events: DataFrame, keys: Sequence[str], ts: str, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Sessions closed by `gap_seconds` without an event.

    Two events in the same slot of that width can never be a gap apart, so events are first folded to one row per key and
    slot. The window then sees a number of rows bounded by the time span, not by how busy the key is.
    """
    slots = (
        events.filter(F.col(ts).isNotNull())
        .groupBy(*keys, F.floor(epoch_seconds(F.col(ts)) / gap_seconds).alias("_slot"))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n"))
    )
    w = W.partitionBy(*keys).orderBy("_slot")
    limit = F.lag("_last").over(w) + F.make_dt_interval(secs=F.lit(gap_seconds))
    starts = F.coalesce((F.col("_first") >= limit).cast("int"), F.lit(1))
    numbered = slots.withColumn("_start", starts).withColumn("_no", F.sum("_start").over(w))
    return (
        numbered.groupBy(*keys, "_no")
        .agg(
            F.min("_first").alias("session_start_ts"),
            F.max("_last").alias("session_end_ts"),
            F.sum("_n").alias("event_count"),
        )
        .drop("_no")
    )
