"""Watch time from the distance between successive events of a session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.functions.dates import epoch_seconds
from viewpulse.operators.skew import SLOT_SECONDS, with_neighbour
from viewpulse.schemas import FCT_PLAYBACK, VOD_TYPES

# Fixed values of the watch-time definition.
LAST_EVENT_SEC = 30
MAX_GAP_SEC = 300
STOP_TYPES = ["pause", "play_end", "error"]


def group_keys(across_days: bool = False) -> list[str]:
    return ["session_id", "content_id"] if across_days else ["event_date", "session_id", "content_id"]


def _seconds() -> Column:
    gap = epoch_seconds(F.col("next_server_ts")) - epoch_seconds(F.col("server_ts"))
    before_pause = F.coalesce(F.col("next_event_type") == "pause", F.lit(False))
    return (
        F.when(F.col("next_server_ts").isNull(), F.lit(LAST_EVENT_SEC))
        .when(F.col("event_type").isin(STOP_TYPES), F.lit(0))
        .when((gap > MAX_GAP_SEC) & ~before_pause, F.lit(MAX_GAP_SEC))
        .otherwise(gap)
        .cast("bigint")
    )


def watch_time(
    events: DataFrame, hot: DataFrame | None = None, across_days: bool = False, slot_seconds: int = SLOT_SECONDS
) -> DataFrame:
    """Add watch_time_sec: what each event is worth until the next one of its session and content.

    A session over midnight is cut at the date unless `across_days`. `hot` comes from `hot_keys` of `group_keys()`.
    """
    chained = with_neighbour(
        events,
        keys=group_keys(across_days),
        order=["server_ts", "event_id"],
        take=["server_ts", "event_type"],
        at="server_ts",
        hot=hot,
        slot_seconds=slot_seconds,
    )
    return chained.withColumn("watch_time_sec", _seconds()).drop("next_server_ts", "next_event_type")


def with_lengths(events: DataFrame, content: DataFrame) -> DataFrame:
    """Add _lengths: those of the event's title if it is on demand, one for each row of the catalogue; else null.

    No broadcast hint: the catalogue is broadcast when its measured size allows, otherwise Spark joins by shuffle and
    splits a hot title at run time.
    """
    timed = content.filter(F.col("content_type").isin(VOD_TYPES) & F.col("duration_sec").isNotNull())
    return events.join(timed.groupBy("content_id").agg(F.collect_list("duration_sec").alias("_lengths")), "content_id", "left")


def cap_vod(events: DataFrame, content: DataFrame | None = None) -> DataFrame:
    """Watch time of on-demand titles cannot exceed their length. Live and unknown titles are left alone.

    Without `content` the events bear their lengths already.
    """
    placed = events if content is None else with_lengths(events, content)
    capped = placed.withColumn("_length", F.explode_outer("_lengths"))
    return capped.withColumn("watch_time_sec", F.least("watch_time_sec", F.col("_length").cast("bigint"))).drop("_length", "_lengths")


def playback_facts(
    staged: DataFrame, content: DataFrame, hot: DataFrame | None = None, across_days: bool = False, spread: bool = True
) -> DataFrame:
    """Staging events to playback facts.

    Without `spread` no title may be hot (`hot_keys` of `content_id`): lengths are looked up before the window, and where a
    large catalogue is joined by shuffle, the events that lie by title for it need no other shuffle for the window and for what
    is folded by title behind it. Otherwise the join comes last, so that Spark can split a hot title.
    """
    if spread or hot is not None:
        return cap_vod(watch_time(staged, hot, across_days), content).select(*FCT_PLAYBACK.columns)
    return cap_vod(watch_time(with_lengths(staged, content), across_days=across_days)).select(*FCT_PLAYBACK.columns)
