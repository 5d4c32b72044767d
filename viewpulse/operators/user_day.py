"""User-day facts: watch time, frequency, breadth and main platform."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse.functions.dates import date_key
from viewpulse.functions.exact import minutes
from viewpulse.schemas import FCT_DAILY

DAY = ["user_id", "activity_date"]


def titles(playback: DataFrame) -> DataFrame:
    """Titles per user and date, without anonymous events. Folds a user with billions of events to the titles seen."""
    known = playback.filter(F.col("user_id").isNotNull())
    return known.select("user_id", F.col("event_date").alias("activity_date"), "content_id").distinct()


def primary_platform(sessions: DataFrame) -> DataFrame:
    """Platform with most events per user-day; on a tie the first in alphabetical order."""
    per_platform = (
        sessions.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", F.col("session_date").alias("activity_date"), "platform")
        .agg(F.sum("event_count").alias("events"))
    )
    rank = F.struct(-F.col("events"), F.col("platform"))
    return per_platform.groupBy(*DAY).agg(F.min_by("platform", rank).alias("primary_platform"))


def breadth(playback: DataFrame, content: DataFrame) -> DataFrame:
    """Distinct titles, genres and content types per user-day. A user-day's labels are gathered as sets, as they are few and two
    distinct counts in one pass would repeat and shuffle its rows three times over."""
    labels = content.select("content_id", "genre", "content_type")
    return (
        titles(playback)
        .join(labels, "content_id", "left")
        .groupBy(*DAY)
        .agg(
            F.count("content_id").alias("distinct_content_count"),
            F.size(F.collect_set("genre")).cast("bigint").alias("distinct_genre_count"),
            F.size(F.collect_set("content_type")).cast("bigint").alias("distinct_type_count"),
        )
    )


def session_totals(sessions: DataFrame) -> DataFrame:
    return (
        sessions.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", F.col("session_date").alias("activity_date"))
        .agg(
            F.sum("total_watch_time_sec").alias("total_watch_time_sec"),
            F.count("session_id").alias("session_count"),
            F.count_distinct("session_id").alias("distinct_session_count"),
        )
    )


def user_day(sessions: DataFrame, playback: DataFrame, content: DataFrame) -> DataFrame:
    """Daily facts with an empty score; the three parts meet on one hash partitioning by user and date."""
    total = F.col("total_watch_time_sec")
    return (
        session_totals(sessions)
        .join(breadth(playback, content), DAY, "left")
        .join(primary_platform(sessions), DAY, "left")
        .withColumns(
            {
                "date_key": date_key(F.col("activity_date")),
                "total_watch_time_min": minutes(total),
                "avg_session_duration_min": minutes(total, F.col("distinct_session_count")),
                "engagement_score": F.lit(None).cast("int"),
            }
        )
        .select(*FCT_DAILY.columns)
    )


def user_day_platform(sessions: DataFrame) -> DataFrame:
    """Watch seconds per user, date and platform."""
    return (
        sessions.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", F.col("session_date").alias("activity_date"), "platform")
        .agg(F.sum("total_watch_time_sec").alias("total_watch_time_sec"))
    )
