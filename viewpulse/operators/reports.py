"""Reports over the weekly mart, and the freshness monitor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.functions.dates import clock
from viewpulse.functions.exact import ratio


def latest_week(mart: DataFrame) -> Column:
    """Newest week as a scalar subquery; on a stored mart it prunes the partitions to read."""
    return mart.agg(F.max("week_start_date")).scalar()


def week_before_latest(mart: DataFrame) -> Column:
    return mart.filter(F.col("week_start_date") < latest_week(mart)).agg(F.max("week_start_date")).scalar()


def _has_trend(*trends: str) -> Column:
    return F.max(F.col("engagement_trend").isin(list(trends)).cast("int"))


def _per_user(week: DataFrame) -> DataFrame:
    """Sums per user, so that distinct users and conditional distinct users become plain counts in the next step."""
    return week.groupBy("week_start_date", "segment", F.col("user_plan_at_week_start").alias("plan"), "user_id").agg(
        F.sum("total_watch_time_min").alias("watch"),
        F.count("total_watch_time_min").alias("watch_n"),
        F.sum("session_count").alias("sessions"),
        F.count("session_count").alias("sessions_n"),
        F.sum("avg_engagement_score").alias("score"),
        F.count("avg_engagement_score").alias("score_n"),
        F.sum("week_over_week_change_pct").alias("wow"),
        F.count("week_over_week_change_pct").alias("wow_n"),
        F.count(F.lit(1)).alias("rows"),
        _has_trend("Surging").alias("surging"),
        _has_trend("At Risk").alias("at_risk"),
        _has_trend("Surging", "Growing").alias("up"),
        _has_trend("Declining", "At Risk").alias("down"),
    )


def _mean(num: str, den: str, digits: int) -> Column:
    return ratio(F.sum(num), F.sum(den), digits).cast(f"decimal(18,{digits})")


def executive_summary(mart: DataFrame) -> DataFrame:
    """Newest week by segment and plan, with the score of the week before. A missing change counts as 0 here."""
    users = F.count("user_id")
    current = (
        _per_user(mart.filter(F.col("week_start_date") == latest_week(mart)))
        .groupBy("week_start_date", "segment", "plan")
        .agg(
            users.alias("total_users"),
            _mean("watch", "watch_n", 2).alias("avg_watch_time_min"),
            _mean("sessions", "sessions_n", 1).alias("avg_sessions"),
            _mean("score", "score_n", 1).alias("avg_engagement_score"),
            ratio(F.coalesce(F.sum("wow"), F.lit(0)), F.sum("rows"), 2).cast("decimal(18,2)").alias("avg_wow_change_pct"),
            F.sum("surging").alias("surging_users"),
            F.sum("at_risk").alias("at_risk_users"),
        )
    )
    before = (
        mart.filter(F.col("week_start_date") == week_before_latest(mart))
        .groupBy(F.col("segment").alias("_segment"), F.col("user_plan_at_week_start").alias("_plan"))
        .agg(
            ratio(F.sum("avg_engagement_score"), F.count("avg_engagement_score"), 1)
            .cast("decimal(18,1)")
            .alias("prev_avg_engagement_score")
        )
    )
    # Plain equality: a group without a plan has no counterpart.
    same = (F.col("segment") == F.col("_segment")) & (F.col("plan") == F.col("_plan"))
    delta = F.round(F.col("avg_engagement_score") - F.col("prev_avg_engagement_score"), 1)
    return (
        current.join(before, same, "left")
        .drop("_segment", "_plan")
        .withColumn("engagement_score_delta", delta)
        .orderBy(F.desc("avg_wow_change_pct"), "segment", "plan")
    )


def segment_velocity(mart: DataFrame) -> DataFrame:
    """Fastest changing segments of the newest week. Missing changes are left out of the mean."""
    users = F.count("user_id")
    return (
        _per_user(mart.filter(F.col("week_start_date") == latest_week(mart)))
        .groupBy("segment", "plan")
        .agg(
            users.alias("user_count"),
            _mean("watch", "watch_n", 2).alias("avg_watch_time"),
            _mean("wow", "wow_n", 2).alias("avg_wow_change"),
            ratio(F.sum("up") * 100, users, 1).cast("decimal(5,1)").alias("pct_growing"),
            ratio(F.sum("down") * 100, users, 1).cast("decimal(5,1)").alias("pct_declining"),
        )
        .orderBy(F.abs("avg_wow_change").desc(), "segment", "plan")
    )


def at_risk_users(mart: DataFrame, n: int = 100) -> DataFrame:
    """The n users of the newest week that lost most."""
    return (
        mart.filter((F.col("week_start_date") == latest_week(mart)) & (F.col("engagement_trend") == "At Risk"))
        .select(
            "user_id",
            F.col("user_plan_at_week_start").alias("plan"),
            "segment",
            "total_watch_time_min",
            "session_count",
            "days_active",
            "avg_engagement_score",
            "week_over_week_change_pct",
            "engagement_trend",
        )
        .orderBy("week_over_week_change_pct", "user_id")
        .limit(n)
    )


def freshness(events: DataFrame, now, flag_empty: bool = False) -> DataFrame:
    """Age of the newest event. An empty table reads HEALTHY unless `flag_empty`, then NO DATA."""
    newest = events.agg(F.max("event_ts").alias("latest_event_ts"), F.max("server_ts").alias("latest_server_ts"))
    delay = F.timestamp_diff("MINUTE", F.col("latest_server_ts"), F.col("current_time_utc"))
    late = F.col("delay_minutes")
    # Limits and messages of the monitor.
    status = F.when(late > 60, "CRITICAL: Data is older than 60 mins").when(late > 30, "WARNING: Data is older than 30 mins")
    if flag_empty:
        status = status.when(late.isNull(), "NO DATA")
    return (
        newest.withColumn("current_time_utc", clock(now))
        .withColumn("delay_minutes", delay)
        .withColumn("freshness_status", status.otherwise("HEALTHY"))
    )
