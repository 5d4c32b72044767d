"""Schemas and physical layout of every table.

Timestamps are TIMESTAMP_NTZ. Sums and minutes are wider than the INT / DECIMAL(10,2) a single well-behaved user needs:
ANSI mode raises on overflow, and one bot account must not be able to fail the whole run.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql.types import StructType

# Column names and domains of the data model.
EVENT_TYPES = ["play_start", "heartbeat", "pause", "seek", "play_end", "error"]
PLATFORMS = ["ios", "android", "web", "tv", "firetv"]
VOD_TYPES = ["vod_movie", "vod_series_ep", "highlight"]
PLANS = ["free", "basic", "premium", "trial"]
OPEN_END = "9999-12-31 00:00:00"

_EVENT = """event_id string, user_id string, device_id string, session_id string, content_id string, event_type string,
    event_ts timestamp_ntz, server_ts timestamp_ntz, position_sec int, platform string, country_code string"""
_USER = """user_id string, signup_ts timestamp_ntz, signup_source string, country_code string, current_plan string,
    plan_started_ts timestamp_ntz, status string"""
_CONTENT = """content_id string, title string, content_type string, genre string, language string, duration_sec int,
    is_premium boolean, publish_ts timestamp_ntz"""
_APP_SESSION = """session_id string, user_id string, device_id string, session_start_ts timestamp_ntz,
    session_end_ts timestamp_ntz, platform string"""


@dataclass(frozen=True)
class Table:
    """A stored table: where it lies under the lake root, how it is cut, what identifies a row."""

    path: str
    ddl: str
    keys: tuple[str, ...] = ()
    partition: str | None = None
    cluster: tuple[str, ...] = ()
    format: str = "parquet"

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return [c.split()[0] for c in re.split(r",\s*(?![^()]*\))", self.ddl)]


RAW_EVENTS = Table("raw/playback_events", f"{_EVENT}, event_date date", partition="event_date", format="json")
RAW_USERS = Table("raw/users", f"{_USER}, last_updated_ts timestamp_ntz")
RAW_CONTENT = Table("raw/content", _CONTENT)
RAW_SESSIONS = Table("raw/app_sessions", f"{_APP_SESSION}, session_date date", partition="session_date")

STG_EVENTS = Table(
    "staging/stg_playback_events",
    f"{_EVENT}, event_date date, is_late_arrival boolean, _ingest_ts timestamp_ntz",
    keys=("event_id",),
    partition="event_date",
)
STG_SESSIONS = Table(
    "staging/stg_sessions",
    f"{_APP_SESSION}, session_date date, _ingest_ts timestamp_ntz",
    keys=("session_id",),
    partition="session_date",
)

# What a night has changed, kept under its date: groups of events, user-days, and dates whose scores moved.
TOUCHED_SESSIONS = Table(
    "staging/touched_sessions", "event_date date, session_id string, night date", keys=("event_date", "session_id", "night"), partition="night"
)
TOUCHED_DAYS = Table(
    "staging/touched_days", "activity_date date, user_id string, night date", keys=("activity_date", "user_id", "night"), partition="night"
)
RESCORED_DAYS = Table("staging/rescored_days", "activity_date date, night date", keys=("activity_date", "night"), partition="night")

TOUCHED_PLANS = Table(
    "staging/touched_plans", "user_id string, old_plan string, new_plan string, night date", keys=("user_id", "night"), partition="night"
)

DIM_USER = Table(
    "curated/dim_user",
    f"user_surr_key string, {_USER}, row_hash string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean",
    keys=("user_id", "valid_from"),
)
DIM_CONTENT = Table("curated/dim_content", f"{_CONTENT}, _loaded_at timestamp_ntz", keys=("content_id",))
DIM_DATE = Table(
    "curated/dim_date",
    """date_key int, full_date date, day_of_week int, week_of_year int, month_num int, year_num int,
    is_weekend boolean, is_holiday boolean""",
    keys=("date_key",),
)

FCT_PLAYBACK = Table(
    "curated/fct_playback_events",
    f"{_EVENT}, event_date date, is_late_arrival boolean, watch_time_sec bigint",
    keys=("event_id",),
    partition="event_date",
    cluster=("user_id", "content_id"),
)
FCT_SESSIONS = Table(
    "curated/fct_sessions",
    f"""{_APP_SESSION}, total_watch_time_sec bigint, distinct_content_count bigint, event_count bigint,
    session_date date""",
    keys=("session_id", "user_id", "device_id", "platform", "session_date"),
    partition="session_date",
    cluster=("user_id",),
)
FCT_DAILY = Table(
    "curated/fct_user_engagement_daily",
    """user_id string, date_key int, activity_date date, total_watch_time_min decimal(18,2), session_count bigint,
    distinct_content_count bigint, distinct_genre_count bigint, distinct_type_count bigint,
    avg_session_duration_min decimal(18,2), engagement_score int, primary_platform string""",
    keys=("user_id", "activity_date"),
    partition="activity_date",
    cluster=("user_id",),
)
# User-days by day, plan and measures: what scores are ranked in. Rows of a day add up; later nights add what plan changes move.
SCORE_CELLS = Table(
    "curated/score_cells",
    """activity_date date, night date, plan_segment string, total_watch_time_min decimal(18,2), session_count bigint,
    distinct_genre_count bigint, n bigint""",
    keys=("activity_date", "night", "plan_segment", "total_watch_time_min", "session_count", "distinct_genre_count"),
    partition="activity_date",
)
MART_WEEKLY = Table(
    "marts/mart_user_engagement_weekly",
    """user_id string, week_start_date date, week_end_date date, user_plan_at_week_start string,
    user_status_at_week_start string, total_watch_time_min decimal(18,2), session_count bigint,
    distinct_content_count bigint, distinct_genre_count bigint, days_active int, avg_engagement_score decimal(5,2),
    week_over_week_change_pct decimal(18,2), engagement_trend string, segment string""",
    keys=("user_id", "week_start_date"),
    partition="week_start_date",
    cluster=("segment", "user_plan_at_week_start"),
)
MART_PLAN_PLATFORM = Table(
    "marts/mart_weekly_engagement",
    """week_start_date date, current_plan string, platform string, active_users bigint, total_watch_time_sec bigint,
    total_watch_time_minutes double, avg_engagement_score double, prev_week_watch_time double,
    wow_watch_time_growth_pct decimal(18,2)""",
    keys=("week_start_date", "current_plan", "platform"),
    partition="week_start_date",
)

ALL_TABLES = [
    RAW_EVENTS, RAW_USERS, RAW_CONTENT, RAW_SESSIONS, STG_EVENTS, STG_SESSIONS, TOUCHED_SESSIONS, TOUCHED_DAYS,
    RESCORED_DAYS, TOUCHED_PLANS, DIM_USER, DIM_CONTENT, DIM_DATE,
    FCT_PLAYBACK, FCT_SESSIONS, FCT_DAILY, SCORE_CELLS, MART_WEEKLY, MART_PLAN_PLATFORM,
]

LIVE_EVENTS = Table(
    "live/events",
    """event_id string, user_id string, content_id string, event_type string, event_ts timestamp_ntz,
    server_ts timestamp_ntz, platform string, event_date date""",
    keys=("event_id",),
    partition="event_date",
)

# The live feed carries seven of the event columns; event time needs an instant type for watermarks.
LIVE_EVENT_DDL = """event_id string, user_id string, content_id string, event_type string, event_ts timestamp,
    server_ts timestamp, platform string"""
