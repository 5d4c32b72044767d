"""The registered queries once more as DuckDB SQL over the given tables.

Written independently of the operators: plain windows, integer arithmetic for every rounding (cents instead of DECIMAL), and
direct percent_rank. Steps are named here once and put in front of a query as CTEs when it needs them.
"""

from __future__ import annotations

import re

from viewpulse.plans.queries import CDC_SINCE, FRESH_NOW, INGEST, LAST_DAY, LIVE_BEFORE, LOOKBACK_DATE, SECOND_LOAD
from viewpulse.schemas import FCT_SESSIONS, OPEN_END, PLANS, VOD_TYPES
from viewpulse.sources import derived


def half_up(num: str, den: str, digits: int) -> str:
    """num / den rounded half up, as an integer count of 10^-digits."""
    scale = 10**digits
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (
        f"(CASE WHEN {d} <> 0 THEN CAST((CASE WHEN {n} < 0 THEN -1 ELSE 1 END)"
        f" * ((2 * abs({n}) * {scale} + {d}) // (2 * {d})) AS BIGINT) END)"
    )


def number(cents: str, digits: int = 2) -> str:
    return f"(CAST({cents} AS DOUBLE) / {10**digits})"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


COPIES = """server_ts DESC, event_ts DESC, content_id, event_type, session_id, device_id, platform, country_code, position_sec,
 user_id"""
RAW = """event_id, user_id, device_id, session_id, content_id, event_type, event_ts, server_ts,
 CAST(position_sec AS BIGINT) AS position_sec, platform, country_code"""
USER = "user_id, signup_ts, signup_source, country_code, current_plan, plan_started_ts, status"
SESSION = """session_id, user_id, device_id, session_start_ts, session_end_ts, platform, CAST(total_watch_time_sec AS BIGINT)
 AS total_watch_time_sec, distinct_content_count, event_count, session_date"""


def _watch(keys: str) -> str:
    return f"""
SELECT * EXCLUDE (nts, nty, gap), CAST(CASE WHEN nts IS NULL THEN 30 WHEN event_type IN ('pause', 'play_end', 'error') THEN 0
  WHEN gap > 300 THEN CASE WHEN nty = 'pause' THEN gap ELSE 300 END ELSE gap END AS BIGINT) AS watch_time_sec
FROM (SELECT *, date_diff('second', server_ts, nts) AS gap FROM (
  SELECT *, lead(server_ts) OVER w AS nts, lead(event_type) OVER w AS nty FROM staged
  WINDOW w AS (PARTITION BY {keys} ORDER BY server_ts, event_id)))"""


def _gaps(source: str, key: str, ts: str) -> str:
    return f"""
SELECT {key}, min({ts}) AS session_start_ts, max({ts}) AS session_end_ts, count(*) AS event_count
FROM (SELECT *, sum(brk) OVER (PARTITION BY {key} ORDER BY {ts} ROWS UNBOUNDED PRECEDING) AS no FROM (
  SELECT {key}, {ts}, CASE WHEN {ts} < lag({ts}) OVER (PARTITION BY {key} ORDER BY {ts}) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END
    AS brk FROM {source}))
GROUP BY {key}, no"""


def _history(source: str) -> str:
    return f"""
SELECT sha256(user_id || CAST(valid_from AS VARCHAR)) AS user_surr_key, {USER}, row_hash, valid_from,
 coalesce(lead(valid_from) OVER w, TIMESTAMP '{OPEN_END}') AS valid_to, lead(valid_from) OVER w IS NULL AS is_current
FROM (SELECT * FROM (SELECT *, lag(row_hash) OVER (PARTITION BY user_id ORDER BY valid_from) AS before FROM {source})
  WHERE before IS NULL OR before <> row_hash)
WINDOW w AS (PARTITION BY user_id ORDER BY valid_from)"""


def _weekly(rows: str) -> str:
    """`rows` has one row per user-day with minutes in cents and a weekday flag that is null for absent users."""
    return f"""
SELECT user_id, week_start_date, week_start_date + 6 AS week_end_date, min_c, prev_c, session_count, distinct_content_count,
 distinct_genre_count, days_active, score_c, CASE WHEN prev_c IS NULL THEN NULL WHEN prev_c = 0 THEN 99999999
  ELSE {half_up("(min_c - prev_c) * 100", "prev_c", 2)} END AS wow_c
FROM (SELECT *, CASE WHEN lag(week_start_date) OVER w = week_start_date - 7 THEN lag(min_c) OVER w END AS prev_c FROM (
  SELECT user_id, CAST(date_trunc('week', activity_date) AS DATE) AS week_start_date, sum(min_c) AS min_c,
   sum(session_count) AS session_count, max(distinct_content_count) AS distinct_content_count,
   max(distinct_genre_count) AS distinct_genre_count, count(DISTINCT active_day) AS days_active,
   {half_up("sum(engagement_score)", "count(engagement_score)", 2)} AS score_c
  FROM {rows} GROUP BY 1, 2) WINDOW w AS (PARTITION BY user_id ORDER BY week_start_date))"""


def _labelled(source: str) -> str:
    return f"""
SELECT m.*, CASE WHEN prev_c = 0 THEN 'Activated' WHEN wow_c > 2000 THEN 'Surging' WHEN wow_c > 500 THEN 'Growing'
  WHEN wow_c < -2000 THEN 'At Risk' WHEN wow_c < -500 THEN 'Declining' ELSE 'Stable' END AS engagement_trend,
 CASE WHEN days_active >= 5 THEN 'Power User' WHEN days_active >= 3 THEN 'Regular' WHEN days_active >= 1 THEN 'Casual'
  ELSE 'Dormant' END AS segment, d.current_plan AS plan, d.status
FROM {source} m LEFT JOIN dim d ON m.user_id = d.user_id AND d.valid_from <= m.week_start_date AND m.week_start_date < d.valid_to"""


def _mart_rows(source: str) -> str:
    return f"""
SELECT user_id, week_start_date, week_end_date, plan AS user_plan_at_week_start, status AS user_status_at_week_start,
 {number("min_c")} AS total_watch_time_min, CAST(session_count AS BIGINT) AS session_count,
 CAST(distinct_content_count AS BIGINT) AS distinct_content_count, CAST(distinct_genre_count AS BIGINT) AS distinct_genre_count,
 days_active, {number("score_c")} AS avg_engagement_score, {number("wow_c")} AS week_over_week_change_pct, engagement_trend,
 segment FROM {source}"""


def _scored(days: str, group: str) -> str:
    rank = "percent_rank() OVER (PARTITION BY {g} ORDER BY {m} NULLS FIRST)"
    parts = [(rank.format(g=group, m=m), w) for m, w in [("min_c", 50), ("session_count", 30), ("distinct_genre_count", 20)]]
    total = " + ".join(f"({r} * {w})" for r, w in parts)
    return f"SELECT *, CAST(round({total}, 0) AS BIGINT) AS engagement_score FROM {days}"


def _viewers(source: str) -> str:
    return f"""
SELECT platform, date_trunc('minute', server_ts) AS minute, count(DISTINCT user_id) AS concurrent_viewers FROM {source}
WHERE event_type IN ('play_start', 'heartbeat') AND user_id IS NOT NULL GROUP BY 1, 2"""


def _checks(source: str, rules: list[tuple[str, str, float]]) -> str:
    lines = [
        f"""SELECT '{name}' AS name, count(*) FILTER (WHERE {bad}) AS actual, CAST(count(*) AS DOUBLE) * CAST({tol} AS DOUBLE)
 AS threshold, count(*) FILTER (WHERE {bad}) <= CAST(count(*) AS DOUBLE) * CAST({tol} AS DOUBLE) AS passed FROM {source}"""
        for name, bad, tol in rules
    ]
    return " UNION ALL ".join(lines)


_HASHED = ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), chr(0))"
    for c in ["signup_source", "country_code", "current_plan", "plan_started_ts", "status"]
)

STEPS: dict[str, str] = {
    "playback_events": derived.duckdb_text(derived.PLAYBACK),
    "content": derived.duckdb_text(derived.CONTENT),
    "users_cdc": derived.duckdb_text(derived.USERS_CDC),
    "app_sessions": derived.duckdb_text(derived.APP_SESSIONS),
    "typed": f"""
SELECT *, CAST(event_ts AS DATE) AS event_date,
 coalesce(date_diff('day', CAST(event_ts AS DATE), CAST(server_ts AS DATE)) > 1, false) AS is_late_arrival,
 TIMESTAMP '{INGEST}' AS _ingest_ts FROM playback_events""",
    "staged": f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {COPIES}) AS rn FROM typed) WHERE rn = 1""",
    "watched": _watch("event_date, session_id, content_id"),
    "watched_across": _watch("session_id, content_id"),
    "facts": f"""
SELECT w.* EXCLUDE (watch_time_sec), CASE WHEN c.content_type IN {_in(VOD_TYPES)} AND c.duration_sec < w.watch_time_sec
  THEN CAST(c.duration_sec AS BIGINT) ELSE w.watch_time_sec END AS watch_time_sec
FROM watched w LEFT JOIN content c ON w.content_id = c.content_id""",
    "session_rows": """
SELECT session_id, user_id, device_id, platform, event_date AS session_date, min(server_ts) AS session_start_ts,
 max(server_ts) AS session_end_ts, sum(watch_time_sec) AS total_watch_time_sec, count(DISTINCT content_id)
 AS distinct_content_count, count(event_id) AS event_count FROM facts GROUP BY ALL""",
    "main_platform": """
SELECT user_id, activity_date, platform AS primary_platform FROM (
 SELECT user_id, event_date AS activity_date, platform,
  row_number() OVER (PARTITION BY user_id, event_date ORDER BY count(*) DESC, platform) AS rn
 FROM staged WHERE user_id IS NOT NULL GROUP BY user_id, event_date, platform) WHERE rn = 1""",
    "breadths": """
SELECT s.user_id, s.event_date AS activity_date, count(DISTINCT s.content_id) AS distinct_content_count,
 count(DISTINCT c.genre) AS distinct_genre_count, count(DISTINCT c.content_type) AS distinct_type_count
FROM staged s LEFT JOIN content c ON s.content_id = c.content_id WHERE s.user_id IS NOT NULL GROUP BY 1, 2""",
    "days": f"""
SELECT t.*, b.* EXCLUDE (user_id, activity_date), p.primary_platform,
 CAST(strftime(t.activity_date, '%Y%m%d') AS BIGINT) AS date_key, t.activity_date AS active_day,
 {half_up("sec", "60", 2)} AS min_c, {half_up("sec", "60 * ids", 2)} AS avg_c
FROM (SELECT user_id, session_date AS activity_date, sum(total_watch_time_sec) AS sec, count(session_id) AS session_count,
  count(DISTINCT session_id) AS ids FROM session_rows WHERE user_id IS NOT NULL GROUP BY 1, 2) t
LEFT JOIN breadths b ON b.user_id = t.user_id AND b.activity_date = t.activity_date
LEFT JOIN main_platform p ON p.user_id = t.user_id AND p.activity_date = t.activity_date""",
    "versions": f"SELECT *, md5(concat_ws('||', {_HASHED})) AS row_hash, last_updated_ts AS valid_from FROM users_cdc",
    "dim": _history("versions"),
    "early_versions": f"SELECT * FROM versions WHERE last_updated_ts < TIMESTAMP '{CDC_SINCE}'",
    "early_dim": _history("early_versions"),
    "planned": """
SELECT d.*, coalesce(u.current_plan, 'unknown') AS plan_segment FROM days d
LEFT JOIN (SELECT user_id, current_plan FROM dim WHERE is_current) u ON d.user_id = u.user_id""",
    "window_days": f"SELECT * FROM planned WHERE activity_date > (SELECT max(activity_date) FROM days) - 28",
    "window_scores": _scored("window_days", "plan_segment"),
    "runs": "SELECT CAST(unnest(generate_series(min(activity_date), max(activity_date), INTERVAL 1 DAY)) AS DATE) AS as_of FROM planned",
    "run_days": "SELECT r.as_of, p.* FROM planned p JOIN runs r ON p.activity_date BETWEEN r.as_of - 27 AND r.as_of",
    "run_scores": _scored("run_days", "as_of, plan_segment"),
    "scored_days": "SELECT * FROM run_scores WHERE as_of = least(activity_date + 27, (SELECT max(activity_date) FROM planned))",
    "weekly": _weekly("scored_days"),
    "mart": _labelled("weekly"),
    "span_weeks": """
SELECT CAST(unnest(generate_series(CAST(date_trunc('week', min(activity_date)) AS DATE) - 7, CAST(date_trunc('week', max(activity_date)) AS DATE),
 INTERVAL 7 DAY)) AS DATE) AS ws FROM scored_days""",
    "with_absent": """
SELECT user_id, activity_date, min_c, session_count, distinct_content_count, distinct_genre_count, engagement_score, active_day
FROM scored_days
UNION ALL SELECT d.user_id, w.ws, 0, 0, 0, 0, NULL, NULL FROM dim d JOIN span_weeks w ON d.valid_from <= w.ws AND w.ws < d.valid_to""",
    "weekly_absent": _weekly("with_absent"),
    "mart_absent": _labelled("weekly_absent"),
    "platform_days": """
SELECT s.user_id, s.session_date AS activity_date, s.platform, sum(s.total_watch_time_sec) AS sec
FROM session_rows s WHERE s.user_id IS NOT NULL GROUP BY 1, 2, 3""",
    "plan_platform": """
SELECT CAST(date_trunc('week', p.activity_date) AS DATE) AS week_start_date, d.current_plan, p.platform,
 count(DISTINCT d.user_surr_key) AS active_users, CAST(sum(p.sec) AS BIGINT) AS sec,
 sum(s.engagement_score) / nullif(count(s.engagement_score), 0) AS avg_engagement_score
FROM platform_days p JOIN dim d ON p.user_id = d.user_id AND d.valid_from <= p.activity_date AND p.activity_date < d.valid_to
LEFT JOIN scored_days s ON s.user_id = p.user_id AND s.activity_date = p.activity_date GROUP BY 1, 2, 3""",
    "plan_platform_growth": f"""
SELECT week_start_date, current_plan, platform, active_users, sec AS total_watch_time_sec,
 sec / 60.0 AS total_watch_time_minutes, CAST(avg_engagement_score AS DOUBLE) AS avg_engagement_score,
 lag(sec) OVER w / 60.0 AS prev_week_watch_time,
 {number(half_up("(sec - lag(sec) OVER w) * 100", "lag(sec) OVER w", 2))} AS wow_watch_time_growth_pct
FROM plan_platform WINDOW w AS (PARTITION BY current_plan, platform ORDER BY week_start_date)""",
    "newest": "SELECT * FROM mart WHERE week_start_date = (SELECT max(week_start_date) FROM mart)",
    "newest_but_one": """
SELECT * FROM mart WHERE week_start_date = (SELECT max(week_start_date) FROM mart
  WHERE week_start_date < (SELECT max(week_start_date) FROM mart))""",
    "first_load": f"SELECT * FROM playback_events WHERE server_ts < TIMESTAMP '{SECOND_LOAD}'",
    "second_load": f"SELECT * FROM playback_events WHERE server_ts >= TIMESTAMP '{SECOND_LOAD}'",
    "live_rows": f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {COPIES}) AS rn
 FROM (SELECT t.* FROM typed t, (SELECT max(server_ts) AS at FROM typed
     WHERE server_ts < TIMESTAMP '{LIVE_BEFORE}' AND event_type IN ('play_start', 'heartbeat') AND user_id IS NOT NULL) n
   WHERE t.server_ts > n.at - INTERVAL 5 MINUTE AND t.server_ts <= n.at)) WHERE rn = 1""",
}

_STAGED = f"SELECT {RAW}, event_date, is_late_arrival, _ingest_ts FROM staged"
_SESSIONS = f"SELECT {SESSION} FROM session_rows"
_DIM = f"SELECT user_surr_key, {USER}, row_hash, valid_from, CAST(valid_to AS VARCHAR) AS valid_to, is_current FROM dim"
_DAY = """user_id, date_key, activity_date, CAST(min_c AS DOUBLE) / 100 AS total_watch_time_min, session_count,
 distinct_content_count, distinct_genre_count, distinct_type_count, CAST(avg_c AS DOUBLE) / 100 AS avg_session_duration_min"""
_VALID = "d.valid_from <= s.server_ts AND s.server_ts < d.valid_to"

QUERIES: dict[str, str] = {
    "dedup_events": _STAGED,
    "late_flag": "SELECT event_date, is_late_arrival, count(*) AS events FROM typed GROUP BY 1, 2",
    "app_sessions": f"""
SELECT *, CAST(session_start_ts AS DATE) AS session_date, TIMESTAMP '{INGEST}' AS _ingest_ts FROM app_sessions""",
    "raw_json_scan": f"SELECT {RAW}, event_date FROM typed WHERE event_date BETWEEN DATE '{LOOKBACK_DATE}' AND DATE '{LAST_DAY}'",
    "lookback_scan": f"{_STAGED} WHERE event_date BETWEEN DATE '{LOOKBACK_DATE}' - 2 AND DATE '{LOOKBACK_DATE}'",
    "watch_time": "SELECT event_id, session_id, content_id, event_date, server_ts, event_type, watch_time_sec FROM watched",
    "watch_time_across_days": "SELECT event_id, session_id, content_id, event_date, watch_time_sec FROM watched_across",
    "vod_cap": f"SELECT {RAW}, event_date, is_late_arrival, watch_time_sec FROM facts",
    "session_facts": _SESSIONS,
    "session_gap_30m": _gaps("events", "user_id", "ts"),
    "inferred_sessions": _gaps("staged", "device_id", "server_ts"),
    "scd2_history": _DIM,
    "scd2_incremental": _DIM,
    "scd2_changes": f"""
SELECT v.user_id, v.signup_ts, v.signup_source, v.country_code, v.current_plan, v.plan_started_ts, v.status, v.last_updated_ts,
 v.row_hash FROM versions v LEFT JOIN (SELECT * FROM early_dim WHERE is_current) d ON v.user_id = d.user_id
WHERE v.last_updated_ts >= TIMESTAMP '{CDC_SINCE}' AND (d.user_id IS NULL OR d.row_hash IS DISTINCT FROM v.row_hash)""",
    "row_hash": "SELECT user_id, last_updated_ts, row_hash FROM versions",
    "surrogate_key": """
SELECT user_id, last_updated_ts AS valid_from, sha256(user_id || CAST(last_updated_ts AS VARCHAR)) AS user_surr_key FROM users_cdc""",
    "asof_plan_week": """
SELECT w.user_id, w.week_start_date, d.current_plan, d.status FROM (SELECT DISTINCT user_id, CAST(date_trunc('week', event_date)
 AS DATE) AS week_start_date FROM typed WHERE user_id IS NOT NULL) w LEFT JOIN dim d ON w.user_id = d.user_id
 AND d.valid_from <= w.week_start_date AND w.week_start_date < d.valid_to""",
    "asof_plan_event": f"""
SELECT s.event_id, s.user_id, s.server_ts, d.current_plan, d.status FROM staged s
LEFT JOIN dim d ON s.user_id = d.user_id AND {_VALID}""",
    "watch_time_by_plan": f"""
SELECT s.user_id, CAST(date_trunc('week', s.event_date) AS DATE) AS week_start_date, coalesce(d.current_plan, 'unknown') AS plan,
 CAST(sum(s.watch_time_sec) AS BIGINT) AS total_watch_time_sec, count(s.event_id) AS event_count
FROM facts s LEFT JOIN dim d ON s.user_id = d.user_id AND {_VALID} WHERE s.user_id IS NOT NULL GROUP BY 1, 2, 3""",
    "device_link": """
SELECT event_id, device_id, user_id, last_value(user_id IGNORE NULLS) OVER (PARTITION BY device_id ORDER BY server_ts, event_id
 ROWS UNBOUNDED PRECEDING) AS linked_user_id FROM staged""",
    "calendar_dim": """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date, CAST(dayofweek(d) + 1 AS BIGINT) AS day_of_week,
 CAST(weekofyear(d) AS BIGINT) AS week_of_year, CAST(month(d) AS BIGINT) AS month_num, CAST(year(d) AS BIGINT) AS year_num,
 dayofweek(d) IN (0, 6) AS is_weekend, d IN (SELECT CAST(last_updated_ts AS DATE) FROM users_cdc) AS is_holiday
FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM (
  SELECT min(event_date) AS a, max(CAST(server_ts AS DATE)) AS b FROM typed))""",
    "content_dim": f"""
SELECT content_id, title, content_type, genre, language, CAST(duration_sec AS BIGINT) AS duration_sec, is_premium, publish_ts,
 TIMESTAMP '{INGEST}' AS _loaded_at FROM content""",
    "user_day": f"SELECT {_DAY}, primary_platform FROM days",
    "primary_platform": "SELECT * FROM main_platform",
    "breadth": "SELECT * FROM breadths",
    "engagement_score": "SELECT user_id, activity_date, plan_segment, engagement_score FROM window_scores",
    "score_backfill": "SELECT user_id, activity_date, plan_segment, engagement_score FROM scored_days",
    "score_validation": f"""
SELECT plan_segment, count(DISTINCT user_id) AS users, min(engagement_score) AS min_score, max(engagement_score) AS max_score,
 {number(half_up("sum(engagement_score)", "count(engagement_score)", 1), 1)} AS avg_score,
 round(stddev_samp(engagement_score), 2) AS stddev_score
FROM scored_days WHERE activity_date >= (SELECT max(activity_date) FROM days) - 7 GROUP BY 1""",
    "weekly_mart": _mart_rows("mart"),
    "weekly_mart_dormant": f"{_mart_rows('mart_absent')} WHERE week_start_date >= (SELECT min(ws) + 7 FROM span_weeks)",
    "weekly_plan_platform": "SELECT * FROM plan_platform_growth",
    "exec_summary": f"""
SELECT c.*, p.prev AS prev_avg_engagement_score, round(c.avg_engagement_score - p.prev, 1) AS engagement_score_delta FROM (
 SELECT week_start_date, segment, plan, count(DISTINCT user_id) AS total_users,
  {number(half_up("sum(min_c)", "100 * count(min_c)", 2))} AS avg_watch_time_min,
  {number(half_up("sum(session_count)", "count(session_count)", 1), 1)} AS avg_sessions,
  {number(half_up("sum(score_c)", "100 * count(score_c)", 1), 1)} AS avg_engagement_score,
  {number(half_up("sum(coalesce(wow_c, 0))", "100 * count(*)", 2))} AS avg_wow_change_pct,
  count(DISTINCT CASE WHEN engagement_trend = 'Surging' THEN user_id END) AS surging_users,
  count(DISTINCT CASE WHEN engagement_trend = 'At Risk' THEN user_id END) AS at_risk_users FROM newest GROUP BY 1, 2, 3) c
LEFT JOIN (SELECT segment, plan, {number(half_up("sum(score_c)", "100 * count(score_c)", 1), 1)} AS prev
 FROM newest_but_one GROUP BY 1, 2) p ON c.segment = p.segment AND c.plan = p.plan""",
    "segment_velocity": f"""
SELECT segment, plan, count(DISTINCT user_id) AS user_count,
 {number(half_up("sum(min_c)", "100 * count(min_c)", 2))} AS avg_watch_time,
 {number(half_up("sum(wow_c)", "100 * count(wow_c)", 2))} AS avg_wow_change,
 {number(half_up("100 * count(DISTINCT CASE WHEN engagement_trend IN ('Surging', 'Growing') THEN user_id END)",
                 "count(DISTINCT user_id)", 1), 1)} AS pct_growing,
 {number(half_up("100 * count(DISTINCT CASE WHEN engagement_trend IN ('Declining', 'At Risk') THEN user_id END)",
                 "count(DISTINCT user_id)", 1), 1)} AS pct_declining FROM newest GROUP BY 1, 2""",
    "at_risk_top100": f"""
SELECT user_id, plan, segment, {number("min_c")} AS total_watch_time_min, CAST(session_count AS BIGINT) AS session_count,
 days_active, {number("score_c")} AS avg_engagement_score, {number("wow_c")} AS week_over_week_change_pct, engagement_trend
FROM newest WHERE engagement_trend = 'At Risk' ORDER BY wow_c, user_id LIMIT 100""",
    "plan_platform_incremental": "SELECT * FROM plan_platform_growth",
    "freshness": f"""
SELECT latest_event_ts, latest_server_ts, TIMESTAMP '{FRESH_NOW}' AS current_time_utc, delay_minutes,
 CASE WHEN delay_minutes > 60 THEN 'CRITICAL: Data is older than 60 mins' WHEN delay_minutes > 30
  THEN 'WARNING: Data is older than 30 mins' ELSE 'HEALTHY' END AS freshness_status
FROM (SELECT max(event_ts) AS latest_event_ts, max(server_ts) AS latest_server_ts,
 date_sub('minute', max(server_ts), TIMESTAMP '{FRESH_NOW}') AS delay_minutes FROM playback_events)""",
    "upsert_latest": f"SELECT {RAW} FROM staged",
    "upsert_all": """
SELECT device_id, count(*) AS events, max(server_ts) AS last_ts FROM first_load
WHERE device_id NOT IN (SELECT device_id FROM second_load) GROUP BY 1
UNION ALL SELECT device_id, count(*), max(server_ts) FROM second_load GROUP BY 1""",
    "upsert_table": _STAGED,
    "update_matched": f"""
SELECT d.user_id, d.activity_date, {number("d.min_c")} AS total_watch_time_min, s.engagement_score FROM days d
LEFT JOIN window_scores s ON d.user_id = s.user_id AND d.activity_date = s.activity_date""",
    "replay_and_retain": f"{_SESSIONS} WHERE session_date > (SELECT max(session_date) FROM session_rows) - 30",
    "clustered_layout": _SESSIONS,
    "dq_events": _checks(
        "facts",
        [
            ("null_event_id", "event_id IS NULL", 0.0),
            ("negative_watch_time", "watch_time_sec < 0", 0.0),
            ("watch_time_over_300s", "watch_time_sec > 300", 0.001),
            ("event_date_lag_gt_2d", "date_diff('day', event_date, CAST(server_ts AS DATE)) > 2", 0.01),
        ],
    ),
    "dq_daily": _checks(
        "scored_days",
        [
            ("engagement_score_bounds", "engagement_score < 0 OR engagement_score > 100", 0.0),
            ("negative_watch_time", "min_c < 0", 0.0),
        ],
    ),
    "dq_plan_platform": _checks(
        "plan_platform_growth",
        [
            ("not_null_week_start_date", "week_start_date IS NULL", 0.0),
            ("not_null_current_plan", "current_plan IS NULL", 0.0),
            ("accepted_values_current_plan", f"current_plan NOT IN {_in(PLANS)}", 0.0),
            ("not_null_platform", "platform IS NULL", 0.0),
            ("not_null_avg_engagement_score", "avg_engagement_score IS NULL", 0.0),
            ("range_avg_engagement_score", "avg_engagement_score < 0 OR avg_engagement_score > 100", 0.0),
        ],
    ),
    "stream_dedup": """
SELECT event_id, user_id, content_id, event_type, event_ts, server_ts, platform, event_date FROM staged""",
    "stream_concurrent_viewers": _viewers("staged"),
    "live_recent_viewers": _viewers("live_rows"),
    "stream_viewer_marks": _viewers("playback_events"),
    "stream_approx_viewers": f"SELECT *, TRUE AS within_error FROM ({_viewers('playback_events')})",
    "viewers_rollup": " UNION ALL ".join(
        f"""SELECT '{unit}' AS unit, platform, CAST(date_trunc('{unit}', server_ts) AS TIMESTAMP) AS start,
 count(DISTINCT user_id) AS viewers, TRUE AS within_error FROM playback_events
WHERE event_type IN ('play_start', 'heartbeat') AND user_id IS NOT NULL GROUP BY 1, 2, 3"""
        for unit in ("hour", "day", "week")
    ),
    "stream_sessions": _gaps("playback_events", "user_id", "server_ts"),
    "raw_sessions_scan": f"""
SELECT * FROM (SELECT *, CAST(session_start_ts AS DATE) AS session_date FROM app_sessions)
WHERE session_date BETWEEN DATE '{LOOKBACK_DATE}' AND DATE '{LAST_DAY}'""",
    "cdc_since": f"SELECT * FROM users_cdc WHERE last_updated_ts >= TIMESTAMP '{CDC_SINCE}'",
    "lookback_empty_days": f"{_STAGED} WHERE event_date = (SELECT max(event_date) FROM staged)",
    "append_table": _SESSIONS,
    "table_statistics": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS num_nulls FROM session_rows" for c in FCT_SESSIONS.columns
    ),
    "exec_summary_order": """
SELECT row_number() OVER (ORDER BY wow DESC NULLS LAST, segment, plan NULLS FIRST) AS position, segment, plan, wow AS avg_wow_change_pct
FROM (SELECT segment, plan, WOW_0 AS wow FROM newest GROUP BY 1, 2)""".replace(
        "WOW_0", number(half_up("sum(coalesce(wow_c, 0))", "100 * count(*)", 2))
    ),
    "segment_velocity_order": """
SELECT row_number() OVER (ORDER BY abs(wow) DESC NULLS LAST, segment, plan NULLS FIRST) AS position, segment, plan, wow AS avg_wow_change
FROM (SELECT segment, plan, WOW AS wow FROM newest GROUP BY 1, 2)""".replace("WOW", number(half_up("sum(wow_c)", "100 * count(wow_c)", 2))),
    "score_validation_order": f"""
SELECT row_number() OVER (ORDER BY avg_score DESC NULLS LAST, plan_segment) AS position, plan_segment, avg_score FROM (
 SELECT plan_segment, {number(half_up("sum(engagement_score)", "count(engagement_score)", 1), 1)} AS avg_score
 FROM scored_days WHERE activity_date >= (SELECT max(activity_date) FROM days) - 7 GROUP BY 1)""",
    "gate_events": """
SELECT name, passed, name <> 'watch_time_over_300s' AS stops, name <> 'watch_time_over_300s' AND NOT passed AS blocks FROM (CHECKS)""".replace(
        "CHECKS",
        _checks(
            "facts",
            [
                ("null_event_id", "event_id IS NULL", 0.0),
                ("negative_watch_time", "watch_time_sec < 0", 0.0),
                ("watch_time_over_300s", "watch_time_sec > 300", 0.001),
                ("event_date_lag_gt_2d", "date_diff('day', event_date, CAST(server_ts AS DATE)) > 2", 0.01),
            ],
        ),
    ),
    "stream_session_window": _gaps("events", "user_id", "ts"),
    "weekly_minutes": f"""
SELECT user_id, CAST(date_trunc('week', activity_date) AS DATE) AS week_start_date, {number("sum(min_c)")} AS total_watch_time_min
FROM days GROUP BY 1, 2""",
}


QUERIES["report_csv"] = QUERIES["segment_velocity"]
QUERIES["interleaved_layout"] = QUERIES["vod_cap"]
QUERIES["nightly_late_data"] = QUERIES["weekly_mart"]
for _plan in ("watch_time", "scd2_history", "asof_plan_event", "device_link"):
    QUERIES[f"{_plan}_hot"] = QUERIES[_plan]


def _needed(text: str) -> set[str]:
    direct = {n for n in STEPS if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", text)}
    return direct.union(*[_needed(STEPS[n]) for n in direct]) if direct else direct


def sql(text: str) -> str:
    """The query with the steps it needs, in order of definition."""
    needed = _needed(text)
    ctes = ",\n".join(f"{n} AS ({STEPS[n].strip()})" for n in STEPS if n in needed)
    return f"WITH {ctes}\n{text.strip()}" if ctes else text.strip()


def all_oracles() -> dict[str, str]:
    return {name: sql(text) for name, text in QUERIES.items()}
