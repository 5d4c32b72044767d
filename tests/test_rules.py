"""Branches of the definitions on hand-made rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from viewpulse.functions.dates import week_start
from viewpulse.functions.exact import minutes, ratio
from viewpulse.functions.keys import row_hash
from viewpulse.functions.labels import engagement_trend, segment, wow_change
from viewpulse.operators import asof, dedup, dims, quality, reports, score, scd2, sessions, upsert, user_day, watch, weekly

EVENT = (
    "event_id string, user_id string, device_id string, session_id string, content_id string, event_type string, "
    "event_ts timestamp_ntz, server_ts timestamp_ntz, position_sec int, platform string, country_code string"
)


def event(event_id, server_ts, event_type="heartbeat", session="s", content="c", user="u", **other):
    return (
        event_id, user, other.get("device", "d"), session, content, event_type, other.get("event_ts", server_ts),
        server_ts, other.get("position", 0), other.get("platform", "ios"), "PK",
    )


def watched(make, *rows, **options):
    staged = dedup.type_events(make(EVENT, list(rows)), "2024-01-20 00:00:00")
    return {r.event_id: r.watch_time_sec for r in watch.watch_time(staged, **options).collect()}


def test_watch_time_branches(make):
    got = watched(
        make,
        event("a", "2024-01-10 10:00:00.900", "play_start"),
        event("b", "2024-01-10 10:00:31.100"),
        event("c", "2024-01-10 10:05:31"),
        event("d", "2024-01-10 10:20:00", "heartbeat"),
        event("e", "2024-01-10 10:40:00", "pause"),
        event("f", "2024-01-10 10:41:00", "error"),
        event("g", "2024-01-10 10:42:00", "play_end"),
        event("h", "2024-01-10 10:43:00", None),
        event("i", "2024-01-10 10:50:00", "play_end"),
    )
    # Seconds are truncated on each side; exactly 300 is kept; a gap ended by a pause is not capped; a last stop earns 30.
    assert got == {"a": 31, "b": 300, "c": 300, "d": 1200, "e": 0, "f": 0, "g": 0, "h": 300, "i": 30}


def test_watch_time_is_per_session_content_and_day(make):
    rows = [
        event("a", "2024-01-10 23:59:30"),
        event("b", "2024-01-11 00:00:30"),
        event("c", "2024-01-11 00:01:00", content="other"),
        event("d", "2024-01-11 00:02:00", session="other"),
    ]
    assert watched(make, *rows) == {"a": 30, "b": 30, "c": 30, "d": 30}
    assert watched(make, *rows, across_days=True) == {"a": 60, "b": 30, "c": 30, "d": 30}


def test_vod_cap(make):
    events = make("event_id string, content_id string, watch_time_sec bigint", [("a", "m", 90), ("b", "l", 90), ("c", "n", 90), ("d", "x", 90), ("e", "m", 10)])
    content = make("content_id string, content_type string, duration_sec int", [("m", "vod_movie", 60), ("l", "live", 60), ("n", "highlight", None)])
    got = {r.event_id: r.watch_time_sec for r in watch.cap_vod(events, content).collect()}
    assert got == {"a": 60, "b": 90, "c": 90, "d": 90, "e": 10}


def test_late_flag_counts_calendar_days(make):
    rows = [
        event("same", "2024-01-10 23:00:00", event_ts="2024-01-10 01:00:00"),
        event("next", "2024-01-11 23:00:00", event_ts="2024-01-10 00:00:00"),
        event("late", "2024-01-12 00:00:01", event_ts="2024-01-10 23:59:59"),
        event("none", "2024-01-12 00:00:01", event_ts=None),
    ]
    typed = dedup.type_events(make(EVENT, rows), "2024-01-20 00:00:00")
    assert {r.event_id: r.is_late_arrival for r in typed.collect()} == {"same": False, "next": False, "late": True, "none": False}


def test_latest_copy_is_order_independent(make):
    rows = [
        event("a", "2024-01-10 10:00:00", content="z", position=1),
        event("a", "2024-01-10 10:00:05", content="y", position=2),
        event("a", "2024-01-10 10:00:05", content="x", position=3),
    ]
    for order in (rows, rows[::-1]):
        got = dedup.latest_copy(make(EVENT, order)).collect()
        assert [(r.content_id, r.position_sec) for r in got] == [("x", 3)]
    once = dedup.latest_copy(make(EVENT, rows))
    assert dedup.latest_copy(once).collect() == once.collect()


@pytest.mark.parametrize(
    ("cur", "prev", "pct", "trend"),
    [
        ("10.00", None, None, "Stable"),
        ("10.00", "0.00", "999999.99", "Activated"),
        ("12.00", "10.00", "20.00", "Growing"),
        ("12.01", "10.00", "20.10", "Surging"),
        ("10.50", "10.00", "5.00", "Stable"),
        ("9.50", "10.00", "-5.00", "Stable"),
        ("9.49", "10.00", "-5.10", "Declining"),
        ("8.00", "10.00", "-20.00", "Declining"),
        ("0.00", "10.00", "-100.00", "At Risk"),
        ("2.00", "3.00", "-33.33", "At Risk"),
    ],
)
def test_change_and_trend(spark, cur, prev, pct, trend):
    c, p = (F.lit(x).cast("decimal(18,2)") for x in (cur, prev))
    row = spark.range(1).select(wow_change(c, p).alias("pct"), p.alias("p")).withColumn("t", engagement_trend(F.col("p"), F.col("pct"))).first()
    assert (None if row.pct is None else str(row.pct)) == pct
    assert row.t == trend


def test_segments(spark):
    got = spark.range(0, 8).select(segment(F.col("id")).alias("s")).collect()
    assert [r.s for r in got] == ["Dormant", "Casual", "Casual", "Regular", "Regular", "Power User", "Power User", "Power User"]


def test_exact_rounding(spark):
    row = spark.range(1).select(
        ratio(F.lit(1), F.lit(8), 2).alias("up"),
        ratio(F.lit(-1), F.lit(8), 2).alias("down"),
        ratio(F.lit(1), F.lit(0), 2).alias("zero"),
        minutes(F.lit(3), F.lit(10)).alias("tie"),
    ).first()
    assert [str(row.up), str(row.down), row.zero, str(row.tie)] == ["0.13", "-0.13", None, "0.01"]


def test_row_hash_sees_moved_nulls(make):
    rows = [("a", None, "b"), ("a", "b", None)]
    df = make("signup_source string, country_code string, current_plan string", rows)
    hashes = df.select(row_hash(["signup_source", "country_code", "current_plan"]).alias("h")).distinct()
    assert hashes.count() == 2


def test_weeks_start_on_monday(spark):
    df = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-14')) AS d").select(week_start(F.col("d")).alias("w"))
    assert {r.w for r in df.collect()} == {dt.date(2024, 1, 1), dt.date(2024, 1, 8)}


# Several platforms, devices and ties in one session


def test_sessions_keep_device_and_platform_apart(make):
    rows = [
        event("a", "2024-01-10 10:00:00", platform="ios"),
        event("b", "2024-01-10 10:01:00", platform="tv"),
        event("c", "2024-01-10 10:02:00", platform="tv", device="e"),
        event("n", "2024-01-10 10:03:00", user=None),
    ]
    facts = watch.watch_time(dedup.type_events(make(EVENT, rows), "2024-01-20 00:00:00"))
    got = sessions.session_facts(facts)
    assert got.count() == 4
    assert got.filter("user_id IS NULL").count() == 1


def test_user_day(make):
    rows = [
        event("a", "2024-01-10 10:00:00", platform="web", content="c1"),
        event("b", "2024-01-10 10:01:00", platform="ios", content="c2"),
        event("c", "2024-01-10 11:00:00", platform="ios", content="c2", session="s2"),
        event("d", "2024-01-10 11:00:30", platform="web", content="c9", session="s2"),
        event("n", "2024-01-10 10:03:00", user=None),
    ]
    facts = watch.watch_time(dedup.type_events(make(EVENT, rows), "2024-01-20 00:00:00"))
    content = make("content_id string, genre string, content_type string", [("c1", "g", "live"), ("c2", "g", "vod_movie")])
    (row,) = user_day.user_day(sessions.session_facts(facts), facts, content).collect()
    assert (row.user_id, row.date_key, str(row.total_watch_time_min)) == ("u", 20240110, "2.00")
    # A tie of two events each goes to the first platform in alphabetical order; two sessions seen on two platforms each.
    assert row.primary_platform == "ios"
    assert (row.session_count, str(row.avg_session_duration_min)) == (4, "1.00")
    assert (row.distinct_content_count, row.distinct_genre_count, row.distinct_type_count) == (3, 1, 2)


def test_gap_sessions_break_at_thirty_minutes(make):
    times = ["10:00:00", "10:29:59.999", "10:59:59.999", "11:20:00", "11:50:00.000001"]
    df = make("k string, ts timestamp_ntz", [("a", f"2024-01-10 {t}") for t in times] + [("b", "2024-01-10 10:00:00"), ("b", None)])
    got = {(r.k, str(r.session_start_ts)[11:], r.event_count) for r in sessions.gap_sessions(df, ["k"], "ts").collect()}
    assert got == {
        ("a", "10:00:00", 2),
        ("a", "10:59:59.999000", 2),
        ("a", "11:50:00.000001", 1),
        ("b", "10:00:00", 1),
    }


# History

CDC = (
    "user_id string, signup_ts timestamp_ntz, signup_source string, country_code string, current_plan string, "
    "plan_started_ts timestamp_ntz, status string, last_updated_ts timestamp_ntz"
)


def change(user, when, plan, status="active"):
    return (user, "2023-01-01 00:00:00", None, "PK", plan, "2023-06-01 00:00:00", status, when)


def intervals(dim):
    rows = dim.orderBy("user_id", "valid_from").collect()
    return [(r.user_id, r.current_plan, str(r.valid_from)[:10], str(r.valid_to)[:10], r.is_current) for r in rows]


def test_scd2_collapses_touches_and_chains(make):
    cdc = make(
        CDC,
        [
            change("u", "2024-01-01 00:00:00", "free"),
            change("u", "2024-01-05 00:00:00", "free"),
            change("u", "2024-01-09 00:00:00", "basic"),
            change("v", "2024-01-02 00:00:00", "trial"),
            change(None, "2024-01-02 00:00:00", "trial"),
        ],
    )
    dim = scd2.scd2_apply(None, cdc)
    assert intervals(dim) == [
        ("u", "free", "2024-01-01", "2024-01-09", False),
        ("u", "basic", "2024-01-09", "9999-12-31", True),
        ("v", "trial", "2024-01-02", "9999-12-31", True),
    ]
    assert intervals(scd2.scd2_apply(dim, cdc)) == intervals(dim)
    late = make(CDC, [change("u", "2024-01-03 00:00:00", "premium")])
    assert intervals(scd2.scd2_apply(dim, late))[:3] == [
        ("u", "free", "2024-01-01", "2024-01-03", False),
        ("u", "premium", "2024-01-03", "2024-01-09", False),
        ("u", "basic", "2024-01-09", "9999-12-31", True),
    ]


def test_scd2_changes(make):
    dim = scd2.scd2_apply(None, make(CDC, [change("u", "2024-01-01 00:00:00", "free"), change("w", "2024-01-01 00:00:00", "free")]))
    cdc = make(CDC, [change("u", "2024-01-02 00:00:00", "free"), change("v", "2024-01-02 00:00:00", "free"), change("w", "2024-01-02 00:00:00", None)])
    assert sorted(r.user_id for r in scd2.scd2_changes(dim, cdc).collect()) == ["v", "w"]


def test_asof_bounds_and_split(make):
    dim = scd2.scd2_apply(None, make(CDC, [change("u", "2024-01-08 00:00:00", "free"), change("u", "2024-01-10 12:00:00", "basic")]))
    weeks = make("user_id string, week_start_date date", [("u", "2024-01-01"), ("u", "2024-01-08"), ("u", "2024-01-15")])
    got = asof.attach_at_date(weeks, dim, "week_start_date", ["current_plan"]).orderBy("week_start_date").collect()
    assert [r.current_plan for r in got] == [None, "free", "basic"]
    facts = make(
        "event_id string, user_id string, server_ts timestamp_ntz, event_date date, watch_time_sec bigint",
        [("a", "u", "2024-01-10 11:59:59", "2024-01-10", 10), ("b", "u", "2024-01-10 12:00:00", "2024-01-10", 5), ("c", "z", "2024-01-10 12:00:00", "2024-01-10", 7)],
    )
    split = {(r.user_id, r.plan): r.total_watch_time_sec for r in asof.watch_time_by_plan(facts, dim).collect()}
    assert split == {("u", "free"): 10, ("u", "basic"): 5, ("z", "unknown"): 7}


# Marts

DAILY = (
    "user_id string, activity_date date, total_watch_time_min double, session_count bigint, "
    "distinct_content_count bigint, distinct_genre_count bigint, engagement_score int"
)


def daily_rows(make, rows):
    return make(DAILY, rows).withColumn("total_watch_time_min", F.col("total_watch_time_min").cast("decimal(18,2)"))


def test_weekly_mart_trends_and_dormant(make):
    days = daily_rows(
        make,
        [
            ("u", "2024-01-01", 10.0, 1, 1, 1, 50),
            ("u", "2024-01-10", 0.0, 2, 3, 1, 60),
            ("u", "2024-01-11", 0.0, 2, 2, 2, 71),
            ("u", "2024-01-16", 5.0, 1, 1, 1, None),
            ("x", "2024-01-01", 1.0, 1, 1, 1, 10),
            ("x", "2024-01-16", 1.0, 1, 1, 1, 10),
        ],
    )
    users = scd2.scd2_apply(None, make(CDC, [change("u", "2023-12-01 00:00:00", "free"), change("q", "2024-01-09 00:00:00", "basic")]))
    mart = weekly.weekly_mart(days, users)
    got = {(r.user_id, str(r.week_start_date)): r for r in mart.collect()}
    second = got["u", "2024-01-08"]
    assert (second.days_active, second.session_count, second.distinct_content_count, second.segment) == (2, 4, 3, "Casual")
    assert (second.avg_engagement_score, second.week_over_week_change_pct, second.engagement_trend) == (Decimal("65.50"), Decimal("-100.00"), "At Risk")
    assert got["u", "2024-01-15"].engagement_trend == "Activated"
    assert got["u", "2024-01-15"].user_plan_at_week_start == "free"
    assert got["u", "2024-01-15"].avg_engagement_score is None
    # The week between is missing, so there is no previous week to compare with.
    assert got["x", "2024-01-15"].week_over_week_change_pct is None
    assert got["x", "2024-01-15"].user_plan_at_week_start is None

    full = weekly.weekly_mart(days, users, "2024-01-08", "2024-01-15", include_dormant=True)
    rows = {(r.user_id, str(r.week_start_date)): (r.segment, r.engagement_trend, r.days_active) for r in full.collect()}
    # x was active a week before but has no user record; q starts on a Tuesday and counts from the next Monday on.
    assert rows == {
        ("u", "2024-01-08"): ("Casual", "At Risk", 2),
        ("u", "2024-01-15"): ("Casual", "Activated", 1),
        ("x", "2024-01-15"): ("Casual", "Stable", 1),
        ("q", "2024-01-15"): ("Dormant", "Stable", 0),
    }
    with pytest.raises(ValueError):
        weekly.weekly_mart(days, users, include_dormant=True)


def test_scores_equal_window_ranks(spark, make):
    days = spark.range(400).select(
        F.concat(F.lit("u"), F.col("id") % 40).alias("user_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 45).cast("int")).alias("activity_date"),
        F.when(F.col("id") % 17 > 0, (F.col("id") * 37 % 23).cast("decimal(18,2)")).alias("total_watch_time_min"),
        (F.col("id") % 5).alias("session_count"),
        (F.col("id") % 3).alias("distinct_genre_count"),
    )
    users = spark.range(35).select(F.concat(F.lit("u"), "id").alias("user_id"), F.when(F.col("id") > 0, F.concat(F.lit("p"), F.col("id") % 3)).alias("current_plan"), F.lit(True).alias("is_current"))
    got = score.engagement_score(days, users, "2024-02-05")
    days.createOrReplaceTempView("t_days")
    users.createOrReplaceTempView("t_users")
    want = spark.sql("""
        SELECT user_id, activity_date, plan_segment, CAST(round(
          percent_rank() OVER (PARTITION BY plan_segment ORDER BY total_watch_time_min) * 50D
          + percent_rank() OVER (PARTITION BY plan_segment ORDER BY session_count) * 30D
          + percent_rank() OVER (PARTITION BY plan_segment ORDER BY distinct_genre_count) * 20D, 0) AS INT) AS engagement_score
        FROM (SELECT d.*, coalesce(current_plan, 'unknown') AS plan_segment FROM t_days d LEFT JOIN t_users USING (user_id)
              WHERE activity_date BETWEEN DATE '2024-01-09' AND DATE '2024-02-05')""")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_backfill_is_what_nightly_runs_leave(spark):
    days = spark.range(300).select(
        F.concat(F.lit("u"), F.col("id") % 30).alias("user_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("activity_date"),
        (F.col("id") * 37 % 23).cast("decimal(18,2)").alias("total_watch_time_min"),
        (F.col("id") % 5).alias("session_count"),
        (F.col("id") % 3).alias("distinct_genre_count"),
    ).dropDuplicates(["user_id", "activity_date"])
    users = spark.range(25).select(F.concat(F.lit("u"), "id").alias("user_id"), F.lit("p").alias("current_plan"), F.lit(True).alias("is_current"))
    left: dict = {}
    for night in ("2024-02-03", "2024-02-04", "2024-02-05"):
        left |= {(r[0], r[1]): r[3] for r in score.engagement_score(days, users, night).collect()}
    got = {(r[0], r[1]): r[3] for r in score.backfill_scores(days, users, "2024-02-03", "2024-02-05").collect()}
    assert got == left


# Merges, checks, small reports


def test_merges(make):
    target = make("k string, v bigint, ts bigint", [("a", 1, 5), ("b", 2, 5), (None, 3, 5), ("c", 4, None)])
    source = make("k string, v bigint, ts bigint", [("a", 10, 5), ("b", 20, 6), (None, 30, 6), ("d", 40, 1), ("c", 50, 9)])
    rows = lambda df: sorted(((r.k or "", r.v) for r in df.collect()))
    assert rows(upsert.upsert(target, source, ["k"])) == [("", 30), ("a", 10), ("b", 20), ("c", 50), ("d", 40)]
    # Strictly newer only; an unknown time on the stored side is never newer than anything, nor older.
    assert rows(upsert.upsert_newer(target, source, ["k"], "ts")) == [("", 30), ("a", 1), ("b", 20), ("c", 4), ("d", 40)]
    assert rows(upsert.update_matched(target, source, ["k"], ["v"])) == [("", 30), ("a", 10), ("b", 20), ("c", 50)]
    again = upsert.upsert(upsert.upsert(target, source, ["k"]), source, ["k"])
    assert rows(again) == rows(upsert.upsert(target, source, ["k"]))


def test_quality_gate(make):
    df = make("event_id string, watch_time_sec bigint, server_ts timestamp_ntz, event_date date", [("a", 10, "2024-01-10 00:00:00", "2024-01-10"), (None, -1, "2024-01-13 00:00:00", "2024-01-10")])
    checks = quality.check_suite(df, quality.event_rules())
    got = {r.name: (r.actual, r.passed) for r in checks.collect()}
    assert got == {"null_event_id": (1, False), "negative_watch_time": (1, False), "watch_time_over_300s": (0, True), "event_date_lag_gt_2d": (1, False)}
    with pytest.raises(quality.QualityError, match="null_event_id"):
        quality.gate(checks)
    quality.gate(checks.filter("passed"))
    nulls = quality.check_suite(make("plan string", [(None,), ("free",), ("x",)]), [quality.accepted_values("plan", ["free"]), quality.not_null("plan")])
    assert [r.actual for r in nulls.collect()] == [1, 1]


@pytest.mark.parametrize(("now", "status"), [("10:30:59", "HEALTHY"), ("10:31:00", "WARNING"), ("11:00:59", "WARNING"), ("11:01:00", "CRITICAL")])
def test_freshness(make, now, status):
    events = make("event_ts timestamp_ntz, server_ts timestamp_ntz", [("2024-01-10 09:00:00", "2024-01-10 10:00:00")])
    assert reports.freshness(events, f"2024-01-10 {now}").first().freshness_status.startswith(status)


def test_freshness_of_nothing(make):
    events = make("event_ts timestamp_ntz, server_ts timestamp_ntz", [])
    assert reports.freshness(events, "2024-01-10 00:00:00").first().freshness_status == "HEALTHY"
    assert reports.freshness(events, "2024-01-10 00:00:00", flag_empty=True).first().freshness_status == "NO DATA"


def test_calendar_and_content(make):
    span = make("first_day date, last_day date", [("2024-01-05", "2024-01-08")])
    days = dims.calendar_dim(span, make("full_date date", [("2024-01-08",), ("2024-01-08",)])).orderBy("date_key").collect()
    assert [(d.date_key, d.day_of_week, d.is_weekend, d.is_holiday) for d in days] == [
        (20240105, 6, False, False), (20240106, 7, True, False), (20240107, 1, True, False), (20240108, 2, False, True),
    ]
    ddl = "content_id string, title string, content_type string, genre string, language string, duration_sec int, is_premium boolean, publish_ts timestamp_ntz"
    rows = [("c", "old", "live", "g", "en", 1, True, "2024-01-01 00:00:00"), ("c", "new", "live", "g", "en", 1, True, "2024-01-02 00:00:00")]
    assert [r.title for r in dims.content_dim(make(ddl, rows), "2024-01-03 00:00:00").collect()] == ["new"]


def test_ratio_at_any_size(spark):
    """Against whole-number arithmetic: large denominators, ties, signs, nulls and zero."""
    from decimal import ROUND_HALF_UP, Decimal

    from viewpulse.functions.exact import ratio

    pairs = [
        (1, 3), (5, 1000), (-5, 1000), (15, 1000), (10**14 + 1, 2 * 10**12), (-(10**15), 3 * 10**12), (7, 10**12), (10**13, 8 * 10**11),
        (25, -1000), (0, 5), (3, 0), (None, 5), (5, None), (999999999999, 1000000000000), (10**17, 7),
    ]
    df = spark.createDataFrame(pairs, "num bigint, den bigint")
    for digits in (0, 1, 2):
        got = df.select("num", "den", ratio(F.col("num"), F.col("den"), digits).alias("r")).collect()
        for num, den, r in got:
            want = None if not den or num is None else (Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
            assert r == want, (num, den, digits)


def test_deviation_at_any_size(spark):
    import math

    from viewpulse.operators.score import deviation

    rows = [(10**10, 55 * 10**10, 3300 * 10**10), (4, 10, 30), (1, 5, 25), (0, None, None)]
    df = spark.createDataFrame(rows, "n bigint, s bigint, ss bigint")
    got = [r[0] for r in df.select(deviation(F.col("n"), F.col("s"), F.col("ss"))).collect()]
    assert math.isclose(got[0], math.sqrt(275), rel_tol=1e-6) and math.isclose(got[1], math.sqrt(5 / 3)) and got[2:] == [None, None]
