"""Cut windows and salted joins give what the plain ones give, and the plans stay clear of hot tasks."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from viewpulse.operators import asof, dedup, score, scd2, skew, upsert, watch, weekly
from viewpulse.sources import derived, files, tables
from viewpulse.schemas import FCT_SESSIONS


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def busy(spark):
    """6,000 events; one session, device and user hold a third of them, spread over three days."""
    ids = spark.range(6000)
    hot = F.col("id") % 3 == 0
    second = F.pmod(F.xxhash64("id"), F.lit(3 * 86400))
    return tables.settle(
        ids.select(
            F.format_string("e%05d", "id").alias("event_id"),
            F.when(hot, "whale").when(F.col("id") % 7 == 1, None).otherwise(F.concat(F.lit("u"), F.col("id") % 90)).alias("user_id"),
            F.when(hot, "box").otherwise(F.concat(F.lit("d"), F.col("id") % 70)).alias("device_id"),
            F.when(hot, "marathon").otherwise(F.concat(F.lit("s"), F.col("id") % 200)).alias("session_id"),
            F.lit("c").alias("content_id"),
            F.element_at(F.array(*map(F.lit, ["play_start", "heartbeat", "pause", "seek", "play_end", "error"])), (F.col("id") % 6 + 1).cast("int")).alias("event_type"),
            (F.lit("2024-01-10 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=second - second % 20)).alias("server_ts"),
        ).withColumn("event_ts", F.col("server_ts")).withColumn("event_date", F.to_date("server_ts"))
    )


def test_finds_the_hot_keys(busy):
    hot = skew.hot_keys(busy, ["session_id"], ["event_id"], min_rows=1000)
    assert hot.count() == 1
    flagged = skew.marked(busy, ["session_id"], hot)
    assert flagged.count() == busy.count() and flagged.filter("_hot").select("session_id").distinct().first()[0] == "marathon"
    assert skew.hot_keys(busy, ["session_id"], ["event_id"]) is None
    assert skew.hot_keys(busy.filter("false"), ["session_id"], ["event_id"], min_rows=0) is None


def test_the_sample_finds_what_is_hot(spark):
    """Keys of twice the bound are all found, keys of a tenth of it hardly ever; the same rows give the same keys."""
    rows = spark.range(1_200_000).select(F.col("id").alias("event_id"), F.when(F.col("id") < 800_000, F.col("id") % 20).otherwise(100 + F.col("id") % 200).alias("key"))
    first, again = (skew.hot_keys(rows.repartition(n), ["key"], ["event_id"], min_rows=20_000) for n in (3, 5))
    assert {r.k for r in first.collect()} == {r.k for r in again.collect()}
    flagged = {r.key for r in skew.marked(rows, ["key"], first).filter("_hot").select("key").distinct().collect()}
    assert set(range(20)) <= flagged and not flagged & set(range(100, 300))


def test_a_hundred_thousand_hot_keys(spark):
    """They stay a table: the plan does not grow with them, and the driver does not see them."""
    ids = spark.range(300_000).select(F.col("id").alias("event_id"), (F.col("id") % 100_000).alias("key"))
    events = tables.settle(ids.withColumn("at", F.lit("2024-01-10 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("event_id") % 977)))
    hot = skew.hot_keys(events, ["key"], ["event_id"], min_rows=2)
    assert hot.count() == 100_000
    cut, whole = (skew.with_neighbour(events, ["key"], ["at", "event_id"], ["event_id"], "at", h) for h in (hot, None))
    assert len(plan(cut)) < 30_000
    assert cut.exceptAll(whole).isEmpty() and whole.exceptAll(cut).isEmpty()
    linked, plainly = (skew.last_known(events, ["key"], ["at", "event_id"], "event_id", "at", "last", h) for h in (hot, None))
    assert linked.exceptAll(plainly).isEmpty()


@pytest.mark.parametrize("across_days", [False, True])
@pytest.mark.parametrize("slot", [40, 3600])
def test_cut_watch_time(busy, across_days, slot):
    hot = skew.hot_keys(busy, watch.group_keys(across_days), ["event_id"], min_rows=100)
    assert hot is not None
    cut = watch.watch_time(busy, hot, across_days, slot)
    plain = watch.watch_time(busy, None, across_days)
    assert cut.columns == plain.columns
    assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()


def test_cut_watch_time_reads_and_shuffles_its_input_once(busy):
    hot = skew.hot_keys(busy, watch.group_keys(), ["event_id"], min_rows=100)
    cut = watch.watch_time(busy, hot)
    cut.collect()
    assert "ReusedExchange" in plan(cut) or "ReusedQueryStage" in plan(cut)


@pytest.mark.parametrize("slot", [40, 3600])
def test_cut_device_link(busy, slot):
    mixed = busy.withColumn("user_id", F.when(F.col("event_id").substr(6, 1).isin("3", "6"), F.col("user_id")))
    hot = skew.hot_keys(mixed, ["device_id"], ["event_id"], min_rows=100)
    assert hot is not None
    cut, plain = asof.link_devices(mixed, hot, slot), asof.link_devices(mixed)
    assert plain.filter("linked_user_id IS NOT NULL AND user_id IS NULL").count() > 1000
    assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()


def test_salted_join(busy, spark):
    dim = spark.sql("""
        SELECT * FROM VALUES ('whale', TIMESTAMP_NTZ'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-11 06:00:00', 'free'),
          ('whale', TIMESTAMP_NTZ'2024-01-11 06:00:00', TIMESTAMP_NTZ'9999-12-31 00:00:00', 'basic'),
          ('u4', TIMESTAMP_NTZ'2024-01-11 00:00:00', TIMESTAMP_NTZ'9999-12-31 00:00:00', 'trial')
        AS t(user_id, valid_from, valid_to, current_plan)""")
    hot = skew.hot_keys(busy, ["user_id"], ["event_id"], min_rows=500)
    assert hot.count() >= 1
    salted = asof.attach_at_event(busy, dim, ["current_plan"], hot=hot)
    on = (busy.user_id == dim.user_id) & (dim.valid_from <= busy.server_ts) & (busy.server_ts < dim.valid_to)
    plain = busy.join(dim, on, "left").select(*[busy[c] for c in busy.columns], "current_plan")
    assert salted.columns == plain.columns
    assert salted.count() == busy.count()
    assert salted.exceptAll(plain).isEmpty()


def test_cut_history(make):
    rows = [("u", f"2024-01-{d:02d} 00:00:00", "free" if d % 3 else "basic") for d in range(1, 29)] + [("v", "2024-01-01 00:00:00", "free")]
    cdc = make("user_id string, last_updated_ts timestamp_ntz, current_plan string", rows).selectExpr(
        "user_id", "last_updated_ts AS signup_ts", "'x' AS signup_source", "'PK' AS country_code", "current_plan",
        "TIMESTAMP_NTZ'2023-01-01 00:00:00' AS plan_started_ts", "'active' AS status", "last_updated_ts",
    )
    hot = skew.hot_keys(cdc, ["user_id"], ["last_updated_ts"], min_rows=10)
    assert hot.count() == 1
    cut, plain = scd2.scd2_apply(None, cdc, hot), scd2.scd2_apply(None, cdc)
    assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()


EVENTS = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 400), st.sampled_from(["pause", "heartbeat", "play_end"])), max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(EVENTS)
def test_dedup_properties(spark, rows):
    base = dt.datetime(2024, 1, 10)
    ddl = "event_id string, server_ts timestamp_ntz, event_ts timestamp_ntz, content_id string, event_type string"
    data = [(f"e{k}", base + dt.timedelta(seconds=s), base, "c", t) for k, s, t in rows]
    once = dedup.latest_copy(spark.createDataFrame(data, ddl)).collect()
    want = {k: max(r[1] for r in data if r[0] == k) for k in {r[0] for r in data}}
    assert {r.event_id: r.server_ts for r in once} == want
    assert sorted(once) == sorted(dedup.latest_copy(spark.createDataFrame(data[::-1], ddl)).collect())
    first, rest = data[: len(data) // 2], data[len(data) // 2 :]
    parts = [dedup.latest_copy(spark.createDataFrame(p, ddl)) for p in (first, rest)]
    merged = upsert.upsert_newer(*parts, ["event_id"], "server_ts").collect()
    assert {r.event_id: r.server_ts for r in merged} == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9), st.integers(0, 2)), max_size=20), st.integers(0, 20))
def test_history_properties(spark, rows, cut):
    base = dt.datetime(2024, 1, 1)
    ddl = """user_id string, signup_ts timestamp_ntz, signup_source string, country_code string, current_plan string,
        plan_started_ts timestamp_ntz, status string, last_updated_ts timestamp_ntz"""
    seen, data = set(), []
    for u, d, p in rows:
        if (u, d) not in seen:
            seen.add((u, d))
            data.append((f"u{u}", base, None, "PK", f"p{p}", base, "active", base + dt.timedelta(days=d)))
    build = lambda part: spark.createDataFrame(part, ddl)
    dim = scd2.scd2_apply(None, build(data)).collect()
    for user in {r.user_id for r in dim}:
        mine = sorted((r for r in dim if r.user_id == user), key=lambda r: r.valid_from)
        assert [r.is_current for r in mine] == [False] * (len(mine) - 1) + [True]
        assert all(a.valid_to == b.valid_from and a.row_hash != b.row_hash for a, b in zip(mine, mine[1:], strict=False))
        assert mine[-1].valid_to.year == 9999
    ordered = sorted(data, key=lambda r: r[-1])
    stepwise = scd2.scd2_apply(scd2.scd2_apply(None, build(ordered[:cut])), build(ordered[cut:])).collect()
    assert sorted(stepwise) == sorted(dim)


# Plans


def test_no_plan_pairs_rows_blindly_or_runs_in_one_task(spark):
    from viewpulse.plans.queries import all_queries

    for name in ("vod_cap", "asof_plan_event", "watch_time_by_plan", "score_backfill", "weekly_mart"):
        text = plan(all_queries()[name](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
        windows = re.findall(r"Window \[.*", text)
        assert all("], []" not in w for w in windows), name


def test_plans_at_a_date_have_no_range_join(spark):
    from viewpulse.plans.queries import all_queries

    for name in ("asof_plan_week", "weekly_plan_platform"):
        text = plan(all_queries()[name](spark, "/root/testdata/sf0.001"))
        assert not re.search(r"Join \[user_id.*valid_from", text), name


def test_dedup_prunes_copies_before_the_shuffle(spark):
    text = plan(dedup.latest_copy(derived.playback_events(spark, "/root/testdata/sf0.001")))
    assert text.index("row_number(), 1, Final") < text.index("Exchange hashpartitioning(event_id") < text.index("row_number(), 1, Partial")


def test_weekly_mart_shuffles_daily_rows_once(spark, make):
    days = make(
        """user_id string, activity_date date, total_watch_time_min int, session_count bigint, distinct_content_count bigint, distinct_genre_count bigint, engagement_score int""".replace("\n", ""),
        [("u", "2024-01-01", 1, 1, 1, 1, 1)],
    )
    users = scd2.scd2_apply(None, derived.users_cdc(spark, "/root/testdata/sf0.001"))
    text = plan(weekly.weekly_mart(days, tables.settle(users)))
    assert len(re.findall(r"Exchange hashpartitioning\(user_id", text)) <= 2


def test_scans_prune_and_push_down(spark, busy, tmp_path):
    facts = watch.watch_time(busy).withColumns({"platform": F.lit("tv"), "device_id": F.col("device_id")})
    from viewpulse.operators.sessions import session_facts

    tables.overwrite(session_facts(facts), str(tmp_path), FCT_SESSIONS)
    text = plan(files.lookback(spark, str(tmp_path), FCT_SESSIONS, "2024-01-11", 0).select("user_id").filter("user_id = 'whale'"))
    assert re.search(r"PartitionFilters: \[.*session_date.*2024-01-11", text)
    assert "EqualTo(user_id,whale)" in text
    assert "ReadSchema: struct<user_id:string>" in text


def test_score_windows_run_on_value_counts(spark):
    days = spark.range(10).select(
        F.lit("u").alias("user_id"), F.lit("2024-01-01").cast("date").alias("activity_date"),
        F.lit(1).cast("decimal(18,2)").alias("total_watch_time_min"), F.lit(1).alias("session_count"), F.lit(1).alias("distinct_genre_count"),
    )
    users = spark.range(1).select(F.lit("u").alias("user_id"), F.lit("p").alias("current_plan"), F.lit(True).alias("is_current"))
    text = plan(score.engagement_score(days, users, "2024-01-01"))
    for at in [m.start() for m in re.finditer(r"Window \[", text)]:
        assert "HashAggregate" in text[at : at + 3000]


@pytest.fixture
def unbroadcast(spark):
    """Joins by shuffle, as those of a large catalogue."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def viewed(spark):
    """Staged events with copies of a title in the catalogue, titles it lacks, and events without a title."""
    ids = spark.range(400)
    raw = ids.selectExpr(
        "'e' || id % 390 AS event_id", "IF(id % 9 = 0, NULL, 'u' || id % 5) AS user_id", "'d' || id % 5 AS device_id", "'s' || id % 17 AS session_id",
        "IF(id % 11 = 0, NULL, 'c' || id % 6) AS content_id", "IF(id % 4 = 0, 'pause', 'heartbeat') AS event_type",
        "CAST('2024-01-10 23:00:00' AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, 0, id * 20) AS event_ts",
        "CAST('2024-01-10 23:00:00' AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, 0, id * 20) AS server_ts",
        "CAST(id AS INT) AS position_sec", "'ios' AS platform", "'PK' AS country_code",
    )
    content = spark.createDataFrame(
        [("c0", "g0", "vod_movie", 40), ("c1", "g1", "vod_movie", 25), ("c1", "g1", "vod_movie", 90), ("c2", None, "live", 10), ("c3", "g1", "highlight", None)],
        "content_id string, genre string, content_type string, duration_sec int",
    )
    return tables.settle(raw), content


def test_dedup_shuffles_what_came_only(viewed):
    text = plan(dedup.dedup_events(viewed[0], "2024-02-12 02:00:00"))
    below = text[text.index("Window [") :]
    assert "is_late_arrival" not in below and "event_date" not in below


def test_facts_of_a_large_catalogue_are_shuffled_once_by_title(unbroadcast, viewed):
    """The join of a large catalogue, the window and the fold by title behind it each shuffled the events."""
    from viewpulse.operators import sessions

    staged = tables.settle(dedup.dedup_events(viewed[0], "2024-02-12 02:00:00"))
    folded = sessions.session_titles(watch.playback_facts(staged, viewed[1], spread=False))
    text = plan(folded)
    assert len(re.findall(r"Exchange hashpartitioning\(content_id", text)) == 2
    assert "Exchange hashpartitioning(event_date" not in text and "Exchange hashpartitioning(session_id" not in text
    # With hot titles the window spreads them over sessions and the join comes last.
    assert "Exchange hashpartitioning(event_date" in plan(watch.playback_facts(staged, viewed[1]))


@pytest.mark.parametrize("broadcast", [True, False])
def test_facts_are_the_same_in_either_order(spark, viewed, broadcast, request):
    if not broadcast:
        request.getfixturevalue("unbroadcast")
    staged = tables.settle(dedup.dedup_events(viewed[0], "2024-02-12 02:00:00"))
    late, early = (watch.playback_facts(staged, viewed[1], spread=s).collect() for s in (True, False))
    assert sorted(map(repr, late)) == sorted(map(repr, early)) and len(late) > staged.count()
    assert {r.watch_time_sec for r in late if r.content_id == "c1"} >= {25, 90}


def test_folded_facts_give_the_same_sessions_and_days(viewed):
    from viewpulse.operators import sessions, user_day

    content = viewed[1]
    facts = tables.settle(watch.playback_facts(dedup.dedup_events(viewed[0], "2024-02-12 02:00:00"), content))
    titles = tables.settle(sessions.session_titles(facts))
    whole, folded = sessions.session_facts(facts), sessions.session_facts(titles, is_folded=True)
    counts = facts.groupBy("session_id", "user_id", "device_id", "platform", "event_date").agg(F.count_distinct("content_id"), F.count("event_id"), F.sum("watch_time_sec"))
    got = whole.select("session_id", "user_id", "device_id", "platform", "session_date", "distinct_content_count", "event_count", "total_watch_time_sec")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, counts.collect())))
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, folded.collect()))
    days = [sorted(map(repr, user_day.user_day(s, f, content).collect())) for s, f in ((whole, facts), (folded, titles))]
    assert days[0] == days[1]


def test_breadth_does_not_repeat_its_rows(viewed):
    """Two distinct counts in one pass repeated each row three times and shuffled all of them."""
    from viewpulse.operators import user_day

    events = dedup.type_events(viewed[0], "2024-02-12 02:00:00")
    got = user_day.breadth(events, viewed[1])
    assert "Expand" not in plan(got)
    joined = user_day.titles(events).join(viewed[1], "content_id", "left")
    counts = F.count("content_id"), F.count_distinct("genre"), F.count_distinct("content_type")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, joined.groupBy(*user_day.DAY).agg(*counts).collect())))
    assert [t for _, t in got.dtypes[2:]] == ["bigint"] * 3
