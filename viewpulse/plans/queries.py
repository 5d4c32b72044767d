"""Registered queries: each takes (spark, sf_dir) and runs over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.functions.dates import back, epoch_seconds
from viewpulse.functions.keys import row_hash, surrogate_key
from viewpulse.operators import asof, dedup, dims, quality, reports, scd2, score, sessions, skew, upsert, user_day, watch, weekly
from viewpulse.plans import nightly
from viewpulse.schemas import (
    FCT_DAILY, FCT_PLAYBACK, FCT_SESSIONS, LIVE_EVENTS, MART_PLAN_PLATFORM, MART_WEEKLY, PLANS, RAW_CONTENT, RAW_EVENTS, RAW_SESSIONS, RAW_USERS, STG_EVENTS,
)
from viewpulse.sources import derived, files, tables
from viewpulse.streaming import live, log, sketches

# The derived data spans 2023-12-29 (late rows) to 2024-02-11.
INGEST = "2024-02-12 02:00:00"
LAST_DAY = "2024-02-11"
SECOND_LOAD = "2024-01-22 00:00:00"
LOOKBACK_DATE = "2024-01-15"
CDC_SINCE = "2024-02-01 00:00:00"
LIVE_BEFORE = "2024-01-20 12:00:00"
FRESH_NOW = "2024-02-11 01:00:00"

# The JSON feed: slices it is delivered in, and how late an event can come there, within the horizon of 48 hours.
SLICES = 4
LATE_SECONDS = 86_400
CLOSING = "2024-12-31 00:00:00"

# Landed JSON lines name every column in every row; readers tell the codec by the file's name.
JSON_CODEC = "gzip"

# A bound that makes many groups of the given data hot, to run the plans for hot groups on it.
FEW_ROWS = 2

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Result types both engines share: DECIMAL as DOUBLE, integers as BIGINT."""

    def cast(f):
        t = f.dataType.typeName()
        name = {"decimal": "double", "integer": "bigint", "short": "bigint"}.get(t)
        return F.col(f.name).cast(name).alias(f.name) if name else F.col(f.name)

    return df.select(*[cast(f) for f in df.schema])


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return derived.playback_events(spark, sf)


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_events(raw(spark, sf), INGEST)


def stored_events(spark: SparkSession, sf: str) -> DataFrame:
    return tables.settle(staged(spark, sf))


def hot_events(spark: SparkSession, sf: str, keys: list[str], hot_rows: int = skew.MIN_HOT_ROWS) -> DataFrame | None:
    """Hot keys of the raw events: copies can only add to a group, so the deduplicated ones need not be stored first."""
    return skew.hot_keys(dedup.type_events(raw(spark, sf), INGEST), keys, ["event_id", "server_ts"], hot_rows)


def hot_titles(spark: SparkSession, sf: str, hot_rows: int = skew.MIN_HOT_ROWS) -> bool:
    return hot_events(spark, sf, ["content_id"], hot_rows) is not None


def facts(spark: SparkSession, sf: str, spread: bool | None = None) -> DataFrame:
    spread = hot_titles(spark, sf) if spread is None else spread
    return watch.playback_facts(staged(spark, sf), derived.content(spark, sf), hot_events(spark, sf, watch.group_keys()), spread=spread)


def users(spark: SparkSession, sf: str, hot_rows: int = skew.MIN_HOT_ROWS) -> DataFrame:
    """The history as a table: most queries look into it more than once."""
    cdc = derived.users_cdc(spark, sf)
    return tables.settle(scd2.scd2_apply(None, cdc, skew.hot_keys(cdc, ["user_id"], ["user_id", "last_updated_ts"], hot_rows)))


_MEASURED = [
    "event_id", "user_id", "device_id", "session_id", "content_id", "server_ts", "platform", "event_date", "watch_time_sec",
]


def stored_facts(spark: SparkSession, sf: str, spread: bool | None = None) -> DataFrame:
    """The measured columns of the playback facts as a table."""
    return tables.settle(facts(spark, sf, spread).select(*_MEASURED))


def stored_titles(spark: SparkSession, sf: str, hot_rows: int = skew.MIN_HOT_ROWS) -> DataFrame:
    """The playback facts folded by session and title as a table: sessions and breadth need no more of them. With hot titles the
    facts are stored first, as Spark splits a title only where nothing is folded by it in the same stage."""
    spread = hot_titles(spark, sf, hot_rows)
    return tables.settle(sessions.session_titles(stored_facts(spark, sf, spread) if spread else facts(spark, sf, spread)))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    titles = stored_titles(spark, sf)
    sessions_ = tables.settle(sessions.session_facts(titles, is_folded=True))
    return user_day.user_day(sessions_, titles, derived.content(spark, sf))


def span(days: DataFrame) -> tuple:
    """First and last date of user-days."""
    return tuple(days.agg(F.min("activity_date"), F.max("activity_date")).first())


def scored(days: DataFrame, dim: DataFrame) -> DataFrame:
    return score.rescore_range(days, dim, *span(days)).select(*FCT_DAILY.columns)


def scored_daily(spark: SparkSession, sf: str) -> DataFrame:
    return scored(tables.settle(daily(spark, sf)), users(spark, sf))


def mart(spark: SparkSession, sf: str) -> DataFrame:
    dim = users(spark, sf)
    return weekly.weekly_mart(scored(tables.settle(daily(spark, sf)), dim), dim)


def stored_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The mart as a table cut by week, which the reports prune on."""
    return tables.settle(mart(spark, sf), "week_start_date")


# Staging


def q_dedup_events(spark, sf):
    return staged(spark, sf).select(*STG_EVENTS.columns)


def q_late_flag(spark, sf):
    typed = dedup.type_events(raw(spark, sf), INGEST)
    return typed.groupBy("event_date", "is_late_arrival").agg(F.count(F.lit(1)).alias("events"))


def q_app_sessions(spark, sf):
    return dedup.type_sessions(derived.app_sessions(spark, sf), INGEST)


def q_raw_json_scan(spark, sf):
    """Writes the raw events as dated, compressed JSON lines and reads a range of dates back with the declared schema."""
    root = tables.scratch(spark)
    path = f"{root}/{RAW_EVENTS.path}"
    dated = raw(spark, sf).withColumn("event_date", F.to_date("event_ts"))
    dated.hint("rebalance", F.col("event_date")).write.mode("overwrite").partitionBy("event_date").json(path, compression=JSON_CODEC)
    return files.read_events(spark, root, LOOKBACK_DATE, LAST_DAY)


def q_lookback_scan(spark, sf):
    root = tables.scratch(spark)
    tables.overwrite(staged(spark, sf), root, STG_EVENTS)
    return files.lookback(spark, root, STG_EVENTS, LOOKBACK_DATE)


def q_raw_sessions_scan(spark, sf):
    """App sessions by date, read back for a range of dates."""
    root = tables.scratch(spark)
    dated = derived.app_sessions(spark, sf).withColumn("session_date", F.to_date("session_start_ts"))
    dated.hint("rebalance", F.col("session_date")).write.partitionBy("session_date").parquet(f"{root}/{RAW_SESSIONS.path}")
    return files.read_sessions(spark, root, LOOKBACK_DATE, LAST_DAY).select(*dated.columns)


def q_cdc_since(spark, sf):
    root = tables.scratch(spark)
    derived.users_cdc(spark, sf).write.parquet(f"{root}/{RAW_USERS.path}")
    return files.read_user_cdc(spark, root, since=CDC_SINCE)


def q_lookback_empty_days(spark, sf):
    """A lookback whose process date and the day before have no data: the days there are, no error."""
    root = tables.scratch(spark)
    events = stored_events(spark, sf)
    last = events.agg(F.max("event_date")).first()[0]
    tables.overwrite(events, root, STG_EVENTS)
    return files.lookback(spark, root, STG_EVENTS, back(last, -2))


# Facts


def q_watch_time(spark, sf, hot_rows=skew.MIN_HOT_ROWS):
    timed = watch.watch_time(staged(spark, sf), hot_events(spark, sf, watch.group_keys(), hot_rows))
    return timed.select("event_id", "session_id", "content_id", "event_date", "server_ts", "event_type", "watch_time_sec")


def q_watch_time_hot(spark, sf):
    """The cut windows on the given data: groups of more than two events count as hot."""
    return q_watch_time(spark, sf, FEW_ROWS)


def q_watch_time_across_days(spark, sf):
    timed = watch.watch_time(staged(spark, sf), hot_events(spark, sf, watch.group_keys(True)), across_days=True)
    return timed.select("event_id", "session_id", "content_id", "event_date", "watch_time_sec")


def q_vod_cap(spark, sf):
    return facts(spark, sf)


def q_session_facts(spark, sf):
    return sessions.session_facts(facts(spark, sf))


def q_session_gap_30m(spark, sf):
    events = derived.given(spark, sf, "events")
    return sessions.gap_sessions(events, ["user_id"], "ts")


def q_inferred_sessions(spark, sf):
    """Sessions of devices by inactivity, whatever session ids the events carry."""
    return sessions.gap_sessions(staged(spark, sf), ["device_id"], "server_ts")


# Users


def _readable(dim: DataFrame) -> DataFrame:
    """The open end lies beyond what some result formats hold as a timestamp."""
    return dim.withColumn("valid_to", F.col("valid_to").cast("string"))


def q_scd2_history(spark, sf):
    return _readable(users(spark, sf))


def q_scd2_history_hot(spark, sf):
    return _readable(users(spark, sf, FEW_ROWS))


def q_scd2_incremental(spark, sf):
    """A first load, then the later changes on top: the same history as in one go."""
    cdc = derived.users_cdc(spark, sf)
    early = F.col("last_updated_ts") < F.lit(CDC_SINCE).cast("timestamp_ntz")
    first = scd2.scd2_apply(None, cdc.filter(early))
    return _readable(scd2.scd2_apply(first, cdc.filter(~early)))


def q_scd2_changes(spark, sf):
    cdc = derived.users_cdc(spark, sf)
    early = F.col("last_updated_ts") < F.lit(CDC_SINCE).cast("timestamp_ntz")
    return scd2.scd2_changes(scd2.scd2_apply(None, cdc.filter(early)), cdc.filter(~early))


def q_row_hash(spark, sf):
    return derived.users_cdc(spark, sf).select("user_id", "last_updated_ts", row_hash().alias("row_hash"))


def q_surrogate_key(spark, sf):
    cdc = derived.users_cdc(spark, sf)
    key = surrogate_key(F.col("user_id"), F.col("last_updated_ts")).alias("user_surr_key")
    return cdc.select("user_id", F.col("last_updated_ts").alias("valid_from"), key)


def q_asof_plan_week(spark, sf):
    weeks = (
        dedup.type_events(raw(spark, sf), INGEST)
        .filter(F.col("user_id").isNotNull())
        .select("user_id", F.trunc("event_date", "week").alias("week_start_date"))
        .distinct()
    )
    return asof.attach_at_date(weeks, users(spark, sf), "week_start_date", ["current_plan", "status"])


def q_asof_plan_event(spark, sf, hot_rows=skew.MIN_HOT_ROWS):
    hot = hot_events(spark, sf, ["user_id"], hot_rows)
    placed = asof.attach_at_event(staged(spark, sf), users(spark, sf), ["current_plan", "status"], hot=hot)
    return placed.select("event_id", "user_id", "server_ts", "current_plan", "status")


def q_asof_plan_event_hot(spark, sf):
    return q_asof_plan_event(spark, sf, FEW_ROWS)


def q_watch_time_by_plan(spark, sf):
    return asof.watch_time_by_plan(facts(spark, sf), users(spark, sf), hot_events(spark, sf, ["user_id"]))


def q_device_link(spark, sf, hot_rows=skew.MIN_HOT_ROWS):
    linked = asof.link_devices(staged(spark, sf), hot_events(spark, sf, ["device_id"], hot_rows))
    return linked.select("event_id", "device_id", "user_id", "linked_user_id")


def q_device_link_hot(spark, sf):
    return q_device_link(spark, sf, FEW_ROWS)


def q_calendar_dim(spark, sf):
    typed = dedup.type_events(raw(spark, sf), INGEST)
    span = typed.agg(F.min("event_date").alias("first_day"), F.max(F.to_date("server_ts")).alias("last_day"))
    starts = derived.users_cdc(spark, sf).select(F.to_date("last_updated_ts").alias("full_date"))
    return dims.calendar_dim(span, holidays=starts)


def q_content_dim(spark, sf):
    return dims.content_dim(derived.content(spark, sf), INGEST)


# User days and scores


def q_user_day(spark, sf):
    return daily(spark, sf).drop("engagement_score")


def q_primary_platform(spark, sf):
    return user_day.primary_platform(sessions.session_facts(facts(spark, sf)))


def q_breadth(spark, sf):
    return user_day.breadth(staged(spark, sf), derived.content(spark, sf))


def q_engagement_score(spark, sf):
    days = tables.settle(daily(spark, sf))
    return score.engagement_score(days, users(spark, sf), span(days)[1])


def q_score_backfill(spark, sf):
    days = tables.settle(daily(spark, sf))
    return score.backfill_scores(days, users(spark, sf), *span(days))


def q_score_validation(spark, sf):
    days = tables.settle(scored_daily(spark, sf))
    return score.score_validation(days, users(spark, sf), span(days)[1])


# Marts and reports


def q_weekly_mart(spark, sf):
    return mart(spark, sf)


def q_weekly_mart_dormant(spark, sf):
    """Every week of the data, with the users that were absent in it."""
    dim = users(spark, sf)
    days = tables.settle(daily(spark, sf))
    return weekly.weekly_mart(scored(days, dim), dim, *span(days), include_dormant=True)


def _platform_days(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    titles = stored_titles(spark, sf)
    facts_by_session = tables.settle(sessions.session_facts(titles, is_folded=True))
    days = tables.settle(user_day.user_day(facts_by_session, titles, derived.content(spark, sf)))
    dim = users(spark, sf)
    scores = score.backfill_scores(days, dim, *span(days)).drop("plan_segment")
    per_platform = user_day.user_day_platform(facts_by_session)
    return weekly.attach_user_key(per_platform.join(scores, ["user_id", "activity_date"], "left"), dim), dim


def q_weekly_plan_platform(spark, sf):
    return weekly.weekly_plan_platform(*_platform_days(spark, sf))


def q_plan_platform_incremental(spark, sf):
    """A first load up to a date, then the weeks touched since merged in: the same table as in one go."""
    root = tables.scratch(spark)
    keyed, dim = _platform_days(spark, sf)
    days = tables.settle(keyed)
    start = F.lit(SECOND_LOAD).cast("date")
    tables.overwrite(weekly.weekly_plan_platform(days.filter(F.col("activity_date") < start), dim), root, MART_PLAN_PLATFORM)
    touched = weekly.weekly_plan_platform(weekly.affected_weeks(days, SECOND_LOAD[:10]), dim)
    recent = touched.filter(F.col("week_start_date") >= F.trunc(start, "week"))
    tables.upsert_table(recent, root, MART_PLAN_PLATFORM)
    return files.scan(spark, root, MART_PLAN_PLATFORM)


def q_exec_summary(spark, sf):
    return reports.executive_summary(stored_mart(spark, sf))


def q_segment_velocity(spark, sf):
    return reports.segment_velocity(stored_mart(spark, sf))


def q_at_risk_top100(spark, sf):
    return reports.at_risk_users(stored_mart(spark, sf))


def _in_order(report: DataFrame) -> DataFrame:
    """Position of each row of a sorted report, which has a row for each segment and plan: the driver reads them in order."""
    rows = [(i, *row) for i, row in enumerate(report.collect(), start=1)]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in report.schema)
    return report.sparkSession.createDataFrame(rows, f"position bigint, {kinds}")


def q_exec_summary_order(spark, sf):
    return _in_order(reports.executive_summary(stored_mart(spark, sf))).select("position", "segment", "plan", "avg_wow_change_pct")


def q_segment_velocity_order(spark, sf):
    return _in_order(reports.segment_velocity(stored_mart(spark, sf))).select("position", "segment", "plan", "avg_wow_change")


def q_score_validation_order(spark, sf):
    return _in_order(q_score_validation(spark, sf)).select("position", "plan_segment", "avg_score")


def q_report_csv(spark, sf):
    """Segment velocity exported as CSV and read back."""
    path = tables.scratch(spark)
    report = reports.segment_velocity(stored_mart(spark, sf))
    tables.export_csv(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


def q_freshness(spark, sf):
    return reports.freshness(raw(spark, sf), FRESH_NOW)


# Merges


def _loads(spark, sf) -> tuple[DataFrame, DataFrame]:
    events = raw(spark, sf)
    first = F.col("server_ts") < F.lit(SECOND_LOAD).cast("timestamp_ntz")
    return events.filter(first), events.filter(~first)


def q_upsert_latest(spark, sf):
    old, new = (dedup.latest_copy(part) for part in _loads(spark, sf))
    return upsert.upsert_newer(old, new, ["event_id"], "server_ts")


def q_upsert_all(spark, sf):
    old, new = (
        part.groupBy("device_id").agg(F.count(F.lit(1)).alias("events"), F.max("server_ts").alias("last_ts"))
        for part in _loads(spark, sf)
    )
    return upsert.upsert(old, new, ["device_id"])


def q_upsert_table(spark, sf):
    """Both loads through the stored table: late copies move rows between dates."""
    root = tables.scratch(spark)
    for part in _loads(spark, sf):
        tables.upsert_table(dedup.dedup_events(part, INGEST), root, STG_EVENTS, newer="server_ts")
    return files.scan(spark, root, STG_EVENTS)


def q_update_matched(spark, sf):
    days = tables.settle(daily(spark, sf))
    scores = score.engagement_score(days, users(spark, sf), span(days)[1])
    updated = upsert.update_matched(days, scores, FCT_DAILY.keys, ["engagement_score"])
    return updated.select("user_id", "activity_date", "total_watch_time_min", "engagement_score")


def q_replay_and_retain(spark, sf):
    """Drop a range of dates, replay it, then keep the last 30 days."""
    root = tables.scratch(spark)
    sessions_ = sessions.session_facts(stored_facts(spark, sf))
    tables.overwrite(sessions_, root, FCT_SESSIONS)
    tables.drop_days(spark, root, FCT_SESSIONS, LOOKBACK_DATE, LOOKBACK_DATE)
    tables.replace_days(files.within(sessions_, FCT_SESSIONS, LOOKBACK_DATE, LOOKBACK_DATE), root, FCT_SESSIONS)
    tables.retain(spark, root, FCT_SESSIONS, tables.stored_dates(spark, root, FCT_SESSIONS)[-1], 30)
    return files.scan(spark, root, FCT_SESSIONS)


def q_append_table(spark, sf):
    """Two loads appended one after the other."""
    root = tables.scratch(spark)
    days = tables.settle(sessions.session_facts(facts(spark, sf)))
    early = F.coalesce(F.col("session_date") < F.lit(LOOKBACK_DATE).cast("date"), F.lit(False))
    for part in (days.filter(early), days.filter(~early)):
        tables.append(part, root, FCT_SESSIONS)
    return files.scan(spark, root, FCT_SESSIONS)


def q_table_statistics(spark, sf):
    """Column statistics of the stored sessions: rows and nulls by column."""
    root, name = tables.scratch(spark), f"viewpulse_{uuid.uuid4().hex}"
    tables.overwrite(sessions.session_facts(facts(spark, sf)), root, FCT_SESSIONS)
    tables.register(spark, root, FCT_SESSIONS, name)
    tables.analyze(spark, name)
    found = []
    for column in FCT_SESSIONS.columns:
        info = dict(tuple(r)[:2] for r in spark.sql(f"DESCRIBE EXTENDED {name} {column}").collect())
        found.append((column, int(info["num_nulls"])))
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(found, "column_name string, num_nulls bigint")


def q_clustered_layout(spark, sf):
    """Sessions rewritten in clustered order; the rows stay the same."""
    root = tables.scratch(spark)
    tables.overwrite(sessions.session_facts(facts(spark, sf)), root, FCT_SESSIONS)
    tables.optimize(spark, root, FCT_SESSIONS)
    return files.scan(spark, root, FCT_SESSIONS)


def q_interleaved_layout(spark, sf):
    """Playback facts rewritten by date and the interleaved ranks of user and title; the rows stay the same."""
    root = tables.scratch(spark)
    tables.overwrite(facts(spark, sf), root, FCT_PLAYBACK)
    tables.optimize(spark, root, FCT_PLAYBACK)
    return files.scan(spark, root, FCT_PLAYBACK)


# Nights


def q_nightly_late_data(spark, sf):
    """Two nights over a lake, whose raw files are dated by arrival. Events come up to three days late, and some that arrive
    in the second night had come in the first, a day earlier and under another owner. Weeks equal those of one load."""
    root = tables.scratch(spark)
    events = tables.settle(raw(spark, sf).withColumn("event_date", F.to_date("server_ts")))
    first, last = events.agg(F.min("event_date"), F.max("event_date")).first()
    ends = [back(first, -((last - first).days // 2)), last]
    moved = (F.col("event_date") > F.lit(ends[0])) & (F.pmod(F.xxhash64("event_id"), F.lit(40)) == 0)
    before = F.lit(f"{ends[0]} 23:00:00").cast("timestamp_ntz")
    early = events.filter(moved).withColumns(
        {"user_id": F.lit("usr_0"), "event_ts": F.col("event_ts") - F.expr("INTERVAL 1 DAY"), "server_ts": before, "event_date": F.lit(ends[0])}
    )
    events.unionByName(early).hint("rebalance", F.col("event_date")).write.partitionBy("event_date").json(f"{root}/{RAW_EVENTS.path}", compression=JSON_CODEC)
    derived.users_cdc(spark, sf).write.parquet(f"{root}/{RAW_USERS.path}")
    derived.content(spark, sf).write.parquet(f"{root}/{RAW_CONTENT.path}")
    app = derived.app_sessions(spark, sf).withColumn("session_date", F.to_date("session_start_ts"))
    app.hint("rebalance", F.col("session_date")).write.partitionBy("session_date").parquet(f"{root}/{RAW_SESSIONS.path}")
    for since, end in zip([first, *[back(e, -1) for e in ends]], ends, strict=False):
        nightly.run_night(nightly.Night(spark, root, end, INGEST, gate=False, since=since))
    days = tables.stored_dates(spark, root, FCT_DAILY)
    # The other queries score every day as a run of each night leaves it; there were two runs here.
    nightly.backfill(nightly.Night(spark, root, days[-1], INGEST, gate=False), days[0])
    return files.scan(spark, root, MART_WEEKLY)


# Quality


def q_dq_events(spark, sf):
    return quality.check_suite(facts(spark, sf), quality.event_rules())


def q_gate_events(spark, sf):
    """What the gate makes of each rule."""
    rules = quality.event_rules()
    return quality.gate_report(quality.check_suite(facts(spark, sf), rules), rules)


def q_dq_daily(spark, sf):
    return quality.check_suite(scored_daily(spark, sf), quality.daily_rules())


def q_dq_plan_platform(spark, sf):
    return quality.check_suite(q_weekly_plan_platform(spark, sf), quality.plan_platform_rules(PLANS))


# Streams


class Feed:
    """The raw events as JSON files in a landing folder, delivered in slices of time up to a day late, and streams over them."""

    def __init__(self, spark: SparkSession, sf: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.root = spark, tables.scratch(spark)
        self.path = f"{self.root}/landing"
        fs, path = tables.folder(spark, self.path)
        fs.mkdirs(path)
        events = raw(spark, sf).select(*LIVE_EVENTS.columns[:-1])
        late = F.pmod(F.xxhash64("event_id", "server_ts"), F.lit(LATE_SECONDS))
        events = tables.settle(events.withColumn("_at", epoch_seconds(F.col("server_ts")) + late))
        first, last = events.agg(F.min("_at"), F.max("_at")).first()
        self.events, self.first, self.step = events, first or 0, ((last or 0) - (first or 0)) // SLICES + 1

    def stream(self) -> DataFrame:
        return live.event_stream(self.spark, self.path)

    def run(self, *starts: Callable) -> None:
        """Land a slice, run each stream over what is new, and so on: a restart with every slice."""
        for k in range(SLICES):
            due = F.floor((F.col("_at") - self.first) / self.step) == k
            live.zoned(self.events.filter(due).drop("_at")).write.mode("append").json(self.path, compression=JSON_CODEC)
            for start in starts:
                start().awaitTermination()

    def close(self, now: str = CLOSING) -> None:
        """A last event far behind all others: it moves the watermark past every open window."""
        last = self.spark.range(1).select(
            F.lit("closing").alias("event_id"), F.lit("closing").alias("user_id"), F.lit("heartbeat").alias("event_type"), F.lit("none").alias("platform"),
            F.lit(now).cast("timestamp").alias("event_ts"), F.lit(now).cast("timestamp").alias("server_ts"),
        )
        last.write.mode("append").json(self.path, compression=JSON_CODEC)

    def appending(self, result: DataFrame, name: str) -> Callable:
        """Starts an append-mode run of `result`."""
        out = f"{self.root}/{name}"
        return lambda: live.append_to(result, out, f"{out}-checkpoint", availableNow=True)

    def appended(self, result: DataFrame, name: str) -> DataFrame:
        return live.unzoned(self.spark.read.schema(result.schema).parquet(f"{self.root}/{name}"))


def _latest(df: DataFrame) -> DataFrame:
    return dedup.latest_copy(live.unzoned(df))


def _latest_table(spark: SparkSession, sf: str) -> DataFrame:
    """The log of the batches, compacted while they come in, as its readers see it."""
    feed = Feed(spark, sf)
    out = f"{feed.root}/{LIVE_EVENTS.path}"
    events = feed.stream().withColumn("event_date", F.to_date("event_ts")).select(*LIVE_EVENTS.columns)

    def start():
        log.compact(spark, out, LIVE_EVENTS.schema, _latest, fan_in=2)
        return log.append(events, out, f"{out}-checkpoint", _latest, availableNow=True)

    feed.run(start)
    return log.read(spark, out, LIVE_EVENTS.schema, _latest)


def q_stream_dedup(spark, sf):
    return _latest_table(spark, sf)


def q_stream_concurrent_viewers(spark, sf):
    return live.unzoned(live.concurrent_viewers(_latest_table(spark, sf)))


def q_live_recent_viewers(spark, sf):
    """The five minutes up to the last viewing before LIVE_BEFORE; later events are there, too."""
    events = raw(spark, sf)
    seen = live.viewing(events).filter(F.col("user_id").isNotNull() & (F.col("server_ts") < F.lit(LIVE_BEFORE).cast("timestamp_ntz")))
    now = seen.agg(F.max("server_ts")).first()[0]
    return live.unzoned(live.concurrent_viewers(live.recent_latest(events, now)))


def _counted(marks: DataFrame) -> DataFrame:
    return marks.groupBy("platform", "minute").agg(F.count("user_id").alias("concurrent_viewers"))


def q_stream_viewer_marks(spark, sf):
    feed = Feed(spark, sf)
    marks = live.viewer_marks(feed.stream())
    feed.run(feed.appending(marks, "marks"))
    return _counted(feed.appended(marks, "marks"))


def q_stream_approx_viewers(spark, sf):
    """Viewers per minute, and whether the sketch is within three times its error of 5 %, or one viewer."""
    feed = Feed(spark, sf)
    marks, approx = live.viewer_marks(feed.stream()), live.approx_viewers(feed.stream())
    counting = feed.appending(approx, "approx")
    feed.run(feed.appending(marks, "marks"), counting)
    feed.close()
    counting().awaitTermination()
    exact = _counted(feed.appended(marks, "marks"))
    about = feed.appended(approx, "approx").select("platform", "minute", F.col("concurrent_viewers").alias("about"))
    off = F.abs(F.col("about") - F.col("concurrent_viewers"))
    within = F.coalesce(off <= F.greatest(F.lit(1.0), 0.15 * F.col("concurrent_viewers")), F.lit(False))
    joined = exact.join(about, ["platform", "minute"], "full")
    return joined.filter("platform <> 'none'").select("platform", "minute", "concurrent_viewers", within.alias("within_error"))


def q_viewers_rollup(spark, sf):
    """Viewers per hour, day and week, and whether the stored minutes' sketches roll up to them within three standard errors."""
    feed = Feed(spark, sf)
    out = f"{feed.root}/sketches"
    events = feed.stream().select("platform", "event_type", "user_id", "server_ts")

    def start():
        log.compact(spark, out, sketches.SKETCHES, sketches.united, fan_in=2)
        return log.append(events, out, f"{out}-checkpoint", lambda batch: sketches.minute_sketches(live.unzoned(batch)), availableNow=True)

    feed.run(start)
    rolled = sketches.roll_up(log.read(spark, out, sketches.SKETCHES, sketches.united))
    exact = sketches.exact_viewers(feed.events)
    off = F.abs(F.col("about") - F.col("viewers"))
    within = F.coalesce(off <= F.greatest(F.lit(1.0), sketches.ERROR * F.col("viewers")), F.lit(False))
    return exact.join(rolled, ["unit", "platform", "start"], "full").select("unit", "platform", "start", "viewers", within.alias("within_error"))


def q_stream_sessions(spark, sf):
    """Sessions of devices' users by inactivity, from JSON files over several batches and restarts, in append mode."""
    feed = Feed(spark, sf)
    found = live.session_windows(feed.stream(), "user_id", "server_ts")
    closed = feed.appending(found, "sessions")
    feed.run(closed)
    feed.close()
    closed().awaitTermination()
    return feed.appended(found, "sessions").filter("user_id IS NULL OR user_id <> 'closing'")


def q_stream_session_window(spark, sf):
    """The given events in append mode; the last sessions are let out by a closing event."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    root = tables.scratch(spark)
    events = derived.given(spark, sf, "events").select("user_id", "ts")
    live.zoned(events).write.parquet(f"{root}/landing")
    stream = spark.readStream.schema(live.zoned(events).schema).parquet(f"{root}/landing")
    found = live.session_windows(stream, "user_id", "ts")
    for closing in (False, True):
        if closing:
            last = spark.range(1).select(F.lit(None).cast(events.schema["user_id"].dataType).alias("user_id"), F.lit(CLOSING).cast("timestamp").alias("ts"))
            last.write.mode("append").parquet(f"{root}/landing")
        live.append_to(found, f"{root}/sessions", f"{root}/checkpoint", availableNow=True).awaitTermination()
    return live.unzoned(spark.read.schema(found.schema).parquet(f"{root}/sessions"))


def weekly_minutes(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: weekly active watch time per user."""
    return (
        daily(spark, sf)
        .groupBy("user_id", F.trunc("activity_date", "week").alias("week_start_date"))
        .agg(F.sum("total_watch_time_min").alias("total_watch_time_min"))
    )


def all_queries() -> dict[str, Query]:
    found = {n[2:]: f for n, f in globals().items() if n.startswith("q_")}
    found["weekly_minutes"] = weekly_minutes
    return {n: _plainly(f) for n, f in found.items()}


def _plainly(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(query(spark, sf_dir))

    return run
