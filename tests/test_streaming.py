"""Streams over several batches against the batch result."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from viewpulse.operators import dedup, sessions
from viewpulse.plans import queries
from viewpulse.schemas import LIVE_EVENTS
from viewpulse.sources import derived, files, tables
from viewpulse.streaming import live, log, sketches

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """Events as JSON files in delivery order, which is not time order, with copies in different files."""
    folder = tmp_path_factory.mktemp("feed")
    rows = derived.playback_events(spark, SF).filter("server_ts < '2024-01-08'")
    rows = tables.settle(rows.select(*LIVE_EVENTS.columns[:-1]))
    parts = rows.withColumn("_file", F.pmod(F.xxhash64("content_id", "server_ts"), F.lit(4)))
    for i in range(4):
        lines = [r[0] for r in parts.filter(F.col("_file") == i).drop("_file").select(F.to_json(F.struct("*"))).collect()]
        (folder / f"part{i}.json").write_text("\n".join(lines) + "\n")
    return str(folder), rows


def test_feed_is_typed(spark, feed):
    stream = live.event_stream(spark, feed[0])
    assert stream.isStreaming
    assert dict(stream.dtypes)["server_ts"] == "timestamp" and len(stream.columns) == 7
    message = spark.createDataFrame([(json.dumps({"event_id": "a", "server_ts": "2024-01-01T00:00:00Z"}),)], "value string")
    parsed = live.parse_events(message).first()
    assert parsed.event_id == "a" and parsed.server_ts.year == 2024


@pytest.mark.parametrize("match_days", [None, 10])
def test_latest_copy_over_batches(spark, feed, tmp_path, match_days):
    root = str(tmp_path)
    stream = live.event_stream(spark, feed[0], files_per_trigger=1).withColumn("event_date", F.to_date("event_ts"))
    for _ in range(2):  # the second start finds nothing new
        live.maintain_latest(stream, root, LIVE_EVENTS, f"{root}/cp", match_days, availableNow=True).awaitTermination()
    got = files.scan(spark, root, LIVE_EVENTS)
    want = dedup.latest_copy(feed[1]).withColumn("event_date", F.to_date("event_ts")).select(*LIVE_EVENTS.columns)
    assert got.count() == want.count() < feed[1].count()
    assert got.exceptAll(want).isEmpty()


def test_viewer_marks_count_exactly(spark, feed, tmp_path):
    out = str(tmp_path / "marks")
    marks = live.viewer_marks(live.event_stream(spark, feed[0], files_per_trigger=1), horizon="30 days")
    live.append_to(marks, out, f"{out}-cp", availableNow=True).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.count() == stored.distinct().count()
    got = live.unzoned(stored.groupBy("platform", "minute").agg(F.count("user_id").alias("concurrent_viewers")))
    want = live.unzoned(live.concurrent_viewers(live.zoned(feed[1])))
    assert got.exceptAll(want.select(*got.columns)).isEmpty() and got.count() == want.count()


def test_approximate_viewers(spark, feed, tmp_path):
    out = str(tmp_path / "approx")
    counts = live.approx_viewers(live.event_stream(spark, feed[0], files_per_trigger=2))
    live.publish(counts, out, f"{out}-cp", availableNow=True).awaitTermination()
    assert live.published(spark, out, counts.schema).agg(F.max("concurrent_viewers")).first()[0] >= 1


def test_session_windows_equal_the_batch(spark, feed, tmp_path):
    out = str(tmp_path / "sessions")
    stream = live.event_stream(spark, feed[0], files_per_trigger=2)
    windows = live.session_windows(stream, "user_id", "server_ts")
    live.publish(windows, out, f"{out}-cp", availableNow=True).awaitTermination()
    got = live.unzoned(live.published(spark, out, windows.schema)).select("user_id", "session_start_ts", "session_end_ts", "event_count")
    want = sessions.gap_sessions(feed[1], ["user_id"], "server_ts").select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_recent_filter_commutes_with_latest_copy(feed):
    now = "2024-01-05 12:00:00"
    early = live.recent_latest(feed[1], now)
    known = feed[1].filter(F.col("server_ts") <= F.lit(now).cast("timestamp_ntz"))
    late = live.recent(dedup.latest_copy(known), now)
    assert early.exceptAll(late).isEmpty() and late.exceptAll(early).isEmpty() and early.count() > 0
    assert early.filter(F.col("server_ts") > F.lit(now).cast("timestamp_ntz")).isEmpty()


def test_sessions_in_append_mode_need_the_watermark_to_pass(spark, feed, tmp_path):
    out = str(tmp_path / "closed")
    closing = {"event_id": "end", "user_id": "closing", "event_ts": "2024-03-01T00:00:00Z", "server_ts": "2024-03-01T00:00:00Z"}
    folder = tmp_path / "feed"
    folder.mkdir()
    for i in range(4):
        (folder / f"part{i}.json").write_text(Path(feed[0], f"part{i}.json").read_text())
    (folder / "part9.json").write_text(json.dumps(closing) + "\n")
    windows = live.session_windows(live.event_stream(spark, str(folder)), "user_id", "server_ts")
    live.append_to(windows, out, f"{out}-cp", availableNow=True).awaitTermination()
    got = live.unzoned(spark.read.parquet(out)).select("user_id", "session_start_ts", "session_end_ts", "event_count")
    want = sessions.gap_sessions(feed[1], ["user_id"], "server_ts").select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


# The log


def latest(df):
    return dedup.latest_copy(live.unzoned(df))


def log_rows(spark, root):
    return sorted(map(repr, log.read(spark, root, LIVE_EVENTS.schema, latest).collect()))


@pytest.fixture
def logged(spark, feed, tmp_path):
    """Eight batches, with copies of an event whose dates lie weeks apart, each a run."""
    folder, root = tmp_path / "landing", str(tmp_path / "log")
    folder.mkdir()
    rows = feed[1].withColumn("event_date", F.to_date("event_ts"))
    far = rows.limit(40).withColumns({c: F.col(c) + F.expr("INTERVAL 21 DAYS") for c in ("event_ts", "server_ts")})
    every = tables.settle(rows.union(far.withColumn("event_date", F.to_date("event_ts"))).select(*LIVE_EVENTS.columns))
    stream = live.event_stream(spark, str(folder)).withColumn("event_date", F.to_date("event_ts")).select(*LIVE_EVENTS.columns)
    for k in range(8):
        own = every.filter(F.pmod(F.xxhash64("content_id", "server_ts"), F.lit(8)) == k).drop("event_date")
        live.zoned(own).write.mode("append").json(str(folder))
        log.append(stream, root, f"{root}-cp", latest, availableNow=True).awaitTermination()
    return root, sorted(map(repr, dedup.latest_copy(every).collect()))


def test_the_log_keeps_the_latest_copy_however_far_apart(spark, logged):
    root, want = logged
    assert log.runs(spark, root) == [(k, k) for k in range(8)]
    assert log_rows(spark, root) == want
    files = {p: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}
    assert log.compact(spark, root, LIVE_EVENTS.schema, latest, fan_in=4) == 2
    # Nothing that was there is rewritten, and readers of the old runs can end.
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    assert log.visible(log.runs(spark, root)) == [(0, 3), (4, 7)]
    assert log_rows(spark, root) == want
    assert log.compact(spark, root, LIVE_EVENTS.schema, latest, fan_in=2) == 1
    assert log.runs(spark, root) == [(0, 3), (0, 7), (4, 7)] and log_rows(spark, root) == want


def test_a_compaction_lost_half_way_is_not_seen_and_made_again(spark, logged):
    root, want = logged
    half = log._path(root, (0, 3))
    log._read(spark, root, [(2, 2)], LIVE_EVENTS.schema).write.parquet(half)
    Path(half, "_SUCCESS").unlink()
    assert log.visible(log.runs(spark, root)) == [(k, k) for k in range(8)] and log_rows(spark, root) == want
    assert log.compact(spark, root, LIVE_EVENTS.schema, latest, fan_in=4) == 2
    assert log_rows(spark, root) == want
    # A batch that is delivered again after its run was merged changes nothing.
    log._read(spark, root, [(2, 2)], LIVE_EVENTS.schema).write.mode("overwrite").parquet(log._path(root, (2, 2)) + "-again")
    assert log_rows(spark, root) == want


def test_runs_are_rewritten_as_often_as_their_number_has_digits():
    seen, written = [], 0
    for batch in range(512):
        seen.append((batch, batch))
        while some := log.mergeable(seen, 8):
            at = seen.index(some[0])
            seen[at : at + 8] = [(some[0][0], some[-1][1])]
            written += some[-1][1] - some[0][0] + 1
    assert seen == [(0, 511)] and written == 3 * 512


def test_an_empty_log_has_no_rows(spark, tmp_path):
    assert log.read(spark, str(tmp_path / "none"), LIVE_EVENTS.schema, latest).count() == 0
    assert log.compact(spark, str(tmp_path / "none"), LIVE_EVENTS.schema, latest) == 0


def test_sketches_unite_without_the_events(spark):
    views = spark.range(60_000).select(
        F.lit("tv").alias("platform"), F.lit("heartbeat").alias("event_type"), (F.col("id") % 20_000).cast("string").alias("user_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") % 7200)).alias("server_ts"),
    )
    parts = [sketches.minute_sketches(views.filter(F.col("user_id") % 2 == k)) for k in (0, 1, 1)]
    stored = tables.settle(sketches.united(parts[0].union(parts[1]).union(parts[2])))
    about = {(r.unit, str(r.start)): r.about for r in sketches.roll_up(stored).collect()}
    assert set(about) == {("hour", "2024-01-01 00:00:00"), ("hour", "2024-01-01 01:00:00"), ("day", "2024-01-01 00:00:00"), ("week", "2024-01-01 00:00:00")}
    for r in sketches.exact_viewers(views).collect():
        assert abs(about[r.unit, str(r.start)] - r.viewers) <= sketches.ERROR * r.viewers


def test_the_feed_lands_compressed_lines_and_loses_none(spark, tmp_path):
    """Plain JSON lines were most of what a stream's query wrote."""
    spark.range(400).selectExpr("id div 4 AS l_orderkey", "id % 4 AS l_linenumber", "id % 90 AS l_partkey", "1.0D AS l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(100).selectExpr("id AS o_orderkey", "id % 60 AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(90).selectExpr("id AS p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    feed = queries.Feed(spark, str(tmp_path))
    feed.run()
    feed.close()
    landed = [p.name for p in Path(feed.path).glob("part-*")]
    assert landed and all(n.endswith(".json.gz") for n in landed)
    assert spark.read.json(feed.path).count() == 401
