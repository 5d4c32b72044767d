"""The whole chain on the published fixture, against its published totals."""

from __future__ import annotations

import fixture_recipe as recipe
import pytest
from pyspark.sql import functions as F

from viewpulse.operators import dedup, scd2, sessions, user_day, watch, weekly
from viewpulse.sources import derived, tables


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_published_totals(spark, scale):
    sf = f"/root/testdata/{scale}"
    want = recipe.EXPECTED[scale]
    given = {n: derived.given(spark, sf, n) for n in ("lineitem", "orders", "customer")}
    raw = tables.settle(spark.sql(recipe.PLAYBACK, lineitem=given["lineitem"], orders=given["orders"]))
    content = derived.content(spark, sf).filter(recipe.CONTENT_LIMIT)
    cdc = spark.sql(recipe.USERS_CDC, customer=given["customer"])

    staged = tables.settle(dedup.dedup_events(raw, "2024-02-12 00:00:00"))
    timed = tables.settle(watch.watch_time(staged))
    facts = tables.settle(watch.playback_facts(staged, content))
    across = watch.watch_time(staged, across_days=True)
    got = {
        "rows": raw.count(),
        "null_users": raw.filter("user_id IS NULL").count(),
        "deduped": staged.count(),
        "late": staged.filter("is_late_arrival").count(),
        "watch": timed.agg(F.sum("watch_time_sec")).first()[0],
        "capped": facts.agg(F.sum("watch_time_sec")).first()[0],
        "over_before": timed.filter("watch_time_sec > 300").count(),
        "over_after": facts.filter("watch_time_sec > 300").count(),
        "across": across.agg(F.sum("watch_time_sec")).first()[0],
        "across_capped": watch.cap_vod(across, content).agg(F.sum("watch_time_sec")).first()[0],
    }
    assert content.count() == 200
    before = timed.select("event_id", F.col("watch_time_sec").alias("w"))
    got["lowered"] = facts.join(before, "event_id").filter("watch_time_sec < w").count()
    groups = staged.select("event_date", "session_id", "content_id").distinct().count()
    got["last_events"] = groups

    daily = tables.settle(user_day.user_day(sessions.session_facts(facts), facts, content))
    dim = tables.settle(scd2.scd2_apply(None, cdc))
    mart = tables.settle(weekly.weekly_mart(daily, dim))
    got |= {
        "user_days": daily.count(),
        "minutes": str(daily.agg(F.sum("total_watch_time_min")).first()[0]),
        "user_weeks": mart.count(),
        "segments": {r[0]: r[1] for r in mart.groupBy("segment").count().collect()},
        "trends": {r[0]: r[1] for r in mart.groupBy("engagement_trend").count().collect()},
        "cdc": cdc.count(),
        "dim": dim.count(),
        "app_sessions": derived.derive(spark, derived.APP_SESSIONS, playback_events=raw).count(),
    }
    assert got == want
