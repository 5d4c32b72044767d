"""The published fixture recipe with its known totals (FIXTURES.md): a bounded set of users and titles."""

PLAYBACK = """
SELECT 'evt_'||l_orderkey||'_'||l_linenumber AS event_id,
 CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE 'usr_'||(o_custkey % 400) END AS user_id,
 'dev_'||(o_custkey % 150) AS device_id, 'sess_'||l_orderkey AS session_id,
 'cnt_'||((l_orderkey + CAST(l_linenumber > 3 AS INT)) % 200) AS content_id,
 CASE (l_partkey + l_linenumber) % 8 WHEN 0 THEN 'play_start' WHEN 1 THEN 'pause' WHEN 2 THEN 'seek'
   WHEN 3 THEN 'play_end' WHEN 4 THEN 'error' ELSE 'heartbeat' END AS event_type,
 sts - INTERVAL '1' SECOND * CAST(CASE WHEN l_partkey % 40 = 0 THEN 259200 ELSE l_partkey % 3600 END AS INT) AS event_ts,
 sts AS server_ts, CAST(l_partkey % 7200 AS INT) AS position_sec,
 CASE l_orderkey % 5 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' WHEN 2 THEN 'web' WHEN 3 THEN 'tv' ELSE 'firetv' END AS platform,
 CASE o_custkey % 5 WHEN 0 THEN 'PK' WHEN 1 THEN 'US' WHEN 2 THEN 'GB' WHEN 3 THEN 'IN' ELSE 'AE' END AS country_code
FROM (SELECT l.*, o.o_custkey, CAST('2024-01-01 00:00:00' AS TIMESTAMP_NTZ) + INTERVAL '1' SECOND * CAST(
        (l_orderkey % 42) * 86400 + (l_orderkey * 7919) % 86400 + l_linenumber * 200 + CAST(l_quantity AS INT) * 8 AS INT) AS sts
      FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey) x
"""

USERS_CDC = """
SELECT 'usr_'||c_custkey AS user_id, CAST('2023-01-01 00:00:00' AS TIMESTAMP_NTZ) + INTERVAL '1' DAY * CAST(c_custkey % 300 AS INT)
 AS signup_ts, CASE c_custkey % 3 WHEN 0 THEN 'organic' WHEN 1 THEN 'ads' ELSE NULL END AS signup_source,
 CASE c_custkey % 5 WHEN 0 THEN 'PK' WHEN 1 THEN 'US' WHEN 2 THEN 'GB' WHEN 3 THEN 'IN' ELSE 'AE' END AS country_code,
 CASE (CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 0 WHEN 'MACHINERY' THEN 1 WHEN 'FURNITURE' THEN 2 ELSE 3 END + bump) % 4
   WHEN 0 THEN 'free' WHEN 1 THEN 'basic' WHEN 2 THEN 'premium' ELSE 'trial' END AS current_plan,
 CASE WHEN bump = 1 THEN CAST('2024-01-18 09:00:00' AS TIMESTAMP_NTZ) ELSE CAST('2023-12-01 00:00:00' AS TIMESTAMP_NTZ) END
   AS plan_started_ts,
 CASE WHEN ver = 3 AND c_custkey % 10 = 0 THEN 'cancelled' ELSE 'active' END AS status, CAST(lu AS TIMESTAMP_NTZ) AS last_updated_ts
FROM (SELECT c.*, v.ver, v.lu, CASE WHEN v.ver >= 2 AND c.c_custkey % 4 = 0 THEN 1 ELSE 0 END AS bump
      FROM {customer} c CROSS JOIN (VALUES (1,'2023-12-01 00:00:00'),(2,'2024-01-18 09:00:00'),(3,'2024-02-01 00:00:00')) AS v(ver, lu)) x
WHERE c_custkey < 400 AND c_custkey % 50 <> 49
 AND (ver = 1 OR (ver = 2 AND c_custkey % 4 = 0) OR (ver = 3 AND c_custkey % 10 IN (0, 1)))
"""

CONTENT_LIMIT = "content_id IN (SELECT 'cnt_'||id FROM range(200))"

EXPECTED = {
    "sf0.001": {
        "rows": 6000, "null_users": 943, "deduped": 4599, "late": 128, "watch": 349_654, "capped": 325_464, "lowered": 222,
        "over_before": 76, "over_after": 60, "last_events": 2685, "across": 356_104, "across_capped": 331_156,
        "user_days": 1192, "minutes": "4547.46", "user_weeks": 619,
        "segments": {"Power User": 5, "Regular": 141, "Casual": 473},
        "trends": {"At Risk": 168, "Declining": 18, "Growing": 12, "Stable": 223, "Surging": 198},
        "cdc": 215, "dim": 200, "app_sessions": 1473,
    },
    "sf0.01": {
        "rows": 60_000, "null_users": 8571, "deduped": 45_832, "late": 1160, "watch": 3_446_496, "capped": 3_312_044,
        "lowered": 1046, "over_before": 654, "over_after": 574, "last_events": 26_798, "across": 3_523_422,
        "across_capped": 3_384_222, "user_days": 9264, "minutes": "47386.49", "user_weeks": 2456,
        "segments": {"Power User": 809, "Regular": 1153, "Casual": 494},
        "trends": {"At Risk": 790, "Declining": 151, "Growing": 131, "Stable": 499, "Surging": 885},
        "cdc": 572, "dim": 532, "app_sessions": 14_743,
    },
}
