"""Playback inputs derived from the given TPC-H-like tables, over their whole length.

The text is plain SQL that Spark and DuckDB both run, so the correctness oracles use the same inputs. Accounts group four
customers (devices), change rows are the customers themselves, titles are the parts. (l_orderkey, l_linenumber) repeats,
which gives real duplicate event ids; sessions may cross midnight, change platform, or be anonymous; guests have no
user record. Lines and orders are joined by shuffle at every size, as they are where neither fits a task's memory; one file
of one row group would else be derived by one task. The join is cut by the number of lines: its narrow inputs, packed by their
bytes, would put millions of rows into a task, which become ten times as wide there and are sorted by what reads them. The
shuffles of what is derived start with as many partitions, as Spark's number for them does not follow the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PLAYBACK = """
SELECT 'evt_'||l_orderkey||'_'||l_linenumber AS event_id,
 CASE WHEN l_orderkey % 7 = 3 THEN NULL WHEN o_custkey % 50 = 49 THEN 'gst_'||o_custkey
   ELSE 'usr_'||(o_custkey - o_custkey % 4) END AS user_id,
 'dev_'||o_custkey AS device_id, 'sess_'||l_orderkey AS session_id,
 'cnt_'||((l_orderkey * 31 + CAST(l_linenumber > 3 AS INT)) % (SELECT max(p_partkey) + 1 FROM {part})) AS content_id,
 CASE (l_partkey + l_linenumber) % 8 WHEN 0 THEN 'play_start' WHEN 1 THEN 'pause' WHEN 2 THEN 'seek'
   WHEN 3 THEN 'play_end' WHEN 4 THEN 'error' ELSE 'heartbeat' END AS event_type,
 sts - INTERVAL '1' SECOND * CAST(CASE WHEN l_partkey % 40 = 0 THEN 259200 ELSE l_partkey % 3600 END AS INT) AS event_ts,
 sts AS server_ts, CAST(l_partkey % 7200 AS INT) AS position_sec,
 CASE (l_orderkey + CAST(l_linenumber > 4 AS INT)) % 5 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' WHEN 2 THEN 'web'
   WHEN 3 THEN 'tv' ELSE 'firetv' END AS platform,
 CASE o_custkey % 5 WHEN 0 THEN 'PK' WHEN 1 THEN 'US' WHEN 2 THEN 'GB' WHEN 3 THEN 'IN' ELSE 'AE' END AS country_code
FROM (SELECT /*+ MERGE(l, o) */ l_orderkey, l_linenumber, l_partkey, o_custkey,
        CAST('2024-01-01 00:00:00' AS {TS}) + INTERVAL '1' SECOND * CAST(
          (l_orderkey % 41) * 86400 + (l_orderkey * 7919) % 86400 + l_linenumber * 200 + CAST(l_quantity AS INT) * 8 AS INT) AS sts
      FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey) x
"""

CONTENT = """
SELECT 'cnt_'||p_partkey AS content_id, p_name AS title,
 CASE p_type WHEN 'ECONOMY' THEN 'vod_movie' WHEN 'SMALL' THEN 'vod_series_ep' WHEN 'MEDIUM' THEN 'highlight' ELSE 'live'
   END AS content_type,
 p_brand AS genre, CASE p_partkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'ur' ELSE 'hi' END AS language,
 CAST(CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_size * 20 END AS INT) AS duration_sec, p_size > 25 AS is_premium,
 CAST('2023-06-01 00:00:00' AS {TS}) + INTERVAL '1' DAY * CAST(p_partkey % 180 AS INT) AS publish_ts
FROM {part}
"""

USERS_CDC = """
SELECT 'usr_'||u AS user_id, CAST('2023-01-01 00:00:00' AS {TS}) + INTERVAL '1' DAY * CAST(u % 300 AS INT) AS signup_ts,
 CASE u % 3 WHEN 0 THEN 'organic' WHEN 1 THEN 'ads' ELSE NULL END AS signup_source,
 CASE u % 5 WHEN 0 THEN 'PK' WHEN 1 THEN 'US' WHEN 2 THEN 'GB' WHEN 3 THEN 'IN' ELSE 'AE' END AS country_code,
 CASE plan_no WHEN 0 THEN 'free' WHEN 1 THEN 'basic' WHEN 2 THEN 'premium' ELSE 'trial' END AS current_plan,
 CAST('2023-11-01 00:00:00' AS {TS}) + INTERVAL '1' DAY * plan_no AS plan_started_ts,
 CASE WHEN v >= 2 AND u % 5 = 0 THEN 'cancelled' ELSE 'active' END AS status,
 CAST(CASE v WHEN 0 THEN '2023-12-01 00:00:00' WHEN 1 THEN '2024-01-18 09:00:00' WHEN 2 THEN '2024-02-01 00:00:00'
   ELSE '2024-02-05 00:00:00' END AS {TS}) AS last_updated_ts
FROM (SELECT c_custkey - c_custkey % 4 AS u, c_custkey % 4 AS v,
        CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 0 WHEN 'MACHINERY' THEN 1 WHEN 'FURNITURE' THEN 2 ELSE 3 END AS plan_no
      FROM {customer}) x
"""

APP_SESSIONS = """
SELECT session_id, max(user_id) AS user_id, max(device_id) AS device_id, min(server_ts) - INTERVAL '5' SECOND AS session_start_ts,
 max(server_ts) + INTERVAL '30' SECOND AS session_end_ts, max(platform) AS platform
FROM {playback_events} GROUP BY session_id
"""



_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
#: Lines that one task joins and widens.
TASK_LINES = 500_000
#: Partitions a shuffle starts with, where Spark may join them at run time, and shuffled bytes up to which it does: compressed
#: events become twenty times as large where they are sorted or grouped.
INITIAL, JOINED = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
JOINED_BYTES = "16m"


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    return spark.sql(text.replace("{TS}", "TIMESTAMP_NTZ"), **frames)


def widen_shuffles(spark: SparkSession, parts: int) -> None:
    """Let the session's shuffles start with at least `parts` partitions, so that a window's sort does not grow with the table.

    Small partitions are joined again at run time, so tables of any size may follow. The number is raised, never lowered, and a
    size of joined partitions that the session was given holds. With adaptive execution or its joining of partitions switched
    off, Spark's fixed number holds as before. Results do not depend on either.
    """
    if int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions")) < parts:
        spark.conf.set(INITIAL, parts)
    if parts > spark.sparkContext.defaultParallelism and not spark.conf.get(JOINED, None):
        spark.conf.set(JOINED, JOINED_BYTES)


def playback_events(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Raw events; `lineitem` may be a stream of the same rows."""
    orders, lines = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), lineitem
    if lines is None:
        lines = given(spark, sf_dir, "lineitem").select(*_LINE)
        # Counted from the footers of the files.
        wanted = -(-lines.count() // TASK_LINES)
        parts = max(spark.sparkContext.defaultParallelism, wanted)
        widen_shuffles(spark, wanted)
        lines, orders = lines.repartition(parts, "l_orderkey"), orders.repartition(parts, "o_orderkey")
    return derive(spark, PLAYBACK, lineitem=lines, orders=orders, part=given(spark, sf_dir, "part"))


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, CONTENT, part=given(spark, sf_dir, "part"))


def users_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, USERS_CDC, customer=given(spark, sf_dir, "customer"))


def app_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, APP_SESSIONS, playback_events=playback_events(spark, sf_dir))


def duckdb_text(text: str) -> str:
    """The same derivation for DuckDB, where every name is a view or an earlier CTE of that name."""
    names = ["lineitem", "orders", "part", "customer", "playback_events"]
    return text.replace("{TS}", "TIMESTAMP").format(**{n: n for n in names}).strip()
