"""Live events: typed source, deduplicated table, viewers per minute, inactivity sessions.

Times in a stream are TIMESTAMP, which watermarks need. The clock never enters a stream: "the last five minutes" is a filter
of the reader against an explicit `now`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewpulse.functions.dates import clock
from viewpulse.operators.dedup import latest_copy
from viewpulse.schemas import LIVE_EVENT_DDL, Table
from viewpulse.sources.tables import upsert_table

# Fixed values of the live report.
VIEWING_TYPES = ["play_start", "heartbeat"]
LATE_HORIZON = "48 hours"
RECENT_MINUTES = 5


def event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON event files as a typed stream of seven columns."""
    reader = spark.readStream.schema(LIVE_EVENT_DDL)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def parse_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """The same columns out of a message payload, for a broker source (`format("kafka")`)."""
    return messages.select(F.from_json(F.col(value).cast("string"), LIVE_EVENT_DDL).alias("e")).select("e.*")


def zoned(df: DataFrame) -> DataFrame:
    """TIMESTAMP_NTZ columns as TIMESTAMP."""
    ntz = [f.name for f in df.schema if f.dataType.simpleString() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz})


def unzoned(df: DataFrame) -> DataFrame:
    plain = [f.name for f in df.schema if f.dataType.simpleString() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in plain})


def maintain_latest(
    stream: DataFrame, root: str, table: Table, checkpoint: str, match_days: int | None = None, **trigger
) -> StreamingQuery:
    """Keep a table with the latest copy per event id, across batches and restarts.

    Each batch is deduplicated and merged with the rule "greater server_ts wins", so a batch delivered twice changes
    nothing. `match_days` bounds how far back a batch looks for earlier copies, e.g. the late-data horizon. A merge
    rewrites the dates it touches, so give it batches of minutes or more; batches every few seconds go to an append-only log
    (`viewpulse.streaming.log`), from which a dashboard reads through `recent_latest`.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        upsert_table(latest_copy(unzoned(batch)), root, table, newer="server_ts", match_days=match_days)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def recent_latest(log: DataFrame, now, minutes: int = RECENT_MINUTES) -> DataFrame:
    """Latest copies of the last minutes, straight from an append-only log.

    The copy kept is the one with the greatest server_ts up to `now`; of a log read at its end that is the newest, and only
    the newest files are read. The event type must be filtered afterwards.
    """
    return latest_copy(recent(log, now, minutes))


def recent(df: DataFrame, now, minutes: int = RECENT_MINUTES, ts: str = "server_ts") -> DataFrame:
    """Rows of the `minutes` up to and including `now`."""
    return df.filter((F.col(ts) > clock(now) - F.make_dt_interval(mins=F.lit(minutes))) & (F.col(ts) <= clock(now)))


def viewing(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type").isin(VIEWING_TYPES))


def concurrent_viewers(events: DataFrame) -> DataFrame:
    """Exact viewers per platform and minute of a bounded table."""
    minute = F.window("server_ts", "1 minute").start.alias("minute")
    known = viewing(events).filter(F.col("user_id").isNotNull())
    seen = known.select("platform", minute, "user_id").distinct()
    return seen.groupBy("platform", "minute").agg(F.count("user_id").alias("concurrent_viewers"))


def viewer_marks(stream: DataFrame, horizon: str = LATE_HORIZON) -> DataFrame:
    """One row per viewer, platform and minute, the first time it is seen.

    State is spread over viewers, not held as one set per minute. Counting the marks of a minute gives its viewers exactly,
    late ones included, and each mark is written as soon as it appears.
    """
    minute = F.window("server_ts", "1 minute").start
    return (
        viewing(stream)
        .filter(F.col("user_id").isNotNull())
        .select("platform", minute.alias("minute"), "user_id")
        .withWatermark("minute", horizon)
        .dropDuplicates(["platform", "minute", "user_id"])
    )


def approx_viewers(stream: DataFrame, horizon: str = LATE_HORIZON) -> DataFrame:
    """Approximate viewers per platform and minute with a fixed-size sketch as state."""
    return (
        viewing(stream)
        .filter(F.col("user_id").isNotNull())
        .withWatermark("server_ts", horizon)
        .groupBy("platform", F.window("server_ts", "1 minute").alias("w"))
        .agg(F.approx_count_distinct("user_id").alias("concurrent_viewers"))
        .select("platform", F.col("w.start").alias("minute"), "concurrent_viewers")
    )


def session_windows(stream: DataFrame, key: str, ts: str, gap: str = "30 minutes", horizon: str = LATE_HORIZON) -> DataFrame:
    """Sessions closed by inactivity.

    With `append_to` each session is written once, when the watermark has passed its end, and its state is dropped. With
    `publish` open sessions are shown too, at the price of keeping them all: for feeds of bounded length. Rows of a busy key
    are folded to sessions in their own partition before they meet, so the exchange carries sessions, not events.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return (
        stream.withWatermark(ts, horizon)
        .groupBy(key, F.session_window(ts, gap).alias("w"))
        .agg(F.min(ts).alias("session_start_ts"), F.max(ts).alias("session_end_ts"), F.count(F.lit(1)).alias("event_count"))
        .drop("w")
    )


def append_to(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Exactly-once Parquet sink."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def publish(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The whole result of an aggregation after every batch (complete mode, all state is kept: for feeds of bounded length).

    Each batch goes to a folder of its own under `path`, so readers never meet a half-written result; see `published`.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch-{batch_id:012d}")

    return (
        stream.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def published(spark: SparkSession, path: str, schema) -> DataFrame:
    """The newest complete result of `publish`."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    batches = [s.getPath() for s in fs.listStatus(folder)]
    done = [p.toString() for p in batches if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return spark.read.schema(schema).parquet(max(done))
