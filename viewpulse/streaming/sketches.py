"""Distinct viewers from stored sketches: a minute's HyperLogLog sketches roll up to hours, days and weeks without the events.

Sketches of the same viewers from several batches, copies included, unite to the same sketch, so each batch appends its own and
nothing is read again. A sketch has at most 2^`LG_K` registers whatever it has seen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse.streaming.live import viewing

LG_K = 12
#: Three standard errors of a sketch: 1.04 / sqrt(2^LG_K) each.
ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
UNITS = ["hour", "day", "week"]
SKETCHES = "platform string, minute timestamp_ntz, sketch binary"


def minute_sketches(events: DataFrame) -> DataFrame:
    """Viewers of each platform and minute, as sketches. Anonymous viewers are left out."""
    known = viewing(events).filter(F.col("user_id").isNotNull() & F.col("server_ts").isNotNull())
    minute = F.date_trunc("minute", "server_ts").cast("timestamp_ntz").alias("minute")
    return known.groupBy("platform", minute).agg(F.hll_sketch_agg("user_id", F.lit(LG_K)).alias("sketch"))


def united(sketches: DataFrame) -> DataFrame:
    """One sketch for each platform and minute."""
    return sketches.groupBy("platform", "minute").agg(F.hll_union_agg("sketch").alias("sketch"))


def roll_up(sketches: DataFrame) -> DataFrame:
    """unit, platform, start and about how many viewers: hours from minutes, days from hours, weeks from days."""
    levels, at = [], sketches.withColumnRenamed("minute", "start")
    for unit in UNITS:
        start = F.date_trunc(unit, "start").cast("timestamp_ntz").alias("start")
        at = at.groupBy("platform", start).agg(F.hll_union_agg("sketch").alias("sketch"))
        levels.append(at.select(F.lit(unit).alias("unit"), "platform", "start", F.hll_sketch_estimate("sketch").alias("about")))
    return reduce(DataFrame.unionByName, levels)


def exact_viewers(events: DataFrame) -> DataFrame:
    """The same units counted from the events, to hold estimates against."""
    known = viewing(events).filter(F.col("user_id").isNotNull() & F.col("server_ts").isNotNull())
    starts = F.array(*[F.struct(F.lit(u).alias("unit"), F.date_trunc(u, "server_ts").cast("timestamp_ntz").alias("start")) for u in UNITS])
    seen = known.select("platform", "user_id", F.explode(starts).alias("at")).select("at.unit", "platform", "at.start", "user_id")
    return seen.distinct().groupBy("unit", "platform", "start").agg(F.count("user_id").alias("viewers"))
