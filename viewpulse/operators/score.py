"""Engagement score 0-100: weighted percentile ranks inside a plan over 28 days of user-days.

There are only a handful of plans, so a ranking window over user-days would sort the whole population in a few tasks, three
times. User-days are folded to counts per (plan, value) first; percent_rank of a value is (rows below) / (rows - 1), and the
window runs over distinct values only. Values are minutes with two digits and small counts, so their number is bounded by
the length of a day, not by the number of users.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from viewpulse.functions.dates import DateLike, back, between_days, day
from viewpulse.functions.exact import ratio

# Fixed values of the score definition.
WINDOW_DAYS = 28
WEIGHTS = {"total_watch_time_min": 50, "session_count": 30, "distinct_genre_count": 20}
METRICS = list(WEIGHTS)
UNKNOWN_PLAN = "unknown"


def with_current_plan(daily: DataFrame, users: DataFrame) -> DataFrame:
    """Add plan_segment, the user's current plan."""
    plans = users.filter("is_current").select("user_id", F.col("current_plan").alias("_plan"))
    return (
        daily.join(plans, "user_id", "left")
        .withColumn("plan_segment", F.coalesce("_plan", F.lit(UNKNOWN_PLAN)))
        .drop("_plan")
    )


def _null_safe(pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])


def percent_ranks(counts: DataFrame, group: Sequence[str], value: str, into: str) -> DataFrame:
    """`counts` has rows (group, value, n). Gives percent_rank of each value; nulls rank lowest."""
    values = counts.groupBy(*group, value).agg(F.sum("n").alias("n"))
    whole = W.partitionBy(*group)
    below = F.coalesce(F.sum("n").over(whole.orderBy(value).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    others = F.sum("n").over(whole) - 1
    rank = F.when(others > 0, below.cast("double") / F.nullif(others, F.lit(0)).cast("double")).otherwise(F.lit(0.0))
    return values.select(*group, value, rank.alias(into))


def _score(cells: DataFrame, population: dict[str, DataFrame], group: Sequence[str]) -> DataFrame:
    """Score each combination of metrics in `cells`; `population[m]` counts the values of metric m to rank against."""
    scored = cells
    for m in METRICS:
        keys = [*group, m]
        ranks = percent_ranks(population[m], group, m, f"_pr_{m}")
        ranks = ranks.select(*[F.col(c).alias(f"_r_{c}") for c in keys], f"_pr_{m}")
        scored = scored.join(ranks, _null_safe([(c, f"_r_{c}") for c in keys]), "left").drop(*[f"_r_{c}" for c in keys])
    total = reduce(lambda a, b: a + b, [F.col(f"_pr_{m}") * F.lit(float(w)) for m, w in WEIGHTS.items()])
    return scored.withColumn("engagement_score", F.round(total, 0).cast("int"))


def _look_up(days: DataFrame, scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Scores of the combinations back on the user-days; a frequent combination is left to AQE's skew handling."""
    right = scored.select(*[F.col(c).alias(f"_c_{c}") for c in keys], "engagement_score")
    on = _null_safe([(c, f"_c_{c}") for c in keys])
    return days.join(right, on, "left").drop(*[f"_c_{c}" for c in keys])


def _days(daily: DataFrame, users: DataFrame, first: DateLike, last: DateLike) -> DataFrame:
    window = daily.filter(between_days(F.col("activity_date"), first, last))
    return with_current_plan(window.drop("engagement_score"), users)


def cells_of(planned: DataFrame) -> DataFrame:
    """User-days with plan_segment folded to counts by day, plan and measures; counts of days add up."""
    return planned.groupBy("activity_date", "plan_segment", *METRICS).agg(F.count(F.lit(1)).alias("n"))


def moved_cells(daily: DataFrame, moved: DataFrame) -> DataFrame:
    """What changes of plan (user_id, old_plan, new_plan) do to the counts: out of the old plan, into the new one."""
    sides = F.array(*[F.struct(F.col(c).alias("plan"), F.lit(n).cast("bigint").alias("n")) for c, n in (("old_plan", -1), ("new_plan", 1))])
    placed = daily.join(moved, "user_id").select("activity_date", *METRICS, F.explode(sides).alias("side"))
    plan = F.coalesce("side.plan", F.lit(UNKNOWN_PLAN)).alias("plan_segment")
    return placed.groupBy("activity_date", plan, *METRICS).agg(F.sum("side.n").alias("n")).filter("n <> 0")


def rescore(daily: DataFrame, users: DataFrame, as_of: DateLike, cells: DataFrame | None = None) -> DataFrame:
    """The user-days of the 28 days ending at `as_of` with new scores: the rows pass through, nothing is joined back.

    `cells` are stored counts of the window's days; without them they are made from the user-days.
    """
    first = back(as_of, WINDOW_DAYS - 1)
    days = _days(daily, users, first, as_of)
    keys = ["plan_segment", *METRICS]
    counted = cells_of(days) if cells is None else cells.filter(between_days(F.col("activity_date"), first, as_of))
    cells = counted.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0")
    return _look_up(days, _score(cells, {m: cells for m in METRICS}, ["plan_segment"]), keys)


def rescore_range(daily: DataFrame, users: DataFrame, first: DateLike, last: DateLike) -> DataFrame:
    """User-days as nightly runs for first..last, one after the other, leave them.

    Each run rescored the 28 days before it, so a day keeps the score of the last run that saw it, at
    min(day + 27, last). All runs are ranked together; only the per-day value counts are repeated for the runs that see
    them, never the user-days.
    """
    days = _days(daily, users, back(first, WINDOW_DAYS - 1), last)
    cells = cells_of(days)
    reach = F.least(F.date_add("activity_date", WINDOW_DAYS - 1), day(last))
    runs = F.sequence(F.greatest("activity_date", day(first)), reach, F.expr("INTERVAL 1 DAY"))
    # Counts per day and single metric are small; three narrow tables instead of repeating the combinations.
    population = {
        m: cells.groupBy("activity_date", "plan_segment", m)
        .agg(F.sum("n").alias("n"))
        .withColumn("as_of", F.explode(runs))
        for m in METRICS
    }
    final = cells.select(reach.alias("as_of"), "plan_segment", *METRICS).distinct()
    keys = ["as_of", "plan_segment", *METRICS]
    scored = _score(final, population, ["as_of", "plan_segment"])
    return _look_up(days.withColumn("as_of", reach), scored, keys).drop("as_of")


_SCORE = ["user_id", "activity_date", "plan_segment", "engagement_score"]


def engagement_score(daily: DataFrame, users: DataFrame, as_of: DateLike) -> DataFrame:
    """Keys and scores of the 28 days ending at `as_of`, for a merge into the daily table."""
    return rescore(daily, users, as_of).select(*_SCORE)


def backfill_scores(daily: DataFrame, users: DataFrame, first: DateLike, last: DateLike) -> DataFrame:
    """Keys and scores after nightly runs for first..last."""
    return rescore_range(daily, users, first, last).select(*_SCORE)


def deviation(n: Column, s: Column, ss: Column) -> Column:
    """Sample standard deviation from count, sum and sum of squares, whose products outgrow 64 bits."""
    n, s, ss = (c.cast("decimal(38,0)") for c in (n, s, ss))
    squares = (n * ss - s * s).cast("double")
    return F.when(n > 1, F.sqrt(squares / F.nullif((n * (n - 1)).cast("double"), F.lit(0.0))))


def score_validation(daily: DataFrame, users: DataFrame, as_of: DateLike) -> DataFrame:
    """Score statistics per plan from a week before `as_of` on."""
    recent = daily.filter(F.col("activity_date") >= day(back(as_of, 7))).select("user_id", "activity_date", "engagement_score")
    planned = with_current_plan(recent, users)
    # Per user first: counting distinct users then needs no second pass over the user-days.
    per_user = planned.groupBy("plan_segment", "user_id").agg(
        F.min("engagement_score").alias("lo"),
        F.max("engagement_score").alias("hi"),
        F.sum("engagement_score").alias("s"),
        F.sum(F.col("engagement_score").cast("bigint") * F.col("engagement_score")).alias("ss"),
        F.count("engagement_score").alias("n"),
    )
    per_plan = per_user.groupBy("plan_segment").agg(
        F.count("user_id").alias("users"),
        F.min("lo").alias("min_score"),
        F.max("hi").alias("max_score"),
        F.sum("s").alias("s"),
        F.sum(F.col("ss").cast("decimal(38,0)")).alias("ss"),
        F.sum("n").alias("n"),
    )
    n, s, ss = (F.col(c) for c in ("n", "s", "ss"))
    spread = deviation(n, s, ss)
    return per_plan.select(
        "plan_segment",
        "users",
        "min_score",
        "max_score",
        ratio(s, n, 1).cast("decimal(5,1)").alias("avg_score"),
        F.round(spread, 2).alias("stddev_score"),
    ).orderBy(F.desc("avg_score"), "plan_segment")
