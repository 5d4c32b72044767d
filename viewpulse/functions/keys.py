"""Hashes and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The attributes whose change opens a new version of a user.
TRACKED = ["signup_source", "country_code", "current_plan", "plan_started_ts", "status"]


def row_hash(columns: list[str] = TRACKED) -> Column:
    """md5 over the tracked attributes. Nulls take a marker, so a null moving to the next column changes the hash."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    return F.md5(F.concat_ws("||", *parts))


def surrogate_key(user_id: Column, valid_from: Column) -> Column:
    """Deterministic: the same version gets the same key in every replay, without a shared counter."""
    return F.sha2(F.concat(user_id, valid_from.cast("string")), 256)
