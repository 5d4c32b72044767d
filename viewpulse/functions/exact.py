"""Rounding that does not depend on floating point noise.

Thresholds (trend labels, report roundings) sit on exact decimal values, so ratios are taken in whole DECIMALs and rounded half
up once. Sums of integers and of DECIMAL(18,2) are exact in any order, which also makes reruns on a different number of
partitions identical.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, digits: int) -> Column:
    """num / den rounded half up (away from zero) to `digits`; null when den is null or 0.

    Both have two digits behind the point, so the quotient is taken in whole hundredths: no digit is lost and ties are met
    exactly, for numerators up to 10^28 / 10^digits and denominators up to 10^20.
    """
    n = (num.cast("decimal(32,2)") * 100).cast("decimal(38,0)")
    d = F.nullif((den.cast("decimal(22,2)") * 100).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    twice = (F.abs(n) * F.lit(2 * 10**digits).cast("decimal(38,0)") + F.abs(d)).cast("decimal(38,0)")
    whole = F.call_function("div", twice, (F.abs(d) * 2).cast("decimal(38,0)"))
    sign = F.when((n < 0) != (d < 0), -1).otherwise(1)
    return (whole * sign).cast("decimal(30,0)") * F.lit(Decimal(1).scaleb(-digits))


def minutes(seconds: Column, count: Column | None = None) -> Column:
    """Seconds (optionally per `count`) as minutes with two digits."""
    den = F.lit(60) if count is None else count * 60
    return ratio(seconds, den, 2).cast("decimal(18,2)")
