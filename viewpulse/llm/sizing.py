"""How many ranges a table is dealt into: by its bytes, so that a task's share stays the same as the table grows."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: What Spark says of the size of a table it knows nothing about.
UNKNOWN = 1 << 62


def ranges(df: DataFrame, bytes_each: int) -> int:
    """Ranges of about `bytes_each` of `df` by Spark's estimate (of files: their bytes), at least Spark's own number."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return least if size >= UNKNOWN else max(least, -(-size // bytes_each))
