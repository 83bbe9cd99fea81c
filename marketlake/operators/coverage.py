"""Which dates and hours the inputs cover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_common(left: DataFrame, right: DataFrame, column: str = "date") -> DataFrame:
    """Latest value present on both sides, as one row.

    Both sides go through one partial aggregation by value, so the shuffle carries one
    row per value and task. ``INTERSECT`` is planned as a semi-join, which would
    shuffle every row, and every copy of a hot date into one task.
    """
    sides = left.select(column, F.lit(1).alias("_side")).unionByName(
        right.select(column, F.lit(2).alias("_side"))
    )
    on_both = sides.groupBy(column).agg(F.bit_or("_side").alias("_sides"))
    return on_both.filter(F.col("_sides") == 3).agg(F.max(column).alias(column))


def latest_hour(df: DataFrame, day: str, date: str = "date", hour: str = "hour") -> DataFrame:
    """Latest hour of a date, as one row (null when the date is absent)."""
    return df.filter(F.col(date) == F.lit(day).cast("date")).agg(F.max(hour).alias(hour))


def partition_values(df: DataFrame, *names: str) -> DataFrame:
    """Partition columns out of ``SHOW PARTITIONS`` rows: metadata only, no scan."""
    return df.select(
        *[F.regexp_extract("partition", rf"(?:^|/){n}=([^/]+)", 1).alias(n) for n in names]
    )
