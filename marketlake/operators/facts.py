"""Monthly facts and the daily fact table behind the serving layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.fixed_values import CORRELATION_COLUMN


def monthly_facts(daily: DataFrame) -> DataFrame:
    """Mean return, population deviation, number of returns and last close.

    ``date`` is unique per symbol, so ``max_by`` needs no tie-break and the plan stays
    a ``HashAggregate`` with one shuffle of pre-aggregated rows.
    """
    return daily.groupBy(
        "symbol", F.year("date").alias("year"), F.month("date").alias("month")
    ).agg(
        F.avg("ret_1d").alias("avg_ret_1d"),
        F.stddev_pop("ret_1d").alias("vol_ret"),
        F.count("ret_1d").alias("days_ret"),
        F.max_by("close", "date").alias("last_close"),
    )


def daily_facts(
    daily: DataFrame,
    volume: DataFrame | None,
    correlation: DataFrame,
    correlation_columns: Sequence[str] = (CORRELATION_COLUMN,),
) -> DataFrame:
    """Daily close and return, with volumes and the per-date correlation.

    ``volume`` is None when ``daily`` has the volume columns already.

    The correlation has at most one row per calendar day. No broadcast is forced:
    Spark broadcasts it when its measured size allows and falls back to a
    skew-handled sort-merge join otherwise.
    """
    if volume is not None:
        daily = daily.join(volume, ["symbol", "date"], "left")
    return (
        daily.join(correlation.select("date", *correlation_columns), "date", "left")
        .select(
            "symbol", "date", "close", "ret_1d",
            "volume_sum", "volume_quote_sum", "trade_count_sum",
            *correlation_columns,
        )
    )


def on_date(df: DataFrame, day: str | None, column: str = "date") -> DataFrame:
    """Optional single-day filter; prunes partitions when ``column`` is one."""
    return df if day is None else df.filter(F.col(column) == F.lit(day).cast("date"))
