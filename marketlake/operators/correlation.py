"""Rolling correlation of two return series.

Frames are partitioned by (base, quote), so many pairs run side by side. Rows of one
pair are bounded by the number of common days.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketlake.fixed_values import (
    CORRELATION_BASE,
    CORRELATION_COLUMN,
    CORRELATION_FRAME_ROWS,
    CORRELATION_MIN_PAIRS,
    CORRELATION_QUOTE,
)

Mode = Literal["pairs", "compat"]


def join_series(left: DataFrame, right: DataFrame, on: str = "date") -> DataFrame:
    """Inner join of two series on the days both have. Spark picks the join."""
    return left.join(right, on, "inner")


def pair_returns(
    base: DataFrame,
    quote: DataFrame,
    pairs: Sequence[tuple[str, str]],
) -> DataFrame:
    """Rows ``(base, quote, date, x, y)`` for the listed pairs only.

    ``base`` has ``(symbol, date, ret_1d)``, ``quote`` has ``(code, fx_date, ret_1d)``, each
    unique per day. The list becomes a literal map: the entity filters reach the
    scans, and a series is repeated only for the pairs that name it. Both sides then
    meet in one equi-join on (quote, date).
    """
    wanted: dict[str, list[str]] = {}
    for b, q in dict.fromkeys(pairs):
        wanted.setdefault(b, []).append(q)
    quotes_of = F.create_map(
        *[x for b, qs in wanted.items() for x in (F.lit(b), F.array(*map(F.lit, qs)))]
    )
    x = (
        base.filter(F.col("symbol").isin(list(wanted)))
        .select(
            F.col("symbol").alias("base"),
            F.explode(F.try_element_at(quotes_of, F.col("symbol"))).alias("quote"),
            "date",
            F.col("ret_1d").alias("x"),
        )
    )
    y = quote.filter(F.col("code").isin(sorted({q for _, q in pairs}))).select(
        F.col("code").alias("quote"), F.col("fx_date").alias("date"), F.col("ret_1d").alias("y")
    )
    return x.join(y, ["quote", "date"], "inner").select("base", "quote", "date", "x", "y")


def _frame(keys: Sequence[str], rows: int) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("date").rowsBetween(-(rows - 1), 0)


def _sums(frame: WindowSpec) -> dict[str, Column]:
    x, y = F.col("x"), F.col("y")
    return {
        "n": F.count(F.lit(1)).over(frame),
        "sum_x": F.sum(x).over(frame),
        "sum_y": F.sum(y).over(frame),
        "sum_x2": F.sum(x * x).over(frame),
        "sum_y2": F.sum(y * y).over(frame),
        "sum_xy": F.sum(x * y).over(frame),
    }


def rolling_sums(
    joined: DataFrame,
    rows: int = CORRELATION_FRAME_ROWS,
    keys: Sequence[str] = ("base", "quote"),
) -> DataFrame:
    """Row count and the five moment sums of (x, y) over the frame."""
    return joined.withColumns(_sums(_frame(keys, rows)))


def rolling_correlation(
    joined: DataFrame,
    rows: int = CORRELATION_FRAME_ROWS,
    keys: Sequence[str] = ("base", "quote"),
    min_pairs: int = CORRELATION_MIN_PAIRS,
    mode: Mode = "pairs",
    out: str = "corr",
) -> DataFrame:
    """Pearson correlation over the last ``rows`` joined rows.

    ``mode="pairs"`` uses rows where both values are there; null below ``min_pairs`` of
    them or when a series is constant in the frame. ``mode="compat"`` counts every
    joined row, null values included, and works on raw moment sums.
    """
    frame = _frame(keys, rows)
    if mode == "compat":
        sums = joined.withColumns(_sums(frame))
        n = F.col("n")
        spread = (n * F.col("sum_x2") - F.col("sum_x") * F.col("sum_x")) * (
            n * F.col("sum_y2") - F.col("sum_y") * F.col("sum_y")
        )
        shared = n * F.col("sum_xy") - F.col("sum_x") * F.col("sum_y")
        value = F.when(
            (n >= min_pairs) & (spread > 0), F.try_divide(shared, F.sqrt(spread))
        )
        return sums.withColumn(out, value).drop(*_sums(frame))
    if mode != "pairs":
        raise ValueError(f"unknown mode {mode!r}")
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    paired = joined.withColumns(
        {"_px": F.when(both, F.col("x")), "_py": F.when(both, F.col("y"))}
    )
    corr = F.try_divide(
        F.covar_pop("_px", "_py").over(frame),
        F.stddev_pop("_px").over(frame) * F.stddev_pop("_py").over(frame),
    )
    enough = F.count("_px").over(frame) >= min_pairs
    return paired.withColumn(out, F.when(enough, corr)).drop("_px", "_py")


def correlation_table(
    daily: DataFrame,
    rates: DataFrame,
    base: str = CORRELATION_BASE,
    quote: str = CORRELATION_QUOTE,
    mode: Mode = "pairs",
    out: str = CORRELATION_COLUMN,
) -> DataFrame:
    """One pair's correlation by date, in the layout of the aggregated table."""
    joined = pair_returns(daily, rates, [(base, quote)])
    return rolling_correlation(joined, mode=mode, out=out).select("date", out)
