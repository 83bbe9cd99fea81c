"""Returns and volatility of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.fixed_values import VOLATILITY_FRAME_ROWS
from marketlake.functions import ratio_change
from marketlake.operators.series import Blocks, over_series


def simple_return(
    df: DataFrame,
    entity: str | Sequence[str],
    order: str | Sequence[str],
    value: str,
    out: str = "ret_1d",
    blocks: Blocks | None = None,
) -> DataFrame:
    """Return against the previous *row* of the entity; null on its first row.

    Give ``blocks`` for series finer than daily (the first order column is then a
    timestamp): a task then holds blocks of an entity, cut between time chunks.
    """
    entity = [entity] if isinstance(entity, str) else list(entity)
    order = [order] if isinstance(order, str) else list(order)

    def columns(w):
        return {out: ratio_change(F.col(value), F.lag(value).over(w))}

    return over_series(df, entity, order[0], order, 1, blocks, columns)


def rolling_volatility(
    df: DataFrame,
    entity: str | Sequence[str],
    order: str | Sequence[str],
    value: str = "ret_1d",
    rows: int = VOLATILITY_FRAME_ROWS,
    out: str | None = None,
    blocks: Blocks | None = None,
) -> DataFrame:
    """Population standard deviation over the last ``rows`` rows, nulls skipped."""
    entity = [entity] if isinstance(entity, str) else list(entity)
    order = [order] if isinstance(order, str) else list(order)
    name = out or f"vol_{rows}d"

    def columns(w):
        return {name: F.stddev_pop(value).over(w.rowsBetween(-(rows - 1), 0))}

    return over_series(df, entity, order[0], order, rows - 1, blocks, columns)


def daily_returns(daily: DataFrame) -> DataFrame:
    """Daily closes with ``ret_1d`` per symbol."""
    return simple_return(daily, "symbol", "date", "close")


def rate_returns(rates: DataFrame) -> DataFrame:
    """Daily rates with ``ret_1d`` per code, and year and month for partitioning."""
    made = simple_return(rates.select("fx_date", "code", "mid"), "code", "fx_date", "mid")
    return made.withColumns({"year": F.year("fx_date"), "month": F.month("fx_date")})
