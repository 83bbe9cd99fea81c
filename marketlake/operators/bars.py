"""Price bars of any bucket size, and their daily roll-ups.

The same function serves batch and streams. Every aggregate is partial plus
final, so a hot symbol sends one row per bucket and map task through the shuffle,
never its ticks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.fixed_values import BAR_BUCKET, BAR_PERCENTILE
from marketlake.functions import instant_to_ntz

MEASURES = (
    "ts_min", "ts_max", "price_open", "price_close", "price_high", "price_low",
    "price_avg", "price_p95", "volume_base", "volume_quote", "trade_count",
)


def bars(
    ticks: DataFrame,
    bucket: str = BAR_BUCKET,
    keys: Sequence[str] = ("symbol",),
    ts: str = "event_ts",
    tie_break: str | None = "trade_id",
    percentile: float = BAR_PERCENTILE,
    accuracy: int = 10_000,
) -> DataFrame:
    """Open, close, high, low, mean, percentile, volumes and count per bucket.

    Ticks need ``price``, ``quantity`` and ``ts``. Open and close of trades in the
    same instant are settled by ``tie_break`` when that column is there. The percentile is exact up
    to ``accuracy`` ticks in a bar and within a rank of ``1 / accuracy`` of them above. ``ts`` may be
    ``TIMESTAMP_NTZ`` (batch) or ``TIMESTAMP`` (streams); the result is zone-free.
    """
    order = F.col(ts)
    if tie_break and tie_break in ticks.columns:
        if dict(ticks.dtypes)[tie_break] == "string":
            raise ValueError(f"{tie_break} is text and would order 10 before 9; cast it first")
        order = F.struct(F.col(ts), F.col(tie_break))
    price, quantity = F.col("price"), F.col("quantity")
    # A stream must group by the window itself, which carries the watermark; in batch
    # its start alone is a smaller key.
    window = F.window(ts, bucket)
    key = window.alias("bucket") if ticks.isStreaming else window.start.alias("bucket")
    grouped = ticks.groupBy(*keys, key).agg(
        F.min(ts).alias("ts_min"),
        F.max(ts).alias("ts_max"),
        F.min_by(price, order).alias("price_open"),
        F.max_by(price, order).alias("price_close"),
        F.max(price).alias("price_high"),
        F.min(price).alias("price_low"),
        F.avg(price).alias("price_avg"),
        F.percentile_approx(price, percentile, accuracy).alias("price_p95"),
        F.sum(quantity).alias("volume_base"),
        F.sum(quantity * price).alias("volume_quote"),
        F.count(F.lit(1)).alias("trade_count"),
    )
    times = {
        "bucket_start_ts": F.col("bucket.start" if ticks.isStreaming else "bucket"),
        "ts_min": F.col("ts_min"),
        "ts_max": F.col("ts_max"),
    }
    if dict(ticks.dtypes)[ts] == "timestamp":
        times = {name: instant_to_ntz(c) for name, c in times.items()}
    return grouped.withColumns(times).select(*keys, "bucket_start_ts", *MEASURES)


def hourly_bars(
    ticks: DataFrame, load_ts: Column | None = None, **options
) -> DataFrame:
    """Hourly bars in the layout of the curated table."""
    load_ts = F.current_timestamp() if load_ts is None else load_ts
    return bars(ticks, BAR_BUCKET, ("symbol",), **options).select(
        "symbol",
        F.col("bucket_start_ts").alias("hour_start_ts"),
        *MEASURES,
        load_ts.alias("load_ts"),
        F.to_date("bucket_start_ts").alias("date"),
        F.hour("bucket_start_ts").alias("hour"),
    )


def _close() -> list[Column]:
    # ``ts_max`` is unique among the bars of one symbol, so ``max_by`` over the plain
    # timestamp is exact and keeps the plan a ``HashAggregate``
    return [F.max_by("price_close", "ts_max").alias("close"), F.max("ts_max").alias("ts_max")]


def _volume() -> list[Column]:
    return [
        F.sum("volume_base").alias("volume_sum"),
        F.sum("volume_quote").alias("volume_quote_sum"),
        F.sum("trade_count").alias("trade_count_sum"),
    ]


def _daily(hourly: DataFrame, measures: Sequence[Column]) -> DataFrame:
    dated = hourly.filter(F.col("date").isNotNull())
    return dated.groupBy("symbol", F.to_date("date").alias("date")).agg(*measures)


def daily_close(hourly: DataFrame) -> DataFrame:
    """Close of the day: that of the bar with the latest tick."""
    return _daily(hourly, _close())


def daily_volume(hourly: DataFrame) -> DataFrame:
    """Base volume, quote volume and trade count per symbol and day."""
    return _daily(hourly, _volume())


def daily_summary(hourly: DataFrame) -> DataFrame:
    """Close and volumes of the day in one pass and one shuffle.

    For facts made straight from bars: it saves the scan and the join that separate
    close and volume tables need.
    """
    return _daily(hourly, [*_close(), *_volume()])
