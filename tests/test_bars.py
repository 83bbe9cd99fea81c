import datetime as dt

from pyspark.sql import functions as F

from marketlake.operators.bars import bars, daily_close, daily_volume, hourly_bars
from marketlake.plans import inputs

T = dt.datetime
TICKS = "symbol string, price double, quantity double, trade_id bigint, event_ts timestamp_ntz"


def test_bar_values_and_ties(spark):
    at = T(2024, 1, 5, 3, 0, 0)
    df = spark.createDataFrame(
        [
            ("A", 10.0, 1.0, 2, at),
            ("A", 11.0, 2.0, 1, at),  # same instant, earlier id: the open
            ("A", 9.0, 3.0, 3, T(2024, 1, 5, 3, 59, 59)),
            ("A", 12.0, 1.0, 5, T(2024, 1, 5, 3, 59, 59)),  # later id: the close
            ("A", 7.0, 1.0, 6, T(2024, 1, 5, 4, 0, 0)),
        ],
        TICKS,
    )
    first, second = hourly_bars(df).orderBy("hour").collect()
    assert (first.price_open, first.price_close) == (11.0, 12.0)
    assert (first.price_high, first.price_low, first.price_avg) == (12.0, 9.0, 10.5)
    assert (first.volume_base, first.volume_quote, first.trade_count) == (7.0, 71.0, 4)
    assert (first.ts_min, first.ts_max) == (at, T(2024, 1, 5, 3, 59, 59))
    assert (first.date, first.hour, first.hour_start_ts) == (dt.date(2024, 1, 5), 3, at)
    assert (second.hour, second.trade_count) == (4, 1)


def test_published_day_shape(spark):
    """781 ticks in two hours: 2 bars, 1 close, count 781."""
    df = spark.range(781).select(
        F.lit("BTCUSDT").alias("symbol"),
        (F.lit(92000.0) + F.col("id")).alias("price"),
        F.lit(0.5).alias("quantity"),
        F.col("id").alias("trade_id"),
        F.expr("timestampadd(SECOND, id * 9, timestamp_ntz'2026-01-05 12:00:00')").alias("event_ts"),
    )
    made = hourly_bars(df)
    assert made.count() == 2
    [day] = daily_close(made).join(daily_volume(made), ["symbol", "date"]).collect()
    assert (day.close, day.trade_count_sum, day.volume_sum) == (92780.0, 781, 390.5)


def test_buckets_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("A", 1.0, 1.0, 1, T(2024, 3, 10, 2, 30))], TICKS)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = hourly_bars(df).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row.date, row.hour) == (dt.date(2024, 3, 10), 2)


def test_bar_properties(spark):
    made = bars(inputs.ticks(spark, "/root/testdata/sf0.01"), "6 hours")
    inside = [F.col(c).between(F.col("price_low"), F.col("price_high")) for c in
              ("price_open", "price_close", "price_p95")]
    near = F.col("price_avg").between(F.col("price_low") - 1e-9, F.col("price_high") + 1e-9)
    bad = made.filter(~(inside[0] & inside[1] & inside[2] & near)).count()
    assert bad == 0
    assert made.agg(F.sum("trade_count")).first()[0] == 10_000


def test_close_is_the_last_bar_not_the_highest(spark):
    df = spark.createDataFrame(
        [("A", dt.date(2024, 1, 1), T(2024, 1, 1, 5), 99.0),
         ("A", dt.date(2024, 1, 1), T(2024, 1, 1, 6), 1.0),
         ("A", None, T(2024, 1, 1, 7), 5.0)],
        "symbol string, date date, ts_max timestamp_ntz, price_close double",
    )
    [row] = daily_close(df).collect()
    assert row.close == 1.0
