"""The test tables in the roles of market data.

``events`` are ticks, ``orders`` are daily rates (several loads per day and code),
``lineitem`` is a second daily series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import ntz_to_epoch_ms
from marketlake.operators.bars import daily_close, hourly_bars
from marketlake.operators.latest import latest_wins
from marketlake.operators.returns import daily_returns, rate_returns, simple_return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_ticks(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").alias("quantity"),
        F.col("event_id").alias("trade_id"),
        F.col("ts").alias("event_ts"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(table(spark, sf_dir, "events"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_bars(ticks(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_returns(daily_close(hourly(spark, sf_dir)))


def rate_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All loads of all rates; a higher ``load_no`` is newer."""
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("fx_date"),
        F.col("o_orderpriority").alias("code"),
        F.col("o_orderstatus").alias("currency"),
        F.col("o_totalprice").alias("mid"),
        F.col("o_orderkey").alias("load_no"),
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_wins(rate_loads(spark, sf_dir), ("fx_date", "code"), ("load_no",))


def rates_with_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_returns(rates(spark, sf_dir))


def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second daily series: shipped value per return flag, with returns."""
    sums = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_returnflag").alias("symbol"), F.to_date("l_shipdate").alias("date"))
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("close"))
    )
    return simple_return(sums, "symbol", "date", "close")


def raw_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as raw text, with faults that depend on the row's own values.

    A price below 1 reads ``n/a``, quantity 0 is absent, and an ``error`` above 100 has
    no event time.
    """
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    late = (F.col("event_type") == "error") & (F.col("value") > 100)
    return events.select(
        F.col("event_type").alias("symbol"),
        F.when(F.col("value") < 1, "n/a").otherwise(F.col("value").cast("string")).alias("price"),
        F.nullif(k, F.lit("0")).alias("quantity"),
        F.when(~late, ntz_to_epoch_ms("ts").cast("string")).alias("event_time"),
        F.col("event_id").cast("string").alias("trade_id"),
        F.col("ts").alias("landed_ts"),
    )


def trade_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as JSON text, with faults that depend on the row's own values.

    A quantity of 0 cuts the text short, a price below 1 is not a number, and an
    ``error`` above 100 has no symbol.
    """
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    ms = ntz_to_epoch_ms("ts")
    nameless = (F.col("event_type") == "error") & (F.col("value") > 100)
    text = F.to_json(
        F.struct(
            F.lit("aggTrade").alias("e"),
            ms.alias("E"),
            F.when(~nameless, F.col("event_type")).alias("s"),
            F.col("event_id").alias("a"),
            F.when(F.col("value") < 1, "n/a").otherwise(F.col("value").cast("string")).alias("p"),
            k.alias("q"),
            F.col("event_id").alias("f"),
            F.col("event_id").alias("l"),
            ms.alias("T"),
            F.lit(False).alias("m"),
        )
    )
    return events.select(
        F.col("event_id"),
        F.when(k == "0", F.substring(text, 1, 20)).otherwise(text).alias("value"),
    )


def rate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per day with the day's rates; Sundays lack a date.

    Rates are deduplicated first, so a document holds at most one rate per code.
    """
    day = F.col("fx_date")
    one = F.struct("currency", "code", "mid")
    packed = rates(spark, sf_dir).groupBy("fx_date").agg(F.collect_list(one).alias("rates"))
    return packed.select(
        F.to_json(
            F.array(
                F.struct(
                    F.lit("A").alias("table"),
                    F.date_format(day, "DDD/yyyy").alias("no"),
                    F.when(F.dayofweek(day) == 1, "")
                    .otherwise(F.date_format(day, "yyyy-MM-dd"))
                    .alias("effectiveDate"),
                    "rates",
                )
            )
        ).alias("value")
    )
