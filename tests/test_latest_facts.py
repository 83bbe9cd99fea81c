import datetime as dt

import pytest

from marketlake.operators.coverage import latest_common, latest_hour, partition_values
from marketlake.operators.facts import daily_facts, monthly_facts, on_date
from marketlake.operators.latest import latest_wins, upsert

D = dt.date


def test_latest_wins_and_tie_break(spark):
    df = spark.createDataFrame(
        [("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), ("z", None, "d")], "k string, t int, f string"
    )
    got = {r.k: r.f for r in latest_wins(df, ["k"], ["t", "f"]).collect()}
    assert got == {"k": "c", "z": "d"}


def test_upsert_fills_absent_columns(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, t int")
    new = spark.createDataFrame([(2, "a", "x")], "t int, k string, extra string")
    got = sorted(upsert(old, new, ["k"], ["t"]).select("k", "t", "extra").collect())
    assert [tuple(r) for r in got] == [("a", 2, "x"), ("b", 1, None)]


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("CAST(id < 900 AS INT) AS k", "id AS t")
    plan = latest_wins(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_monthly_facts(spark):
    df = spark.createDataFrame(
        [("A", D(2024, 1, 30), 1.0, None), ("A", D(2024, 1, 31), 2.0, 1.0),
         ("A", D(2024, 2, 1), 3.0, 0.5), ("A", D(2024, 2, 2), 3.3, 0.1),
         ("B", D(2024, 2, 2), 9.0, None)],
        "symbol string, date date, close double, ret_1d double",
    )
    got = {(r.symbol, r.month): r for r in monthly_facts(df).collect()}
    assert got["A", 1].vol_ret == 0.0 and got["A", 1].days_ret == 1
    assert got["A", 2].avg_ret_1d == pytest.approx(0.3)
    assert got["A", 2].vol_ret == pytest.approx(0.2)
    assert got["A", 2].last_close == 3.3
    assert got["B", 2].avg_ret_1d is None and got["B", 2].vol_ret is None
    assert got["B", 2].days_ret == 0
    plan = monthly_facts(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_daily_facts_keep_every_day(spark):
    daily = spark.createDataFrame(
        [("A", D(2024, 1, 1), 1.0, None), ("A", D(2024, 1, 2), 2.0, 1.0), ("B", D(2024, 1, 1), 5.0, None)],
        "symbol string, date date, close double, ret_1d double",
    )
    volume = spark.createDataFrame(
        [("A", D(2024, 1, 1), 10.0, 20.0, 3)],
        "symbol string, date date, volume_sum double, volume_quote_sum double, trade_count_sum bigint",
    )
    corr = spark.createDataFrame([(D(2024, 1, 1), 0.5)], "date date, corr_btc_usdpln_63d double")
    got = {(r.symbol, r.date.day): r for r in daily_facts(daily, volume, corr).collect()}
    assert len(got) == 3
    assert got["A", 1].trade_count_sum == 3 and got["B", 1].corr_btc_usdpln_63d == 0.5
    assert got["A", 2].volume_sum is None and got["A", 2].corr_btc_usdpln_63d is None
    assert on_date(daily, "2024-01-02").count() == 1 and on_date(daily, None).count() == 3


def test_latest_common(spark):
    a = spark.createDataFrame([(D(2024, 1, d),) for d in (1, 2, 2, 3)], "date date")
    b = spark.createDataFrame([(D(2024, 1, d),) for d in (2, 4)], "date date")
    assert latest_common(a, b).first().date == D(2024, 1, 2)
    assert latest_common(a, a.filter("date IS NULL")).first().date is None


def test_latest_hour(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 5), (D(2024, 1, 1), 23), (D(2024, 1, 2), 1)], "date date, hour int")
    assert latest_hour(df, "2024-01-01").first().hour == 23
    assert latest_hour(df, "2024-01-09").first().hour is None


def test_partition_values(spark):
    df = spark.createDataFrame([("date=2024-01-01/hour=5",)], "partition string")
    assert tuple(partition_values(df, "date", "hour").first()) == ("2024-01-01", "5")
