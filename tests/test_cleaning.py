import json

import pytest
from pyspark.sql import functions as F

from marketlake.operators.bars import hourly_bars
from marketlake.operators.cleaning import (
    as_declared,
    dedup_trades,
    normalize_rates,
    normalize_ticks,
    parse_trades,
    rejected_rows,
    require_columns,
    valid_rows,
)

RAW = "symbol string, price string, quantity string, event_time string"


def test_as_declared_casts_and_fills(spark):
    df = spark.createDataFrame([("1", "x", 2)], "b string, c string, a int")
    made = as_declared(df, {"a": "bigint", "b": "int"}, {"c": "int", "gone": "date"})
    assert made.dtypes == [("a", "bigint"), ("b", "int"), ("c", "int"), ("gone", "date")]
    assert tuple(made.first()) == (2, 1, None, None)
    with pytest.raises(ValueError, match="missing"):
        as_declared(df, {"missing": "int"}, {})


def test_trade_ids_are_numbers(spark):
    rows = [("A", "1", "1", "1704430800000", i) for i in ("9", "10", "x", None, " ")]
    raw = spark.createDataFrame([(*r[:4], r[4]) for r in rows], "symbol string, price string, quantity string, event_time string, a string")
    tagged = normalize_ticks(raw)
    assert dict(tagged.dtypes)["trade_id"] == "bigint" and "a" not in tagged.columns
    assert [r.reject_reason for r in tagged.collect()] == [None, None, "trade_id", None, None]
    made = hourly_bars(valid_rows(tagged.withColumn("price", F.col("trade_id").cast("double")).filter("trade_id is not null"))).first()
    assert (made.price_open, made.price_close) == (9.0, 10.0)
    with pytest.raises(ValueError, match="text"):
        hourly_bars(tagged.withColumn("trade_id", F.col("trade_id").cast("string")))


def test_missing_columns_are_listed(spark):
    legacy = spark.createDataFrame(
        [], "symbol string, price string, volume string, event_time string"
    )
    with pytest.raises(ValueError, match="quantity"):
        normalize_ticks(legacy)
    with pytest.raises(ValueError, match="a, b"):
        require_columns(legacy, ["a", "b"])


def test_normalize_ticks(spark):
    raw = spark.createDataFrame(
        [
            ("A", "1.5", "2", "1704067200000"),
            (None, "1.5", "2", "1704067200000"),
            ("A", "x", "", "1704067200000"),
            ("A", "NaN", "1", "1704067200000"),
            ("A", "1", "1", ""),
        ],
        RAW,
    )
    tagged = normalize_ticks(raw)
    good = valid_rows(tagged).collect()
    assert [(r.symbol, r.price, r.quantity) for r in good] == [("A", 1.5, 2.0)]
    reasons = sorted(r.reject_reason for r in rejected_rows(tagged).collect())
    assert reasons == ["event_time", "price", "price,quantity", "symbol"]


def test_normalize_rates(spark):
    raw = spark.createDataFrame(
        [("USD", "dollar", 3.5, "2026-01-05"), (None, "x", 1.0, "2026-01-05"),
         ("EUR", "euro", None, "2026-01-05"), ("CHF", "franc", 4.0, None)],
        "code string, currency string, mid double, d string",
    ).withColumn("fx_date", F.col("d").cast("date"))
    tagged = normalize_rates(raw)
    [good] = valid_rows(tagged).collect()
    assert (good.code, good.year, good.month) == ("USD", 2026, 1)
    assert sorted(r.reject_reason for r in rejected_rows(tagged).collect()) == [
        "code", "fx_date", "mid",
    ]


def trade(**changes):
    base = {"e": "aggTrade", "E": 1672515782136, "s": "BTCUSDT", "a": 12345, "p": "16800.00",
            "q": "0.001", "f": 100, "l": 105, "T": 1672515782000, "m": False}
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


@pytest.mark.parametrize(
    "payload, reason",
    [
        (trade(), None),
        (trade(f=..., l=..., m=...), None),
        ("", "malformed"),
        (None, "malformed"),
        ("{broken", "malformed"),
        ('"text"', "malformed"),
        (trade(s=...), "missing_s"),
        (trade(e=...), "missing_e"),
        (trade(E=...), "missing_E"),
        (trade(p=""), "missing_p"),
        (trade(p="n/a"), "type_p"),
        (trade(q="NaN"), "type_q"),
        (trade(T="soon"), "type_T"),
        (trade(a=1.5), "type_a"),
        (trade(a="x", s=None), "missing_s,type_a"),
    ],
)
def test_parse_trades(spark, payload, reason):
    df = spark.createDataFrame([(7, payload)], "offset int, value string")
    row = parse_trades(df).first()
    assert row.reject_reason == reason
    assert row.offset == 7
    if reason is None:
        assert (row.symbol, row.price, row.quantity, row.trade_id) == (
            "BTCUSDT", 16800.0, 0.001, 12345,
        )
        assert row.event_time == "1672515782000"
        assert row.event_ts.isoformat() == "2022-12-31T19:43:02"


def test_dedup(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("B", 1)], "symbol string, trade_id int")
    assert dedup_trades(df).count() == 2
