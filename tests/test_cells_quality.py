import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake.operators import cells as c
from marketlake.operators.quality import Check, QualityError, enforce, quality_report, run_checks

D = dt.date
FACTS = (
    "symbol string, date date, close double, ret_1d double, volume_sum double, "
    "volume_quote_sum double, trade_count_sum bigint, corr_btc_usdpln_63d double"
)


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(
        [
            ("BTCUSDT", D(2026, 1, 5), 92840.54, None, 19.974790000000013, 1.0, 781, 0.25),
            ("ETHUSDT", D(2026, 1, 5), 3000.0, 0.5, None, None, None, 0.25),
            (None, D(2026, 1, 5), 1.0, 1.0, 1.0, 1.0, 1, 1.0),
        ],
        FACTS,
    )


def as_map(cells):
    return {(r.rowkey.split("|")[1], f"{r.family}:{r.qualifier}"): r.value for r in cells.collect()}


def test_published_cells(facts):
    got = as_map(c.to_cells(facts))
    assert got == {
        ("BTCUSDT", "price:avg"): "92840.54",
        ("BTCUSDT", "volume:sum"): "19.974790000000013",
        ("BTCUSDT", "volume:count"): "781",
        ("BTCUSDT", "correlation:btc_usdpln_63d"): "0.25",
        ("ETHUSDT", "metrics:ret_1d"): "0.5",
        ("ETHUSDT", "price:avg"): "3000.0",
    }
    extended = as_map(c.to_cells(facts, c.EXTENDED_CELLS))
    assert extended["BTCUSDT", "volume:quote"] == "1.0"
    assert extended["ETHUSDT", "price:close"] == "3000.0"


def test_get(facts):
    cells = c.to_cells(facts)
    assert c.get_row(cells, "2|BTCUSDT|20260105").count() == 4
    assert c.get_row(cells, "2|BTCUSDT|20260105", "volume").count() == 2
    assert c.get_row(cells, "2|BTCUSDT|20260106").count() == 0


def test_scan_counts_rows_not_cells(spark):
    cells = spark.createDataFrame(
        [(f"{i}|S|20240101", "f", f"q{j}", "v") for i in range(5) for j in range(3)],
        "rowkey string, family string, qualifier string, value string",
    )
    assert c.scan_rows(cells, 2).count() == 6
    assert {r.rowkey[0] for r in c.scan_rows(cells, 9, "1", "3").collect()} == {"1", "2"}


def test_put_get_delete(spark):
    schema = "rowkey string, family string, qualifier string, value string, version int"
    old = spark.createDataFrame([("k", "m", "a", "1", 1), ("k", "m", "b", "2", 1), ("z", "m", "a", "3", 1)], schema)
    puts = spark.createDataFrame([("k", "m", "a", "9", 2), ("k", "m", "b", "0", 0)], schema)
    made = c.put_cells(old, puts)
    assert {(r.rowkey, r.qualifier): r.value for r in made.collect()} == {
        ("k", "a"): "9", ("k", "b"): "2", ("z", "a"): "3",
    }
    one = spark.createDataFrame([("k", "m", "a")], "rowkey string, family string, qualifier string")
    assert c.delete_cells(made, one).count() == 2
    assert c.delete_cells(made, one.select("rowkey")).count() == 1


def test_pivot_restores_the_facts(facts):
    wide = {r.rowkey.split("|")[1]: r for r in c.pivot_cells(c.to_cells(facts), version=None).collect()}
    assert float(wide["BTCUSDT"].price_avg) == 92840.54
    assert wide["BTCUSDT"].metrics_ret_1d is None
    assert wide["ETHUSDT"].correlation_btc_usdpln_63d is None


def test_pivot_takes_the_newest_version(spark):
    rows = [("k", "price", "avg", "9", 1), ("k", "price", "avg", "10", 2), ("k", "price", "avg", "8", 0)]
    cells = spark.createDataFrame(rows, "rowkey string, family string, qualifier string, value string, version int")
    assert c.pivot_cells(cells).first().price_avg == "10"


def test_put_command_text(spark):
    cells = spark.createDataFrame(
        [("2|BTCUSDT|20260105", "price", "avg", "92840.54"), ("1|A'B|20260105", "p", "q", "\\'")],
        "rowkey string, family string, qualifier string, value string",
    )
    got = [r.v for r in cells.select(c.put_command().alias("v")).collect()]
    assert got[0] == "put 'finance:facts_daily', '2|BTCUSDT|20260105', 'price:avg', '92840.54'"
    assert got[1] == "put 'finance:facts_daily', '1|A\\'B|20260105', 'p:q', '\\\\\\''"


def tables(spark, corr=0.5, ret=0.1, close=1.0):
    return {
        "fx_daily_returns": spark.createDataFrame([(None,), (ret,)], "ret_1d double"),
        "crypto_daily": spark.createDataFrame([(close, None)], "close double, ret_1d double"),
        "corr_btc_usdpln_63d": spark.createDataFrame([(None,), (corr,)], "corr_btc_usdpln_63d double"),
        "crypto_monthly_facts": spark.createDataFrame(
            [(1.0, None, None)], "last_close double, avg_ret_1d double, vol_ret double"
        ),
    }


def test_report_passes(spark):
    report = quality_report(tables(spark))
    assert report.count() == 11 and report.filter("NOT passed").count() == 0
    enforce(report)


@pytest.mark.parametrize(
    "broken, name",
    [({"corr": 1.001}, "corr_in_range"), ({"corr": float("nan")}, "corr_in_range"),
     ({"ret": -10.5}, "fx_daily_returns.abs_ret_1d_within_limit"), ({"close": 0.0}, "close_positive")],
)
def test_report_fails(spark, broken, name):
    with pytest.raises(QualityError, match=name):
        enforce(quality_report(tables(spark, **broken)))


def test_all_failures_are_listed(spark):
    with pytest.raises(QualityError, match="close_positive.*corr_in_range"):
        enforce(quality_report(tables(spark, corr=-2.0, close=-1.0)))


def test_empty_table_fails(spark):
    empty = spark.createDataFrame([], "x int")
    [row] = run_checks("t", empty, []).collect()
    assert (row.check_name, row.rows, row.violations, row.passed) == ("not_empty", 0, 1, False)
    report = run_checks("t", empty, [Check("x_positive", F.col("x") <= 0)])
    assert [r.passed for r in report.orderBy("check_name").collect()] == [False, True]


def test_one_scan_per_table(spark, tmp_path):
    spark.range(5).selectExpr("id * 1.0D AS close", "0.0D AS ret_1d").write.parquet(str(tmp_path / "t"))
    report = quality_report({"crypto_daily": spark.read.parquet(str(tmp_path / "t"))})
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
