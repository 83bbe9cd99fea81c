import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketlake.operators.returns import rate_returns, rolling_volatility, simple_return
from marketlake.operators.series import BLOCK, HALO, Blocks, cut_series, drop_halo


def hot_series(spark):
    """One entity with most rows, one with a few, one with a single row; gaps in time."""
    rng = random.Random(7)
    rows = []
    for name, n in (("hot", 900), ("small", 40), ("single", 1)):
        at = dt.datetime(2024, 1, 1)
        for i in range(n):
            at += dt.timedelta(minutes=rng.choice([0, 1, 5, 700]))
            rows.append((name, at, i, rng.choice([0.0, 1.0, 2.5, 7.0])))
    rows += [(None, dt.datetime(2024, 1, 1, 5, k), k, 2.0 + k) for k in range(9)]
    rows += [("small", None, 2000 + k, 3.0 + k) for k in range(5)] + [(None, None, 9, 1.0)]
    return spark.createDataFrame(rows, "s string, ts timestamp_ntz, id int, v double")


@pytest.mark.parametrize("rows", [1, 2, 7, 100, 10_000])
def test_blocked_return_equals_plain(spark, rows):
    df = hot_series(spark)
    plain = simple_return(df, "s", ("ts", "id"), "v")
    cut = simple_return(df, "s", ("ts", "id"), "v", blocks=Blocks("1 day", rows))
    assert cut.columns == plain.columns
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("rows", [62, 63, 100])
def test_blocked_frame_equals_plain(spark, rows):
    df = hot_series(spark)
    plain = rolling_volatility(df, "s", ("ts", "id"), "v", 63, "vol")
    cut = rolling_volatility(df, "s", ("ts", "id"), "v", 63, "vol", Blocks("12 hours", rows))
    key = lambda r: (str(r.s), r.id)
    a, b = sorted(plain.collect(), key=key), sorted(cut.collect(), key=key)
    assert len(a) == len(b) == 956
    assert all(x.vol == pytest.approx(y.vol, abs=1e-12) for x, y in zip(a, b))


def test_halo_must_fit_a_block(spark):
    with pytest.raises(ValueError, match="halo"):
        rolling_volatility(hot_series(spark), "s", "ts", "v", 63, blocks=Blocks("1 day", 61))


def test_blocks_hold_each_row_once(spark):
    cut, _ = cut_series(hot_series(spark), ["s"], "ts", ["ts", "id"], 3, Blocks("1 day", 50))
    rows = sorted(drop_halo(cut).filter("s = 'hot'").collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == list(range(900))


@pytest.mark.parametrize("rows, halo", [(20, 3), (50, 50), (200, 1)])
def test_no_block_is_much_larger_than_asked(spark, rows, halo):
    """One day of one symbol with most rows is cut; a block of an entity holds at most ``rows`` and a
    chunk, and at least ``halo`` earlier rows where there are as many."""
    df = spark.range(3_000).select(
        F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("s"),
        F.timestamp_add("SECOND", F.col("id") * 7, F.expr("timestamp_ntz'1969-12-31 20:00:00'")).alias("ts"),
        F.col("id").cast("double").alias("v"),
    )
    cut, _ = cut_series(df, ["s"], "ts", ["ts"], halo, Blocks("1 minute", rows))
    chunk = 9  # rows of a symbol in a minute, at most
    found = cut.groupBy("s", BLOCK).agg(
        F.count_if(~F.col(HALO)).alias("own"), F.count_if(HALO).alias("fed")).collect()
    assert len(found) >= 2_700 // (rows + chunk)
    for r in found:
        assert 0 < r.own < rows + chunk
        assert r.fed < halo + chunk and (r[BLOCK] == 0 or r.fed >= halo)


def test_cuts_do_not_follow_the_session_zone(spark):
    df = hot_series(spark)
    plain = sorted(map(str, simple_return(df, "s", ("ts", "id"), "v").collect()))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("Asia/Kolkata", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            cut = simple_return(df, "s", ("ts", "id"), "v", blocks=Blocks("30 minutes", 20))
            assert sorted(map(str, cut.collect())) == plain
            zoned = df.withColumn("ts", F.col("ts").cast("timestamp"))
            cut = simple_return(zoned, "s", ("ts", "id"), "v", blocks=Blocks("1 hour", 20))
            assert sorted(map(str, cut.drop("ts").collect())) == sorted(
                map(str, simple_return(zoned, "s", ("ts", "id"), "v").drop("ts").collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_return_uses_the_previous_row(spark):
    df = spark.createDataFrame(
        [("USD", dt.date(2024, 1, 5), 4.0), ("USD", dt.date(2024, 1, 8), 5.0),
         ("USD", dt.date(2024, 1, 9), 0.0), ("USD", dt.date(2024, 1, 10), 1.0),
         ("EUR", dt.date(2024, 1, 8), 2.0)],
        "code string, fx_date date, mid double",
    )
    made = {(r.code, r.fx_date.day): r.ret_1d for r in rate_returns(df).collect()}
    assert made == {
        ("USD", 5): None, ("USD", 8): 0.25, ("USD", 9): -1.0, ("USD", 10): None, ("EUR", 8): None,
    }


def test_volatility_of_21_rows(spark):
    df = spark.range(30).select(
        F.lit("A").alias("code"), F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("d"),
        F.col("id").cast("double").alias("ret_1d"),
    )
    rows = rolling_volatility(df, "code", "d").orderBy("d").collect()
    assert rows[0].vol_21d == 0.0
    # 21 consecutive numbers
    assert rows[-1].vol_21d == pytest.approx(((21**2 - 1) / 12) ** 0.5)
