import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake import functions as fn


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.fixture
def new_york(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_epoch_ms_does_not_depend_on_the_session_zone(new_york):
    # 2024-03-10 02:30 does not exist in New York
    row = one(
        new_york,
        a=fn.epoch_ms_to_ts(F.lit("1710037800000")),
        b=fn.epoch_ms_to_ts(F.lit("1672515782136")),
        c=fn.instant_to_ntz(fn.ntz_to_instant(fn.epoch_ms_to_ts(F.lit("1710037800000")))),
        d=fn.ntz_to_epoch_ms(fn.epoch_ms_to_ts(F.lit("1710037800000"))),
    )
    assert row.a == dt.datetime(2024, 3, 10, 2, 30)
    assert row.b == dt.datetime(2022, 12, 31, 19, 43, 2, 136000)
    assert row.c == row.a
    assert row.d == 1710037800000


def test_instants_round_trip(new_york):
    stamps = ["1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "2024-03-10 02:30:00.000001",
              "2024-11-03 01:30:00", "9999-12-31 23:59:59.999999", "0001-01-01 00:00:00"]
    df = new_york.createDataFrame([(s,) for s in stamps], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("t")
    )
    back = df.filter(fn.instant_to_ntz(fn.ntz_to_instant("t")) == F.col("t"))
    assert back.count() == len(stamps)
    first = df.orderBy("t").select(fn.ntz_to_epoch_ms("t").alias("ms")).collect()
    assert first[1].ms == -1 and first[2].ms == 0


@pytest.mark.parametrize("text", ["", "abc", "NaN", "Infinity", "9" * 25, None])
def test_unreadable_epoch_is_null(spark, text):
    assert one(spark, x=fn.epoch_ms_to_ts(F.lit(text).cast("string"))).x is None


def test_to_double_and_ratio(spark):
    row = one(
        spark,
        good=fn.to_double(F.lit(" 1.5 ")),
        bad=fn.to_double(F.lit("1,5")),
        change=fn.ratio_change(F.lit(3.0), F.lit(2.0)),
        by_zero=fn.ratio_change(F.lit(3.0), F.lit(0.0)),
    )
    assert (row.good, row.bad, row.change, row.by_zero) == (1.5, None, 0.5, None)


@pytest.mark.parametrize(
    "name, day",
    [
        ("nbp_rate_USD_20260105.json", dt.date(2026, 1, 5)),
        ("nbp_rate_USD_20260230.json", None),
        ("nbp_rate_USD_2026.json", None),
        ("20250101_nbp_rate_EUR_20260106.json", dt.date(2026, 1, 6)),
    ],
)
def test_file_name_date(spark, name, day):
    assert one(spark, x=fn.file_name_date(F.lit(name))).x == day


def test_published_row_key(spark):
    day = F.lit("2026-01-05").cast("date")
    row = one(
        spark,
        key=fn.row_key(F.lit("BTCUSDT"), day),
        no_symbol=fn.row_key(F.lit(None).cast("string"), day),
        no_day=fn.row_key(F.lit("BTCUSDT"), F.lit(None).cast("date")),
    )
    assert (row.key, row.no_symbol, row.no_day) == ("2|BTCUSDT|20260105", None, None)


def test_salt_is_a_digit(spark):
    salts = spark.range(50_000).select(
        fn.salt(F.col("id").cast("string"), F.lit("2024-01-01").cast("date")).alias("s")
    )
    assert sorted(r.s for r in salts.distinct().collect()) == list(range(10))


def test_path_attributes(spark):
    ts = F.lit("2024-01-05 03:07:59").cast("timestamp_ntz")
    row = one(spark, **fn.path_attributes(ts))
    assert (row.date, row.hour, row.minute_name) == (dt.date(2024, 1, 5), 3, "05-03-07")
