import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators.quality import QualityError
from marketlake.plans import cli, jobs
from marketlake.plans.shared import shared_folder
from marketlake.schemas import FX_DAILY
from marketlake.sinks import cells as cell_sinks
from marketlake.sinks import tables as sink
from marketlake.sinks.topics import topic_records

D = dt.date
KV = "v int, date date"


def values(spark, root, *columns):
    return sorted(tuple(r) for r in spark.read.parquet(root).select(*columns).collect())


def test_dynamic_and_static_overwrite(spark, tmp_path):
    root = str(tmp_path / "t")
    two = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 2))], KV)
    one = spark.createDataFrame([(9, D(2024, 1, 2))], KV)
    sink.replace_partitions(two, root, ["date"])
    sink.replace_partitions(one, root, ["date"])
    assert values(spark, root, "v") == [(1,), (9,)]
    sink.replace_table(one, root, ["date"])
    assert values(spark, root, "v") == [(9,)]
    sink.replace_table(two.drop("date"), str(tmp_path / "u"))
    assert values(spark, str(tmp_path / "u"), "v") == [(1,), (2,)]


FX = "fx_date date, code string, currency string, mid double, load_ts timestamp, year int, month int"


def fx(spark, *rows):
    full = [(d, c, "x", mid, dt.datetime(2024, 1, 1, load), d.year, d.month) for d, c, mid, load in rows]
    return spark.createDataFrame(full, FX)


def put_fx(spark, df, root, partitions=()):
    sink.upsert_partitions(
        spark, df, root, FX_DAILY, ("fx_date", "code"), ("load_ts",), ("year", "month"), partitions
    )


def test_month_upsert(spark, tmp_path):
    root = str(tmp_path / "fx")
    put_fx(spark, fx(spark, (D(2024, 1, 1), "USD", 1.0, 1), (D(2024, 1, 2), "USD", 2.0, 1), (D(2024, 2, 1), "USD", 3.0, 1)), root)
    # one day again: the rest of the month and the other month stay
    put_fx(spark, fx(spark, (D(2024, 1, 2), "USD", 2.5, 2)), root)
    assert values(spark, root, "fx_date", "mid") == [(D(2024, 1, 1), 1.0), (D(2024, 1, 2), 2.5), (D(2024, 2, 1), 3.0)]
    # an older load loses, a tie goes to the incoming row
    put_fx(spark, fx(spark, (D(2024, 1, 2), "USD", 7.0, 0), (D(2024, 2, 1), "USD", 8.0, 1)), root)
    assert values(spark, root, "mid") == [(1.0,), (2.5,), (8.0,)]


def test_upsert_with_named_partitions(spark, tmp_path):
    root = str(tmp_path / "fx")
    january = [{"year": 2024, "month": 1}]
    put_fx(spark, fx(spark, (D(2024, 1, 1), "USD", 1.0, 1), (D(2024, 2, 1), "USD", 3.0, 1)), root)
    put_fx(spark, fx(spark, (D(2024, 1, 2), "USD", 2.0, 1)), root, january)
    assert values(spark, root, "mid") == [(1.0,), (2.0,), (3.0,)]
    with pytest.raises(Exception, match="outside the partitions"):
        put_fx(spark, fx(spark, (D(2024, 2, 2), "USD", 2.0, 1)), root, january)
    assert values(spark, root, "mid") == [(1.0,), (2.0,), (3.0,)]


def test_unreadable_table_is_not_taken_for_an_absent_one(spark, tmp_path):
    root = tmp_path / "fx" / "year=2024" / "month=1"
    os.makedirs(root)
    (root / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        put_fx(spark, fx(spark, (D(2024, 1, 2), "USD", 2.0, 1)), str(tmp_path / "fx"))
    assert (root / "part-0.parquet").exists()


def test_rejects_of_the_folders_read_are_replaced(spark, tmp_path):
    root = str(tmp_path / "errors")
    bad = spark.createDataFrame([("x", "price", 1), ("y", "price", 2)], "line string, reject_reason string, f int")
    put = lambda df, read=None: sink.replace_rejects(spark, df, root, ("f",), read)
    put(bad)
    put(bad)
    assert values(spark, root, "line") == [("x",), ("y",)]
    put(bad.filter("f = 2"), bad.filter("f = 2"))
    assert values(spark, root, "line") == [("x",), ("y",)]
    put(bad.filter("false"), bad.filter("f = 1"))
    assert values(spark, root, "line") == [("y",)]
    put(bad.filter("false"))
    assert spark.read.schema("line string, f int").parquet(root).count() == 0
    with pytest.raises(ValueError):
        sink.replace_rejects(spark, bad.drop("reject_reason"), root, ("f",))


def test_topic_records(spark):
    df = spark.createDataFrame([("A", 1.5)], "symbol string, price double")
    row = topic_records(df).first()
    assert row.key == "A" and json.loads(row.value) == {"symbol": "A", "price": 1.5}


def test_upload(spark, tmp_path):
    folder = str(tmp_path)

    class FileClient:
        """Stores puts as lines of one file per connection."""

        def __init__(self):
            import uuid

            self.file = open(f"{folder}/{uuid.uuid4().hex}", "w")

        def put(self, cells):
            assert len(cells) <= 100
            self.file.writelines("|".join(c) + "\n" for c in cells)

        def close(self):
            self.file.close()

    cells = spark.range(2500).selectExpr(
        "CAST(id AS STRING) AS rowkey", "'f' AS family", "'q' AS qualifier", "'v' AS value"
    )
    sent = cell_sinks.upload_cells(cells, FileClient, 100)
    assert sent.first().puts == 2500
    assert sum(len(open(f"{folder}/{f}").readlines()) for f in os.listdir(folder)) == 2500


# --- flows -----------------------------------------------------------------------

HEADER = "symbol,price,quantity,event_time,trade_id"


def ms(day, hour, minute=0, second=0):
    at = dt.datetime(2026, 1, day, hour, minute, second, tzinfo=dt.timezone.utc)
    return int(at.timestamp() * 1000)


def land(lake, day, hour, rows, name="00"):
    folder = f"{lake.raw_ticks}/date=2026-01-{day:02d}/hour={hour:02d}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{day:02d}-{hour:02d}-{name}.csv", "w") as f:
        f.write("\n".join([HEADER, *rows]) + "\n")


def land_rate(lake, day, code, mid):
    folder = f"{lake.raw_rates}/date=2026-01-{day:02d}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/nbp_rate_{code}_202601{day:02d}.json", "w") as f:
        json.dump({"currency": "x", "code": code, "mid": mid}, f)


@pytest.fixture
def lake(tmp_path):
    made = jobs.Lake(str(tmp_path / "lake"))
    price = {5: 100, 6: 110, 7: 99, 8: 120}
    for day, p in price.items():
        land(made, day, 10, [f"BTCUSDT,{p - 1},1,{ms(day, 10)},{day}1", f"BTCUSDT,bad,1,{ms(day, 10)},{day}2"])
        land(made, day, 23, [f"BTCUSDT,{p},2,{ms(day, 23)},{day}3"])
        if day != 8:
            land_rate(made, day, "USD", 4 + day / 10)
            land_rate(made, day, "EUR", 5.0)
    return made


def bars(spark, lake):
    rows = lake.read(spark, "trades_agg_hourly").orderBy("date", "hour").collect()
    return [(r.date.day, r.hour, r.price_open, r.price_close, r.trade_count) for r in rows]


def test_late_tick_never_shrinks_a_bar(spark, lake):
    # a tick of 5th 23:59:59 lands in the first folder of the 6th
    land(lake, 6, 0, [f"BTCUSDT,101,1,{ms(5, 23, 59, 59)},54"])
    jobs.tick_etl(spark, lake)
    whole = bars(spark, lake)
    assert (5, 23, 100.0, 101.0, 2) in whole and len(whole) == 8
    for day, hour in (("2026-01-05", None), ("2026-01-06", None), ("2026-01-05", 23)):
        jobs.tick_etl(spark, lake, day, hour)
        assert bars(spark, lake) == whole


def test_tick_job_counts_and_rejects(spark, lake):
    seen = jobs.tick_etl(spark, lake, "2026-01-05")
    assert seen["rejected"] == 4  # without an index of the folders all are read
    bad = lambda: sorted(
        (r.trade_id, r.reject_reason, r.folder_date.day) for r in spark.read.parquet(f"{lake.rejects}/ticks").collect())
    assert bad() == [(52, "price", 5), (62, "price", 6), (72, "price", 7), (82, "price", 8)]
    assert bars(spark, lake) == [(5, 10, 99.0, 99.0, 1), (5, 23, 100.0, 100.0, 1)]
    jobs.tick_etl(spark, lake)
    assert len(bad()) == 4  # once, whatever runs have seen it


def test_an_hour_without_ticks_loses_its_bar(spark, lake):
    jobs.tick_etl(spark, lake)
    land(lake, 5, 10, [f"BTCUSDT,bad,1,{ms(5, 10)},51"])
    jobs.tick_etl(spark, lake, "2026-01-05")
    left = bars(spark, lake)
    assert [b for b in left if b[0] == 5] == [(5, 23, 100.0, 100.0, 1)] and len(left) == 7


def test_a_folder_the_index_does_not_know_is_read(spark, lake):
    jobs.tick_etl(spark, lake)
    # another tool adds a file to a known folder and a new folder
    land(lake, 5, 10, [f"BTCUSDT,90,1,{ms(5, 10, 5)},57"], "later")
    land(lake, 9, 1, [f"BTCUSDT,91,1,{ms(6, 10, 5)},58"])
    jobs.tick_etl(spark, lake, "2026-01-06")
    after_day = bars(spark, lake)
    assert (6, 10, 109.0, 91.0, 2) in after_day and (5, 10, 99.0, 99.0, 1) in after_day and len(after_day) == 8
    # the first folder was read as unknown then, and is known as one of the 5th now
    jobs.tick_etl(spark, lake, "2026-01-05", 10)
    assert (5, 10, 99.0, 90.0, 2) in bars(spark, lake)


def test_an_incomplete_index_loses_no_bar(spark, tmp_path):
    made = jobs.Lake(str(tmp_path / "lake"))
    for day in (1, 2):
        for k in range(3):
            land(made, day, k, [f"BTCUSDT,{k + 1},1,{ms(day, k)},{day}{k}"])
        if day == 1:
            jobs.tick_etl(spark, made)
    jobs.tick_etl(spark, made)
    whole = bars(spark, made)
    assert len(whole) == 6
    # an index that names folders of the first day only
    index = spark.read.parquet(made.tick_index)
    kept = index.filter("date = date'2026-01-01'").toPandas()
    kept = spark.createDataFrame(kept.astype(object).where(kept.notna(), None), index.schema)
    kept.write.mode("overwrite").parquet(made.tick_index)
    jobs.tick_etl(spark, made, "2026-01-02")
    assert bars(spark, made) == whole


def test_a_full_run_drops_hours_that_turned_bad(spark, lake):
    jobs.tick_etl(spark, lake)
    for hour in (10, 23):
        land(lake, 5, hour, [f"BTCUSDT,bad,1,{ms(5, hour)},51"])
    jobs.tick_etl(spark, lake)
    assert {b[0] for b in bars(spark, lake)} == {6, 7, 8}


def test_staging_is_emptied(spark, lake):
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(base))
    jobs.tick_etl(spark, lake, "2026-01-05")
    new = [f for f in os.listdir(base) if f not in before]
    assert new and all(spark.read.parquet(f"{base}/{f}").count() == 0 for f in new)


def test_replays_are_dropped_on_request(spark, lake):
    land(lake, 5, 10, [f"BTCUSDT,99,1,{ms(5, 10)},51"], "01")
    jobs.tick_etl(spark, lake, "2026-01-05", 10)
    assert bars(spark, lake)[0][-1] == 2
    jobs.tick_etl(spark, lake, "2026-01-05", 10, dedup_on=("symbol", "trade_id"))
    assert bars(spark, lake)[0][-1] == 1


def test_rate_job_merges(spark, lake):
    jobs.rate_etl(spark, lake, "2026-01-05")
    jobs.rate_etl(spark, lake, "2026-01-06")
    land_rate(lake, 5, "USD", 9.9)
    jobs.rate_etl(spark, lake, "2026-01-05")
    rows = lake.read(spark, "fx_daily").orderBy("fx_date", "code").collect()
    assert [(r.fx_date.day, r.code, r.mid) for r in rows] == [
        (5, "EUR", 5.0), (5, "USD", 9.9), (6, "EUR", 5.0), (6, "USD", 4.6),
    ]


def test_full_run(spark, lake):
    assert jobs.latest_common_day(spark, lake, "full_run_test") == "2026-01-07"
    jobs.rate_etl(spark, lake)
    jobs.tick_etl(spark, lake)
    assert jobs.full_run(spark, lake) == "2026-01-07"
    rates = lake.read(spark, "fx_daily_returns").filter("code = 'USD'").orderBy("fx_date").collect()
    assert rates[0].ret_1d is None and rates[1].ret_1d == pytest.approx(4.6 / 4.5 - 1)
    corr = lake.read(spark, "corr_btc_usdpln_63d").orderBy("date").collect()
    assert [r.date.day for r in corr] == [5, 6, 7]
    assert corr[1].corr_btc_usdpln_63d is None and abs(corr[2].corr_btc_usdpln_63d) <= 1 + 1e-9
    monthly = lake.read(spark, "crypto_monthly_facts").first()
    assert (monthly.days_ret, monthly.last_close) == (3, 120.0)
    cells = spark.read.parquet(lake.cells)
    assert {r.date.day for r in cells.collect()} == {7}
    # earlier dates stay when another date is served, and a repeat changes nothing
    jobs.serving(spark, lake, "2026-01-05")
    jobs.serving(spark, lake, "2026-01-05")
    got = spark.read.parquet(lake.cells).groupBy("date").count().orderBy("date").collect()
    assert [(r.date.day, r["count"]) for r in got] == [(5, 3), (7, 5)]


def test_repeat_gives_the_same_tables(spark, lake):
    def run():
        jobs.rate_etl(spark, lake)
        jobs.tick_etl(spark, lake)
        jobs.analytics(spark, lake)
        return {
            name: sorted(map(str, lake.read(spark, name).drop("load_ts").collect()))
            for name in ("fx_daily", "trades_agg_hourly", *jobs.CHECKED)
        }

    assert run() == run()


def test_failed_checks_stop_the_run(spark, lake):
    land(lake, 8, 23, [f"BTCUSDT,-5,1,{ms(8, 23, 1)},99"], "01")
    jobs.rate_etl(spark, lake)
    jobs.tick_etl(spark, lake)
    jobs.analytics(spark, lake)
    with pytest.raises(QualityError, match="close_positive"):
        jobs.checks(spark, lake)
    assert cli.main(["checks", lake.root]) == 1


def test_cli(spark, lake, capsys):
    assert cli.main(["rates", lake.root, "--date", "2026-01-05", "--debug"]) == 0
    assert cli.main(["ticks", lake.root, "--date", "2026-01-05", "--hour", "10", "--debug"]) == 0
    assert "'rejected'" in capsys.readouterr().out
    assert bars(spark, lake) == [(5, 10, 99.0, 99.0, 1)]
    assert cli.main(["analytics", lake.root]) == 0
    assert cli.main(["checks", lake.root, "--debug"]) == 0
    assert cli.main(["serving", lake.root, "--date", "2026-01-05"]) == 0
    assert spark.read.parquet(lake.cells).count() == 3
    with pytest.raises(SystemExit):
        cli.main(["rates", lake.root, "--hour", "3"])
    with pytest.raises(SystemExit):
        cli.main(["ticks", lake.root, "--date", "2026-01-05", "--hour", "24"])


def test_shared_folder(spark):
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))
