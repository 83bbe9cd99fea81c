import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from marketlake.functions import ntz_to_epoch_ms
from marketlake.operators.bars import MEASURES, bars
from marketlake.operators.cleaning import normalize_ticks, parse_trades, valid_rows
from marketlake.sources.ticks import read_tick_csv
from marketlake.streaming import bars as sb
from marketlake.streaming import ticks as st

TICKS = "symbol string, price double, quantity double, trade_id bigint, event_ts timestamp_ntz"


def at(hour, minute):
    return dt.datetime(2024, 1, 1, hour, minute)


@pytest.fixture
def three_files(spark, tmp_path):
    """Three micro-batches: hours 0 and 1, then hours 1 and 2, then a very late tick."""
    root = str(tmp_path / "in")
    first = [("A", float(i), 1.0, i, at(i // 30, i % 30)) for i in range(60)]
    second = [("A", 100.0 + i, 1.0, 100 + i, at(1 + i // 20, 30 + i % 20)) for i in range(40)]
    late = [("A", 7.0, 1.0, 999, at(0, 5))]
    seen = set()
    for i, rows in enumerate((first, second, late)):
        spark.createDataFrame(rows, TICKS).coalesce(1).write.mode("append").parquet(root)
        new = {f for f in os.listdir(root) if f.endswith(".parquet")} - seen
        seen |= new
        for f in new:  # the stream takes files by age
            os.utime(f"{root}/{f}", (1.7e9 + i, 1.7e9 + i))
    return root


def as_set(df):
    return {tuple(r) for r in df.select("symbol", "bucket_start_ts", *MEASURES).collect()}


def stream(spark, root, delay):
    ticks = st.stream_table(spark, root, TICKS, max_files=1)
    return sb.stream_bars(st.with_event_time(ticks, delay))


def batch(spark, root):
    return bars(spark.read.schema(TICKS).parquet(root))


def test_updates_equal_batch(spark, three_files, tmp_path):
    made = stream(spark, three_files, "3 hours")
    sb.start_bar_updates(made, f"{tmp_path}/log", f"{tmp_path}/ck").awaitTermination()
    log = spark.read.parquet(f"{tmp_path}/log")
    assert log.select("batch").distinct().count() >= 2
    assert as_set(sb.current_bars(spark, f"{tmp_path}/log")) == as_set(batch(spark, three_files))


def test_late_tick_is_left_to_the_batch_rebuild(spark, three_files, tmp_path):
    made = stream(spark, three_files, "10 minutes")
    sb.start_closed_bars(made, f"{tmp_path}/bars", f"{tmp_path}/ck").awaitTermination()
    got = {r.bucket_start_ts.hour: r for r in spark.read.parquet(f"{tmp_path}/bars").collect()}
    whole = {r.bucket_start_ts.hour: r for r in batch(spark, three_files).collect()}
    assert got[0].trade_count == 30 and whole[0].trade_count == 31
    assert tuple(got[1][m] for m in MEASURES) == tuple(whole[1][m] for m in MEASURES)
    assert 2 not in got  # still open


def test_restart_goes_on_where_it_stopped(spark, three_files, tmp_path):
    for _ in range(2):
        made = stream(spark, three_files, "3 hours")
        sb.start_bar_updates(made, f"{tmp_path}/log", f"{tmp_path}/ck").awaitTermination()
    assert as_set(sb.current_bars(spark, f"{tmp_path}/log")) == as_set(batch(spark, three_files))


def test_dedup_across_batches(spark, tmp_path):
    root = str(tmp_path / "in")
    row = [("A", 1.0, 1.0, 1, at(0, 1))]
    for _ in range(3):
        spark.createDataFrame(row, TICKS).coalesce(1).write.mode("append").parquet(root)
    ticks = st.with_event_time(st.stream_table(spark, root, TICKS, 1), "10 minutes")
    (
        st.dedup_stream(ticks).writeStream.format("parquet")
        .option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck")
        .trigger(**st.AVAILABLE_NOW).start().awaitTermination()
    )
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1


def payload(**changes):
    base = {"e": "aggTrade", "E": 1704067200000, "s": "A", "a": 1, "p": "1", "q": "2", "T": 1704067200000}
    return json.dumps({**base, **changes})


def test_routing_and_repeat_of_a_batch(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "x.txt").write_text("\n".join([payload(), payload(p="x"), "{", payload(a=2)]) + "\n")
    parsed = parse_trades(st.stream_text(spark, str(tmp_path / "in")))
    valid, bad = f"{tmp_path}/valid", f"{tmp_path}/bad"
    st.start_routing(parsed, valid, bad, f"{tmp_path}/ck").awaitTermination()
    assert sorted(r.trade_id for r in spark.read.parquet(valid).collect()) == [1, 2]
    assert sorted(r.reject_reason for r in spark.read.parquet(bad).collect()) == ["malformed", "type_p"]
    # the same batch again, as after a failure between the two writes
    again = parse_trades(spark.read.text(str(tmp_path / "in")))
    st.route_batch(valid, bad)(again, 0)
    assert spark.read.parquet(valid).count() == 2 and spark.read.parquet(bad).count() == 2


def test_landing_is_readable_by_the_batch_job(spark, three_files, tmp_path):
    ticks = st.stream_table(spark, three_files, TICKS, 1)
    epoch_ms = ntz_to_epoch_ms("event_ts")
    columns = ("symbol", "price", "quantity", "event_time", "trade_id")
    st.start_landing(
        ticks.withColumn("event_time", epoch_ms), f"{tmp_path}/raw", f"{tmp_path}/ck", columns, st.AVAILABLE_NOW
    ).awaitTermination()
    valid = valid_rows(normalize_ticks(read_tick_csv(spark, f"{tmp_path}/raw")))
    assert valid.count() == 101
    assert valid.filter(F.hour("event_ts") != F.col("folder_hour")).count() == 0


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/New_York"])
def test_ntz_event_time_is_kept_in_another_zone(spark, three_files, tmp_path, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        made = stream(spark, three_files, "3 hours")
        sb.start_bar_updates(made, f"{tmp_path}/log", f"{tmp_path}/ck").awaitTermination()
        got = as_set(sb.current_bars(spark, f"{tmp_path}/log"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # half-hour zones must not shift hourly buckets
    assert got == as_set(batch(spark, three_files))
