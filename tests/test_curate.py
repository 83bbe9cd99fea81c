"""Incremental runs: files read once, late ticks kept and rebuilt, batches that run again."""

import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators.bars import hourly_bars
from marketlake.operators.cleaning import normalize_ticks, valid_rows
from marketlake.sources.ticks import read_tick_csv
from marketlake.streaming.curate import Curated, curate_batch, late_hours, ledger, rebuild_late, start_curating

COLUMNS = ("symbol", "price", "quantity", "event_time", "trade_id")


def land(root, hour, name, ticks):
    """``ticks`` are (symbol, price, minute of the day, id)."""
    folder = f"{root}/date=2026-01-05/hour={hour:02d}"
    os.makedirs(folder, exist_ok=True)
    start = 1_767_571_200_000
    rows = [f"{s},{p},1,{start + m * 60_000},{i}" for s, p, m, i in ticks]
    with open(f"{folder}/{name}.csv", "w") as f:
        f.write("\n".join([",".join(COLUMNS), *rows]) + "\n")


def as_set(bars):
    return {tuple(r) for r in bars.drop("load_ts").select(sorted(set(bars.columns) - {"load_ts"})).collect()}


def run(spark, root, tables, checkpoint):
    start_curating(read_tick_csv(spark, root, COLUMNS, stream=True), tables, checkpoint, "30 minutes").awaitTermination()


@pytest.fixture
def flow(spark, tmp_path):
    root, tables = str(tmp_path / "raw"), Curated(str(tmp_path / "out"))
    land(root, 0, "a", [("A", 10 + k, 5 * k, k) for k in range(12)] + [("A", "bad", 1, 90)])
    run(spark, root, tables, str(tmp_path / "ck"))
    # beside on-time ticks of hour 1: one inside the delay, one behind the watermark
    land(root, 1, "b", [("A", 50 + k, 60 + 5 * k, 20 + k) for k in range(12)] + [("A", 7, 40, 40), ("B", 3, 2, 41)])
    run(spark, root, tables, str(tmp_path / "ck"))
    land(root, 2, "c", [("A", 1, 170, 60), ("A", 99, 61, 61)])
    run(spark, root, tables, str(tmp_path / "ck"))
    return root, tables, str(tmp_path / "ck")


def whole(spark, root):
    return as_set(hourly_bars(valid_rows(normalize_ticks(read_tick_csv(spark, root, COLUMNS)))
                              .drop("folder_date", "folder_hour")))


def test_late_ticks_are_kept_named_and_rebuilt(spark, flow):
    root, tables, checkpoint = flow
    rows = sorted(tuple(r)[:1] + tuple(r)[2:] for r in ledger(spark, tables).select(
        "batch", "last_event_ts", "ticks", "late", "rejected").collect())
    assert rows == [(0, 12, 0, 1), (1, 14, 1, 0), (2, 2, 1, 0)]
    assert spark.read.parquet(tables.ticks).count() == 28  # every valid tick once, no file twice
    assert sorted(tuple(r)[1:] for r in late_hours(spark, tables).collect()) == [(0, 1), (1, 1)]
    bars = spark.read.parquet(tables.bars)
    # hour 1 is closed for the tick of batch 2; hour 0 was rebuilt by the tick inside the delay
    assert as_set(bars) != whole(spark, root)
    assert bars.filter("symbol = 'A' and hour = 1").first().price_high == 61
    assert sorted((d.day, h) for d, h in rebuild_late(spark, tables)) == [(5, 0), (5, 1)]
    assert as_set(spark.read.parquet(tables.bars)) == whole(spark, root)
    assert late_hours(spark, tables).count() == 0 and rebuild_late(spark, tables) == []
    run(spark, root, tables, checkpoint)  # nothing new has landed
    assert ledger(spark, tables).count() == 3


def test_a_batch_that_runs_again_changes_nothing(spark, flow):
    root, tables, _ = flow
    rebuild_late(spark, tables)
    before = as_set(spark.read.parquet(tables.bars)), sorted(map(str, ledger(spark, tables).collect()))
    last = read_tick_csv(spark, root, COLUMNS).filter(F.col("folder_hour") == 2)
    curate_batch(tables, "30 minutes")(last, 2)
    assert (as_set(spark.read.parquet(tables.bars)), sorted(map(str, ledger(spark, tables).collect()))) == before
    assert spark.read.parquet(tables.ticks).count() == 28
    assert late_hours(spark, tables).count() == 0


def test_a_batch_without_a_valid_tick(spark, tmp_path):
    root, tables = str(tmp_path / "raw"), Curated(str(tmp_path / "out"))
    land(root, 0, "a", [("A", "bad", 1, 1)])
    run(spark, root, tables, str(tmp_path / "ck"))
    assert [tuple(r) for r in ledger(spark, tables).select("ticks", "late", "rejected").collect()] == [(0, 0, 1)]
    assert late_hours(spark, tables).count() == 0 and rebuild_late(spark, tables) == []
    assert spark.read.parquet(tables.rejects).count() == 1
