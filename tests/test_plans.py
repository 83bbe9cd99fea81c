"""Shape of the physical plans: what must hold at any data size."""

import re

import pytest

import __spark_entry__ as entry
from marketlake.plans import inputs
from marketlake.operators.bars import bars, daily_close, daily_summary, daily_volume
from marketlake.operators.cells import get_row, scan_rows
from marketlake.operators.coverage import latest_common
from marketlake.operators.returns import simple_return
from marketlake.operators.series import Blocks

SF_DIR = "/root/testdata/sf0.001"
LAZY = [n for n in entry.queries() if not n.startswith(("lake_", "stream_"))]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_query_joins_all_with_all_or_windows_all(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text
    for line in text.splitlines():
        # Window [functions], [partition], [order]: the partition is never empty
        if re.match(r"[\s:+\-*()\d]*Window \[", line):
            assert ", [], [" not in line
        if "SinglePartition" in line:
            assert name in {
                "coverage_latest_common_date", "coverage_latest_hour", "date_count_sql",
                "quality_report_all", "cells_upload_count", "cells_scan_limit",
            }


def test_scans_read_only_needed_columns(spark):
    text = plan(daily_volume(inputs.hourly(spark, SF_DIR)))
    [schema] = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ts", "event_type", "value", "props"}


def test_entity_filter_reaches_the_scan(spark):
    text = plan(inputs.daily(spark, SF_DIR).filter("symbol = 'click'"))
    assert "EqualTo(event_type,click)" in text


def test_bars_are_aggregated_before_the_one_shuffle(spark):
    text = plan(bars(inputs.ticks(spark, SF_DIR)))
    assert text.count("Exchange") == 1 and text.count("ObjectHashAggregate") == 2


def test_daily_rollups_of_stored_bars_are_hash_aggregates(spark, tmp_path):
    inputs.hourly(spark, SF_DIR).write.parquet(str(tmp_path / "bars"))
    stored = spark.read.parquet(str(tmp_path / "bars"))
    for made in (daily_close(stored), daily_volume(stored), daily_summary(stored)):
        text = plan(made)
        assert "SortAggregate" not in text and text.count("Exchange") == 1


def test_common_date_shuffles_distinct_dates_only(spark):
    a = inputs.table(spark, SF_DIR, "orders").selectExpr("CAST(o_orderdate AS DATE) AS date")
    text = plan(latest_common(a, a))
    assert "Join" not in text
    assert text.index("partial_bit_or") > text.index("hashpartitioning(date")


def test_point_get_prunes_the_date_and_pushes_the_key(spark, tmp_path):
    root = str(tmp_path / "cells")
    spark.sql(
        "SELECT '2|A|20260105' AS rowkey, 'f' AS family, 'q' AS qualifier, 'v' AS value, "
        "DATE'2026-01-05' AS date"
    ).write.partitionBy("date").parquet(root)
    text = plan(get_row(spark.read.parquet(root), "2|A|20260105"))
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ = 2026-01-05", text)
    assert "EqualTo(rowkey,2|A|20260105)" in text


def test_scan_is_a_distributed_top_k(spark):
    cells = spark.range(100).selectExpr("CAST(id AS STRING) AS rowkey", "id AS v")
    assert "TakeOrderedAndProject" in plan(scan_rows(cells, 10))


def test_a_cut_series_is_shuffled_once(spark, tmp_path):
    root = str(tmp_path / "ticks")
    spark.range(2_000).selectExpr(
        "'hot' AS symbol", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts",
        "id AS trade_id", "CAST(id AS DOUBLE) AS price", "'wide' AS other",
    ).write.parquet(root)
    made = simple_return(
        spark.read.parquet(root), "symbol", ("ts", "trade_id"), "price", blocks=Blocks("1 minute", 100)
    )
    text = plan(made)
    schemas = [{c.split(":")[0] for c in s.split(",")} for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]
    assert sorted(map(len, schemas)) == [2, 5]  # the counts read the entity and the time alone
    assert len(re.findall(r" Exchange hashpartitioning\(symbol#\d+, _block#", text)) == 1
    # rows go from their scan to the shuffle by block past a broadcast of the cuts
    rows = text[text.index("_block#") :]
    assert "SortMergeJoin" not in rows and "BroadcastHashJoin" in rows
    assert made.count() == 2_000
