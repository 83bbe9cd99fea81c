"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` (default 8).
Each query runs once to warm up and then ``BENCH_RUNS`` times (default 3) into the
``noop`` sink, which computes every row and column; the best run counts. Queries that write
tables run once. All registered queries are timed; the value adds up the headline ones.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from marketlake.plans import queries as q  # noqa: E402
from marketlake.plans.session import SUGGESTED  # noqa: E402

HEADLINE = (
    q.tick_normalize, q.trade_parse, q.trade_dedup, q.rates_document_explode,
    q.bars_hourly, q.bars_daily, q.bars_minute, q.bars_daily_close, q.volume_daily,
    q.returns_simple_events, q.returns_simple_rates, q.returns_ticks, q.rolling_vol_21,
    q.rates_latest_wins, q.rates_upsert_month, q.series_join_inner,
    q.rolling_moment_sums, q.rolling_corr_pairs, q.rolling_corr_compat,
    q.facts_monthly, q.facts_monthly_rates, q.facts_assembled,
    q.rowkeys, q.cells_unpivot, q.cells_point_get, q.cells_scan_limit, q.cells_upsert,
    q.cells_pivot_back, q.topk_partition_sql, q.coverage_latest_common_date,
    q.coverage_latest_hour, q.quality_report_all,
    q.lake_rates_upsert, q.lake_serving_cells, q.stream_bars_hourly,
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    made = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("marketlake-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="marketlake-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SUGGESTED.items():
        made = made.config(key, value)
    spark = made.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session()
    taken = {}
    for query in (*HEADLINE, *[f for f in q.REGISTERED if f not in HEADLINE]):
        name = query.__name__
        writes = name.startswith(("lake_", "stream_"))
        if not writes:
            timed(spark, query, sf_dir)
        taken[name] = round(min(timed(spark, query, sf_dir) for _ in range(1 if writes else runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries, best warm run each",
                "value": round(sum(taken[f.__name__] for f in HEADLINE), 3),
                "unit": "sec",
                "queries": taken,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
