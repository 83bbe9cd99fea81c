"""Registered queries: every operator over the test tables, whole.

Each takes ``(spark, sf_dir)``. Derived doubles are rounded, as results are compared
by value. Queries named ``lake_*`` and ``stream_*`` write tables derived from the
inputs to the shared folder and read them back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import ntz_to_epoch_ms, path_attributes, row_key
from marketlake.operators import cells as cell_ops
from marketlake.operators.bars import bars, daily_close, daily_summary, daily_volume
from marketlake.operators.cleaning import (
    REASON,
    dedup_trades,
    normalize_ticks,
    parse_trades,
    rejected_rows,
    valid_rows,
)
from marketlake.operators.correlation import (
    correlation_table,
    join_series,
    pair_returns,
    rolling_correlation,
    rolling_sums,
)
from marketlake.operators.coverage import latest_common, latest_hour
from marketlake.operators.facts import daily_facts, monthly_facts
from marketlake.operators.latest import latest_wins, upsert
from marketlake.operators.quality import quality_report
from marketlake.operators.returns import daily_returns, rolling_volatility, simple_return
from marketlake.operators.series import Blocks
from marketlake.plans import inputs, jobs
from marketlake.plans.shared import shared_folder
from marketlake.schemas import FX_DAILY, HOURLY_BARS
from marketlake.sinks.cellstore import CellStore
from marketlake.sinks.cells import export_put_commands, upload_cells, write_cells
from marketlake.sinks.tables import (
    land_rates_json,
    land_ticks_csv,
    replace_partitions,
    replace_rejects,
    replace_table,
    upsert_partitions,
)
from marketlake.sinks.topics import topic_records
from marketlake.sources.catalog import covered, define_lake, define_table, missing_tables, sample_rows
from marketlake.sources.files import list_files, rows_per_file
from marketlake.sources.rates import explode_rate_documents, read_landed_rates, tag_rate_documents
from marketlake.sources.tables import read_table
from marketlake.sources.ticks import read_tick_csv
from marketlake.streaming.curate import Curated, late_hours, rebuild_late, start_curating
from marketlake.streaming.bars import (
    current_bars,
    start_bar_updates,
    start_closed_bars,
    stream_bars,
)
from marketlake.streaming.ticks import (
    AVAILABLE_NOW,
    dedup_stream,
    start_landing,
    start_routing,
    stream_table,
    stream_text,
    with_event_time,
)

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the registered queries.
BASE, QUOTE = "click", "view"
PAIRS = tuple(
    (flag, code)
    for flag in "ANR"
    for code in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
)
TOPK_YEAR, TOPK_MONTH, TOPK_ROWS = 1998, 3, 10
COUNT_DAY = "1998-03-02"
COVERAGE_DAY = "2024-01-15"
FALLBACK_DAY = "2001-12-31"
CELL_KEY_DAY = "20240110"
SCAN_ROWS = 10
STREAM_DELAY = "10 minutes"
SPEC = (
    ("metrics", "ret_1d", "ret_1d", None),
    ("price", "avg", "close", None),
    ("volume", "sum", "volume_sum", None),
    ("volume", "count", "trade_count_sum", None),
    ("correlation", "btc_usdpln_63d", "corr_btc_usdpln_63d", BASE),
)


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    # "+ 0.0" turns a rounded -0.0 into 0.0, as values are compared by their text
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def _rounded_bars(df: DataFrame) -> DataFrame:
    # prices have two decimals, so a mean of 32 of them can end in a half at 6 digits,
    # where engines may round either way; 9 digits compare more and meet no such tie
    # below 256 prices
    return _round(_round(_round(df, 9, "price_avg"), 6, "volume_base"), 4, "volume_quote")


# --- raw records ---------------------------------------------------------------


def tick_normalize(spark, sf_dir):
    valid = valid_rows(normalize_ticks(inputs.raw_ticks(spark, sf_dir)))
    return valid.select(
        F.col("trade_id").cast("bigint").alias("trade_id"), "symbol", "price", "quantity",
        "event_ts", *[c.alias(n) for n, c in path_attributes("event_ts").items()],
    )


def tick_rejects(spark, sf_dir):
    tagged = normalize_ticks(inputs.raw_ticks(spark, sf_dir))
    return rejected_rows(tagged).select(F.col("trade_id").cast("bigint").alias("trade_id"), REASON)


def trade_parse(spark, sf_dir):
    valid = valid_rows(parse_trades(inputs.trade_payloads(spark, sf_dir)))
    return valid.select("trade_id", "symbol", "price", "quantity", "event_time", "event_ts")


def trade_rejects(spark, sf_dir):
    return rejected_rows(parse_trades(inputs.trade_payloads(spark, sf_dir))).select(
        "event_id", REASON
    )


def trade_dedup(spark, sf_dir):
    replayed = inputs.ticks(spark, sf_dir)
    replayed = replayed.unionByName(replayed)
    return dedup_trades(replayed).select("symbol", "trade_id", "price", "quantity", "event_ts")


def json_props_extract(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k")
    )


def rates_document_explode(spark, sf_dir):
    documents = inputs.rate_documents(spark, sf_dir)
    today = F.lit(FALLBACK_DAY).cast("date")
    return explode_rate_documents(documents, today=today)


def topic_publish_records(spark, sf_dir):
    sent = topic_records(inputs.ticks(spark, sf_dir).drop("event_ts"))
    return sent.select(
        "key",
        F.get_json_object("value", "$.trade_id").cast("bigint").alias("trade_id"),
        F.get_json_object("value", "$.price").cast("double").alias("price"),
        F.get_json_object("value", "$.quantity").cast("double").alias("quantity"),
    )


# --- bars ----------------------------------------------------------------------


def bars_hourly(spark, sf_dir):
    return _rounded_bars(inputs.hourly(spark, sf_dir).drop("load_ts"))


def bars_daily(spark, sf_dir):
    return _rounded_bars(bars(inputs.ticks(spark, sf_dir), "1 day"))


def bars_minute(spark, sf_dir):
    return _rounded_bars(bars(inputs.ticks(spark, sf_dir), "1 minute"))


def bars_daily_close(spark, sf_dir):
    return daily_close(inputs.hourly(spark, sf_dir))


def volume_daily(spark, sf_dir):
    made = daily_volume(inputs.hourly(spark, sf_dir))
    return _round(made, 4, "volume_sum", "volume_quote_sum")


# --- series --------------------------------------------------------------------


def returns_simple_events(spark, sf_dir):
    return _round(inputs.daily(spark, sf_dir), 6, "ret_1d")


def returns_simple_rates(spark, sf_dir):
    return _round(inputs.rates_with_return(spark, sf_dir), 6, "ret_1d")


def returns_ticks(spark, sf_dir):
    """Tick-to-tick returns of whole series, cut into blocks."""
    made = simple_return(
        inputs.ticks(spark, sf_dir).select("symbol", "event_ts", "trade_id", "price"),
        "symbol", ("event_ts", "trade_id"), "price", out="ret", blocks=Blocks("1 minute", 1_000),
    )
    return _round(made, 6, "ret")


def rolling_vol_21(spark, sf_dir):
    made = rolling_volatility(inputs.rates_with_return(spark, sf_dir), "code", "fx_date")
    return _round(made.select("code", "fx_date", "vol_21d"), 6, "vol_21d")


def rates_latest_wins(spark, sf_dir):
    return inputs.rates(spark, sf_dir)


def rates_upsert_month(spark, sf_dir):
    """Stored final rates, upserted by all later loads; currency is new in those."""
    loads = inputs.rate_loads(spark, sf_dir)
    final = F.col("currency") == "F"
    stored = latest_wins(loads.filter(final), ("fx_date", "code"), ("load_no",))
    return upsert(
        stored.drop("currency"), loads.filter(~final), ("fx_date", "code"), ("load_no",)
    )


def series_join_inner(spark, sf_dir):
    made = inputs.daily(spark, sf_dir)
    left = made.filter(F.col("symbol") == BASE).select("date", F.col("ret_1d").alias("ret_base"))
    right = made.filter(F.col("symbol") == QUOTE).select("date", F.col("ret_1d").alias("ret_quote"))
    return _round(join_series(left, right), 6, "ret_base", "ret_quote")


def _pairs(spark, sf_dir):
    return pair_returns(
        inputs.shipped(spark, sf_dir), inputs.rates_with_return(spark, sf_dir), PAIRS
    )


def rolling_moment_sums(spark, sf_dir):
    made = rolling_sums(_pairs(spark, sf_dir)).drop("x", "y")
    return _round(made, 3, "sum_x", "sum_y", "sum_x2", "sum_y2", "sum_xy")


def rolling_corr_pairs(spark, sf_dir):
    made = rolling_correlation(_pairs(spark, sf_dir)).drop("x", "y")
    return _round(made, 6, "corr")


def rolling_corr_compat(spark, sf_dir):
    made = rolling_correlation(_pairs(spark, sf_dir), mode="compat").drop("x", "y")
    return _round(made, 6, "corr")


# --- facts and serving ---------------------------------------------------------


def facts_monthly(spark, sf_dir):
    return _round(monthly_facts(inputs.daily(spark, sf_dir)), 6, "avg_ret_1d", "vol_ret")


def facts_monthly_rates(spark, sf_dir):
    series = inputs.rates_with_return(spark, sf_dir).select(
        F.col("code").alias("symbol"), F.col("fx_date").alias("date"),
        F.col("mid").alias("close"), "ret_1d",
    )
    return _round(monthly_facts(series), 6, "avg_ret_1d", "vol_ret")


def _corr(daily):
    quotes = daily.select(F.col("symbol").alias("code"), F.col("date").alias("fx_date"), "ret_1d")
    return correlation_table(daily, quotes, BASE, QUOTE)


def _facts(spark, sf_dir):
    daily = daily_returns(daily_summary(inputs.hourly(spark, sf_dir)))
    return daily_facts(daily, None, _corr(daily))


def facts_assembled(spark, sf_dir):
    made = _round(_facts(spark, sf_dir), 6, "ret_1d", "corr_btc_usdpln_63d")
    return _round(made, 4, "volume_sum", "volume_quote_sum")


def rowkeys(spark, sf_dir):
    closes = daily_close(inputs.hourly(spark, sf_dir))
    return cell_ops.with_row_key(closes).select("symbol", "date", "rowkey")


def _cells(spark, sf_dir):
    """Cells straight from the bars, close and volumes in one pass."""
    daily = daily_returns(daily_summary(inputs.hourly(spark, sf_dir)))
    return cell_ops.to_cells(daily_facts(daily, None, _corr(daily)), SPEC)


def _numbers(cells: DataFrame) -> DataFrame:
    value = F.round(F.col("value").cast("double"), 4) + F.lit(0.0)
    return cells.withColumn("value", value)


def cells_unpivot(spark, sf_dir):
    return _numbers(_cells(spark, sf_dir))


def cells_point_get(spark, sf_dir):
    return _numbers(cell_ops.get_row(_stored_cells(spark, sf_dir, "get"), _client_key()).drop("version"))


def cells_family_get(spark, sf_dir):
    return _numbers(cell_ops.get_row(_stored_cells(spark, sf_dir, "family"), _client_key(), "volume").drop("version"))


def _client_key():
    """A client computes the key it wants; the optimizer folds this to a literal."""
    return row_key(F.lit(BASE), F.to_date(F.lit(CELL_KEY_DAY), "yyyyMMdd"))


def _stored_cells(spark, sf_dir, name):
    """The cells in a written serving table, as get, scan and pivot find them."""
    root = f"{shared_folder(spark, name)}/cells"
    write_cells(spark, _cells(spark, sf_dir).withColumn("version", F.timestamp_seconds(F.lit(1))), root, [])
    return spark.read.parquet(root).select("rowkey", "date", "family", "qualifier", "value", "version")


def _versioned(cells: DataFrame, version: int) -> DataFrame:
    return cells.select("rowkey", "family", "qualifier", "value").withColumn(
        "version", F.timestamp_seconds(F.lit(version))
    )


def _cell_store(spark, sf_dir, name) -> CellStore:
    """All cells in a stored table, at version 1."""
    store = CellStore(spark, f"{shared_folder(spark, name)}/store")
    store.load(_versioned(_cells(spark, sf_dir), 1))
    return store


def _served(store: CellStore) -> DataFrame:
    return _numbers(store.read())


def _twice(cells: DataFrame) -> DataFrame:
    return cells.withColumn("value", (F.col("value").cast("double") * 2).cast("string"))


def cells_scan_limit(spark, sf_dir):
    return _numbers(_cell_store(spark, sf_dir, "scan").scan(SCAN_ROWS).drop("version"))


def cells_upsert(spark, sf_dir):
    """All cells, then a newer version of every volume cell, at twice the value."""
    store = _cell_store(spark, sf_dir, "upsert")
    store.put(_versioned(_twice(store.read().filter(F.col("family") == "volume")), 2), "volumes")
    return _served(store).withColumn("version", F.unix_seconds("version").cast("int"))


def cells_delete(spark, sf_dir):
    """All cells without the return cells, and without the rows of one symbol."""
    store = _cell_store(spark, sf_dir, "delete")
    cells = _versioned(store.read().filter(F.col("family") == "metrics"), 2)
    rows = store.read().filter(F.col("rowkey").contains("|signup|")).select("rowkey").distinct()
    store.delete(cells, "cells")
    store.delete(rows.withColumn("version", F.timestamp_seconds(F.lit(2))), "rows")
    return _served(store).drop("version")


def cells_store_changes(spark, sf_dir):
    """Stored cells through puts, deletes of rows, families and cells, compaction and puts again.

    Returns go, the rows of one symbol go, all rows of one day go; changes are folded; one symbol's
    closes come back at twice the value; last, a put that is older than a marker stays hidden.
    """
    store = _cell_store(spark, sf_dir, "changes")
    loaded = _cells(spark, sf_dir)
    second = F.timestamp_seconds(F.lit(2))
    rows = store.read().select("rowkey", "date").distinct().withColumn("version", second)
    store.delete(rows.select("rowkey", F.lit("metrics").alias("family"), "version"), "families")
    symbol = F.split("rowkey", r"\|")[1]
    store.delete(rows.filter(symbol == "signup").select("rowkey", "version"), "symbol")
    store.delete(rows.filter(F.col("date") == F.to_date(F.lit(CELL_KEY_DAY), "yyyyMMdd")).drop("date"), "day")
    store.compact()
    closes = loaded.filter((symbol == "signup") & (F.col("family") == "price"))
    store.put(_versioned(_twice(closes), 3), "again")
    store.delete(_versioned(closes.filter(F.dayofmonth("date") % 2 == 0), 4), "even")
    store.put(_versioned(closes, 2), "late")
    return _served(store).withColumn("version", F.unix_seconds("version").cast("int"))


def cells_pivot_back(spark, sf_dir):
    wide = cell_ops.pivot_cells(_stored_cells(spark, sf_dir, "pivot"), SPEC)
    names = [c for c in wide.columns if c != "rowkey"]
    return wide.select(
        "rowkey", *[(F.round(F.col(c).cast("double"), 4) + F.lit(0.0)).alias(c) for c in names]
    )


# --- SQL, coverage, quality ----------------------------------------------------


def topk_partition_sql(spark, sf_dir):
    fx_daily = inputs.rates(spark, sf_dir).withColumns(
        {"year": F.year("fx_date"), "month": F.month("fx_date")}
    )
    return spark.sql(
        "SELECT fx_date, code, mid FROM {fx_daily} WHERE year = {year} AND month = {month} "
        "ORDER BY fx_date DESC, code LIMIT {n}",
        fx_daily=fx_daily, year=TOPK_YEAR, month=TOPK_MONTH, n=TOPK_ROWS,
    )


def date_count_sql(spark, sf_dir):
    return spark.sql(
        "SELECT count(*) AS rows FROM {fx_daily} WHERE fx_date = CAST({day} AS DATE)",
        fx_daily=inputs.rates(spark, sf_dir), day=COUNT_DAY,
    )


def coverage_latest_common_date(spark, sf_dir):
    ordered = inputs.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    shipped = inputs.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    return latest_common(ordered, shipped)


def coverage_latest_hour(spark, sf_dir):
    folders = inputs.ticks(spark, sf_dir).select(
        F.to_date("event_ts").alias("date"), F.hour("event_ts").alias("hour")
    )
    return latest_hour(folders, COVERAGE_DAY)


def quality_report_all(spark, sf_dir):
    daily = inputs.daily(spark, sf_dir)
    return quality_report(
        {
            "fx_daily_returns": inputs.rates_with_return(spark, sf_dir),
            "crypto_daily": daily,
            "corr_btc_usdpln_63d": _corr(daily),
            "crypto_monthly_facts": monthly_facts(daily),
        }
    )


# --- lake: files, tables, catalog ----------------------------------------------

TICK_HEADER = ("symbol", "price", "quantity", "event_time", "trade_id")


def _tasks(spark) -> int:
    """Writing tasks where a query makes hundreds of small hour folders."""
    return spark.sparkContext.defaultParallelism


def _landed_lake(spark, sf_dir, name, delay=None) -> jobs.Lake:
    lake = jobs.Lake(shared_folder(spark, name))
    raw = inputs.raw_ticks(spark, sf_dir).withColumnRenamed("landed_ts", "event_ts")
    if delay is not None:
        raw = raw.withColumn("event_ts", F.col("event_ts") + delay)
    land_ticks_csv(raw, lake.raw_ticks, TICK_HEADER)
    return lake


def lake_bars_from_csv(spark, sf_dir):
    lake = _landed_lake(spark, sf_dir, "bars")
    jobs.tick_etl(
        spark, lake, columns=list(TICK_HEADER), dedup_on=("symbol", "trade_id"),
        write_tasks=_tasks(spark),
    )
    return _rounded_bars(lake.read(spark, "trades_agg_hourly").drop("load_ts"))


def lake_rejects_from_csv(spark, sf_dir):
    lake = _landed_lake(spark, sf_dir, "rejects")
    tagged = normalize_ticks(read_tick_csv(spark, lake.raw_ticks))
    replace_rejects(spark, rejected_rows(tagged), f"{lake.rejects}/ticks", jobs.FOLDER)
    return spark.read.parquet(f"{lake.rejects}/ticks").select("trade_id", REASON)


def lake_rejects_rerun(spark, sf_dir):
    """The tick job on raw data with faults, then with the faulty ticks mended, by day and in full:
    the rejects of the second run are all that is left."""
    lake = _landed_lake(spark, sf_dir, "rerun")
    jobs.tick_etl(spark, lake, columns=list(TICK_HEADER))
    jobs.tick_etl(spark, lake, COVERAGE_DAY, columns=list(TICK_HEADER))
    raw = inputs.raw_ticks(spark, sf_dir).withColumnRenamed("landed_ts", "event_ts")
    mended = raw.withColumns({"price": F.coalesce(F.col("price").try_cast("double"), F.lit(1.0)).cast("string"),
                              "quantity": F.coalesce("quantity", F.lit("1"))})
    land_ticks_csv(mended, lake.raw_ticks, TICK_HEADER)
    jobs.tick_etl(spark, lake, columns=list(TICK_HEADER))
    return spark.read.parquet(f"{lake.rejects}/ticks").select("trade_id", REASON)


def lake_day_equals_full(spark, sf_dir):
    """Every seventh tick lands 26 hours late; a day and an hour run after the full run change nothing."""
    late = F.when(F.col("trade_id").cast("bigint") % 7 == 0, F.make_dt_interval(hours=F.lit(26))).otherwise(
        F.make_dt_interval())
    lake = _landed_lake(spark, sf_dir, "late", late)
    for when in ((), (COVERAGE_DAY,), (COVERAGE_DAY, 5)):
        jobs.tick_etl(
            spark, lake, *when, columns=list(TICK_HEADER), dedup_on=("symbol", "trade_id"),
            write_tasks=_tasks(spark),
        )
    return _rounded_bars(lake.read(spark, "trades_agg_hourly").drop("load_ts"))


def lake_day_mixed_landing(spark, sf_dir):
    """Ticks with even ids land as files, a full run reads them, then a stream lands the others: a day run
    finds them in folders that no index has named."""
    lake = jobs.Lake(shared_folder(spark, "mixed"))
    raw = inputs.raw_ticks(spark, sf_dir).withColumnRenamed("landed_ts", "event_ts")
    even = F.col("trade_id").cast("bigint") % 2 == 0
    land_ticks_csv(raw.filter(even), lake.raw_ticks, TICK_HEADER, tasks=_tasks(spark))
    jobs.tick_etl(spark, lake, columns=list(TICK_HEADER), write_tasks=_tasks(spark))
    rest = f"{lake.root}/rest"
    raw.filter(~even).write.parquet(rest)
    start_landing(
        stream_table(spark, rest, raw.schema), lake.streamed_ticks, f"{lake.root}/checkpoint", TICK_HEADER,
        AVAILABLE_NOW, _tasks(spark),
    ).awaitTermination()
    jobs.tick_etl(spark, lake, COVERAGE_DAY, columns=list(TICK_HEADER), write_tasks=_tasks(spark))
    return _rounded_bars(lake.read(spark, "trades_agg_hourly").drop("load_ts").filter(F.col("date") == COVERAGE_DAY))


LANDINGS = 3


def _curated(spark, sf_dir, name) -> Curated:
    """Three landings of raw files and a run after each. Dates fall into three parts; every twentieth tick
    comes one landing late."""
    root = shared_folder(spark, name)
    raw = inputs.raw_ticks(spark, sf_dir).withColumnRenamed("landed_ts", "event_ts")
    date = F.to_date("event_ts")
    span = raw.agg(F.min(date), (F.datediff(F.max(date), F.min(date)) + 1)).first()
    part = F.floor(F.datediff(date, F.lit(span[0])) * LANDINGS / F.lit(span[1])).cast("int")
    behind = (F.col("trade_id").cast("bigint") % 20 == 3).cast("int")
    parted = raw.withColumn("part", F.least(part + behind, F.lit(LANDINGS - 1)))
    tables = Curated(f"{root}/curated")
    for k in range(LANDINGS):
        land_ticks_csv(parted.filter(F.col("part") == k), f"{root}/raw", TICK_HEADER, append=True, tasks=_tasks(spark))
        start_curating(
            read_tick_csv(spark, f"{root}/raw", TICK_HEADER, stream=True), tables, f"{root}/checkpoint", STREAM_DELAY,
            tasks=_tasks(spark),
        ).awaitTermination()
    return tables


def stream_late_hours(spark, sf_dir):
    """Hours of the ticks behind the watermark, with their number: none is dropped."""
    return late_hours(spark, _curated(spark, sf_dir, "late"))


def lake_incremental(spark, sf_dir):
    """Bars of three incremental runs and a rebuild of the late hours: those of one full run."""
    tables = _curated(spark, sf_dir, "incremental")
    rebuild_late(spark, tables, tasks=_tasks(spark))
    return _rounded_bars(read_table(spark, tables.bars, HOURLY_BARS).drop("load_ts"))


def document_rejects(spark, sf_dir):
    """Documents cut short in March, and one without tables each January, with their reasons."""
    docs = inputs.rate_documents(spark, sf_dir)
    no = F.get_json_object("value", "$[0].no")
    day = F.substring_index(no, "/", 1).cast("int")
    faulty = docs.select(
        no.alias("no"),
        F.when(day.between(60, 90), F.substring("value", 1, 30)).when(day <= 31, "[]").otherwise(F.col("value")).alias("value"),
    )
    return rejected_rows(tag_rate_documents(faulty)).select("no", REASON)


def lake_day_rebuild(spark, sf_dir):
    """The tick job for one date, then again for one hour of it."""
    lake = _landed_lake(spark, sf_dir, "rebuild")
    jobs.tick_etl(spark, lake, COVERAGE_DAY)
    jobs.tick_etl(spark, lake, COVERAGE_DAY, 5)
    return _rounded_bars(lake.read(spark, "trades_agg_hourly").drop("load_ts"))


def _fx_rows(loads: DataFrame) -> DataFrame:
    stamp = F.timestamp_seconds(F.col("load_no"))
    return loads.select(
        "fx_date", "code", "currency", "mid", stamp.alias("load_ts"),
        F.year("fx_date").alias("year"), F.month("fx_date").alias("month"),
    )


def lake_rates_upsert(spark, sf_dir):
    """Two loads into the month-partitioned table; the second merges with the first."""
    root = f"{shared_folder(spark, 'rates')}/fx_daily"
    loads = _fx_rows(inputs.rate_loads(spark, sf_dir))
    final = F.col("currency") == "F"
    for load in (loads.filter(final), loads.filter(~final)):
        upsert_partitions(
            spark, load, root, FX_DAILY,
            keys=("fx_date", "code"), newest_first=("load_ts",), partition_by=("year", "month"),
        )
    return read_table(spark, root, FX_DAILY, ("fx_date", "code", "currency", "mid"))


def lake_rates_month(spark, sf_dir):
    """Partition-pruned read of one month of the rates table."""
    root = f"{shared_folder(spark, 'month')}/fx_daily"
    replace_table(
        _fx_rows(inputs.rates(spark, sf_dir)).drop("load_ts"), root, ("year", "month")
    )
    return read_table(
        spark, root, columns=("fx_date", "code", "mid"), year=TOPK_YEAR, month=TOPK_MONTH
    )


def _event_rates(spark, sf_dir):
    closes = daily_close(inputs.hourly(spark, sf_dir))
    return closes.select(
        F.upper("symbol").alias("currency"), F.col("symbol").alias("code"),
        F.col("close").alias("mid"), F.col("date").alias("fx_date"),
    )


def lake_rates_json(spark, sf_dir):
    """Raw rate landing in two parts of each day, read back by folder date."""
    root = f"{shared_folder(spark, 'json')}/rates"
    made = _event_rates(spark, sf_dir)
    quoted = F.col("code") == QUOTE
    land_rates_json(spark, made.filter(quoted), root)
    land_rates_json(spark, made.filter(~quoted), root)
    return read_landed_rates(spark, root).select("currency", "code", "mid", "fx_date")


def lake_rate_documents(spark, sf_dir):
    """Documents landed as text, one per line in a folder per year, and read back."""
    root = f"{shared_folder(spark, 'docs')}/documents"
    docs = inputs.rate_documents(spark, sf_dir).withColumn(
        "year", F.substring(F.get_json_object("value", "$[0].no"), -4, 4)
    )
    replace_table(docs, root, ("year",), file_format="text")
    landed = spark.read.text(root).select("value")
    return explode_rate_documents(landed, today=F.lit(FALLBACK_DAY).cast("date"))


def _event_lake(spark, sf_dir, name, partition_by=("date",)) -> jobs.Lake:
    """Lake with bars of the events, and their closes in the role of rates."""
    lake = jobs.Lake(shared_folder(spark, name))
    replace_partitions(
        inputs.hourly(spark, sf_dir), lake.table("trades_agg_hourly"), partition_by,
        tasks=_tasks(spark),
    )
    closes = daily_close(lake.read(spark, "trades_agg_hourly"))
    fx = closes.select(
        F.col("date").alias("fx_date"), F.col("symbol").alias("code"),
        F.col("symbol").alias("currency"), F.col("close").alias("mid"),
        F.current_timestamp().alias("load_ts"),
        F.year("date").alias("year"), F.month("date").alias("month"),
    )
    replace_table(fx, lake.table("fx_daily"), ("year", "month"))
    return lake


def lake_analytics_checks(spark, sf_dir):
    """Curated to aggregated, then the check report, all through tables."""
    lake = _event_lake(spark, sf_dir, "analytics")
    jobs.analytics(spark, lake, BASE, QUOTE)
    return jobs.check_report(spark, lake)


def _analysed_lake(spark, sf_dir, name) -> jobs.Lake:
    lake = _event_lake(spark, sf_dir, name)
    jobs.analytics(spark, lake, BASE, QUOTE)
    return lake


def lake_daily_returns(spark, sf_dir):
    """The daily table of the analytics job, row by row."""
    daily = _analysed_lake(spark, sf_dir, "daily").read(spark, "crypto_daily")
    return _round(daily.select("symbol", "date", "close", "ts_max", "ret_1d"), 6, "ret_1d")


def lake_rate_returns(spark, sf_dir):
    rates = _analysed_lake(spark, sf_dir, "rate-returns").read(spark, "fx_daily_returns")
    return _round(rates.select("fx_date", "code", "mid", "ret_1d", "year", "month"), 6, "ret_1d")


def lake_monthly_facts(spark, sf_dir):
    facts = _analysed_lake(spark, sf_dir, "monthly").read(spark, "crypto_monthly_facts")
    made = facts.select("symbol", "year", "month", "avg_ret_1d", "vol_ret", "days_ret", "last_close")
    return _round(made, 6, "avg_ret_1d", "vol_ret")


def lake_correlation(spark, sf_dir):
    found = _analysed_lake(spark, sf_dir, "correlation").read(spark, "corr_btc_usdpln_63d")
    return _round(found, 6, "corr_btc_usdpln_63d")


def lake_table_samples(spark, sf_dir):
    """How many rows a sample of five finds in each table of the catalog; none is missing."""
    lake = _analysed_lake(spark, sf_dir, "samples")
    database = "lake_" + lake.root.rsplit("-", 1)[-1][:12]
    define_lake(spark, lake.root, database)
    absent = missing_tables(spark, database)
    counts = [
        sample_rows(spark, f"{database}.{name}").agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table_name"), "rows", F.lit(name in absent).alias("missing"))
        for name in jobs.CHECKED
    ]
    return reduce(DataFrame.unionByName, counts)


def lake_serving_cells(spark, sf_dir):
    """The serving job: all dates, then one date again; cells read back."""
    lake = _event_lake(spark, sf_dir, "serving")
    jobs.analytics(spark, lake, BASE, QUOTE)
    jobs.serving(spark, lake, spec=SPEC)
    jobs.serving(spark, lake, "2024-01-10", spec=SPEC)
    return _numbers(spark.read.parquet(lake.cells).select("rowkey", "date", "family", "qualifier", "value"))


def lake_external_tables(spark, sf_dir):
    """External tables over a lake, asked by SQL."""
    lake = _event_lake(spark, sf_dir, "tables", ("date", "hour"))
    jobs.analytics(spark, lake, BASE, QUOTE)
    database = "lake_" + lake.root.rsplit("-", 1)[-1][:12]
    define_lake(spark, lake.root, database)
    return spark.sql(
        f"SELECT b.symbol, b.date, sum(b.trade_count) AS trades, max(d.close) AS close "
        f"FROM {database}.trades_agg_hourly b "
        f"JOIN {database}.crypto_daily d ON b.symbol = d.symbol AND b.date = d.date "
        f"GROUP BY b.symbol, b.date"
    )


def lake_partition_coverage(spark, sf_dir):
    """Dates and hours of the bar table, from the catalog alone."""
    lake = jobs.Lake(shared_folder(spark, "coverage"))
    root = lake.table("trades_agg_hourly")
    replace_partitions(
        inputs.hourly(spark, sf_dir), root, ("date", "hour"), tasks=_tasks(spark)
    )
    name = "bars_" + lake.root.rsplit("-", 1)[-1][:12]
    define_table(spark, name, HOURLY_BARS, root, ("date", "hour"))
    found = covered(spark, name, "date", "hour")
    return found.select(F.col("date").cast("date").alias("date"), F.col("hour").cast("int").alias("hour"))


def lake_put_commands(spark, sf_dir):
    """Text export of put commands, read back and taken apart."""
    root = f"{shared_folder(spark, 'puts')}/puts"
    export_put_commands(_cells(spark, sf_dir), root)
    pattern = "^put '(.*)', '(.*)', '(.*):(.*)', '(.*)'$"
    lines = spark.read.text(root)
    parts = ("table_name", "rowkey", "family", "qualifier", "value")
    return _numbers(
        lines.select(*[F.regexp_extract("value", pattern, i + 1).alias(n) for i, n in enumerate(parts)])
    )


def cells_upload_count(spark, sf_dir):
    """Upload with a client that accepts puts and forgets them; counts what was sent."""

    class Discard:
        def put(self, cells):
            pass

        def close(self):
            pass

    return upload_cells(_cells(spark, sf_dir), Discard)


def lake_file_rows(spark, sf_dir):
    """Rows per folder date from the line count of every landed file."""
    lake = _landed_lake(spark, sf_dir, "census")
    day = F.regexp_extract("path", "date=([0-9-]+)", 1).cast("date")
    return rows_per_file(spark, lake.raw_ticks).groupBy(day.alias("date")).agg(
        F.sum(F.col("lines") - 1).alias("rows")
    )


def lake_file_dates(spark, sf_dir):
    """Dates and hours of the folders that hold files, by the names of the files."""
    found = list_files(spark, _landed_lake(spark, sf_dir, "files").raw_ticks, "*.csv")
    return found.select(
        F.regexp_extract("path", "date=([0-9-]+)", 1).cast("date").alias("date"),
        F.regexp_extract("path", "hour=([0-9]+)", 1).cast("int").alias("hour"),
    ).distinct()


# --- streams -------------------------------------------------------------------


def _tick_stream(spark, sf_dir, delay=STREAM_DELAY):
    schema = inputs.table(spark, sf_dir, "events").schema
    events = stream_table(spark, f"{sf_dir}/events.parquet", schema)
    return with_event_time(inputs.as_ticks(events), delay)


def stream_bars_hourly(spark, sf_dir):
    """Hourly bars of a stream, open ones included: equal to the batch bars."""
    root = shared_folder(spark, "stream-bars")
    made = stream_bars(_tick_stream(spark, sf_dir))
    start_bar_updates(made, f"{root}/log", f"{root}/checkpoint").awaitTermination()
    return _rounded_bars(current_bars(spark, f"{root}/log"))


def stream_bars_closed(spark, sf_dir):
    """Bars that the watermark has closed, appended once."""
    root = shared_folder(spark, "stream-closed")
    made = stream_bars(_tick_stream(spark, sf_dir))
    start_closed_bars(made, f"{root}/bars", f"{root}/checkpoint").awaitTermination()
    return _rounded_bars(spark.read.parquet(f"{root}/bars").drop("date"))


def stream_dedup(spark, sf_dir):
    """Every trade sent twice; one of each is kept."""
    root = shared_folder(spark, "stream-dedup")
    schema = inputs.table(spark, sf_dir, "events").schema
    events = inputs.as_ticks(stream_table(spark, f"{sf_dir}/events.parquet", schema))
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    query = (
        dedup_stream(with_event_time(twice, STREAM_DELAY))
        .writeStream.format("parquet")
        .option("path", f"{root}/ticks")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**AVAILABLE_NOW)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/ticks").select("symbol", "trade_id", "price", "quantity")


def _routed(spark, sf_dir, name):
    root = shared_folder(spark, name)
    inputs.trade_payloads(spark, sf_dir).select("value").write.text(f"{root}/in")
    parsed = parse_trades(stream_text(spark, f"{root}/in"))
    start_routing(
        parsed, f"{root}/valid", f"{root}/rejects", f"{root}/checkpoint"
    ).awaitTermination()
    return root


def stream_route_valid(spark, sf_dir):
    root = _routed(spark, sf_dir, "stream-valid")
    return spark.read.parquet(f"{root}/valid").select(
        "trade_id", "symbol", "price", "quantity", "event_ts", "date"
    )


def stream_route_rejects(spark, sf_dir):
    root = _routed(spark, sf_dir, "stream-rejects")
    return spark.read.parquet(f"{root}/rejects").groupBy(REASON).agg(
        F.count(F.lit(1)).alias("rows")
    )


def stream_landing(spark, sf_dir):
    """Raw landing of a stream as CSV folders, read back by the tick reader."""
    root = shared_folder(spark, "stream-landing")
    columns = ("symbol", "price", "quantity", "event_time", "trade_id")
    schema = inputs.table(spark, sf_dir, "events").schema
    ticks = inputs.as_ticks(stream_table(spark, f"{sf_dir}/events.parquet", schema))
    start_landing(
        ticks.withColumn("event_time", ntz_to_epoch_ms("event_ts")), f"{root}/raw", f"{root}/checkpoint",
        columns, AVAILABLE_NOW, _tasks(spark),
    ).awaitTermination()
    valid = valid_rows(normalize_ticks(read_tick_csv(spark, f"{root}/raw", columns)))
    return valid.groupBy(
        F.col("folder_date").alias("date"), F.col("folder_hour").alias("hour")
    ).agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("price"), 2).alias("price_sum"))


REGISTERED: tuple[Query, ...] = (
    tick_normalize, tick_rejects, trade_parse, trade_rejects, trade_dedup,
    json_props_extract, rates_document_explode, topic_publish_records,
    bars_hourly, bars_daily, bars_minute, bars_daily_close, volume_daily,
    returns_simple_events, returns_simple_rates, returns_ticks, rolling_vol_21,
    rates_latest_wins, rates_upsert_month, series_join_inner,
    rolling_moment_sums, rolling_corr_pairs, rolling_corr_compat,
    facts_monthly, facts_monthly_rates, facts_assembled,
    rowkeys, cells_unpivot, cells_point_get, cells_family_get, cells_scan_limit,
    cells_upsert, cells_delete, cells_store_changes, cells_pivot_back, cells_upload_count,
    topk_partition_sql, date_count_sql,
    coverage_latest_common_date, coverage_latest_hour, quality_report_all,
    lake_bars_from_csv, lake_rejects_from_csv, lake_rejects_rerun, lake_day_equals_full,
    lake_day_mixed_landing, lake_incremental, stream_late_hours,
    document_rejects, lake_day_rebuild, lake_rates_upsert,
    lake_rates_month, lake_rates_json, lake_rate_documents, lake_analytics_checks,
    lake_serving_cells, lake_external_tables, lake_partition_coverage,
    lake_put_commands, lake_file_rows, lake_daily_returns, lake_rate_returns, lake_monthly_facts,
    lake_correlation, lake_table_samples, lake_file_dates,
    stream_bars_hourly, stream_bars_closed, stream_dedup, stream_route_valid,
    stream_route_rejects, stream_landing,
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in REGISTERED}
