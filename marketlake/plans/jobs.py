"""The batch flows: raw to curated, curated to aggregated, checks, serving.

Steps hand over through tables, so a lost executor or a failed step never repeats
the earlier ones.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlake.fixed_values import CORRELATION_BASE, CORRELATION_QUOTE, SERVED_CELLS
from marketlake.operators.bars import daily_close, daily_volume, hourly_bars
from marketlake.operators.cells import CellSpec, to_cells
from marketlake.operators.cleaning import (
    REASON,
    dedup_trades,
    normalize_rates,
    normalize_ticks,
    rejected_rows,
    valid_rows,
)
from marketlake.operators.correlation import Mode, correlation_table
from marketlake.operators.coverage import latest_common
from marketlake.operators.facts import daily_facts, monthly_facts, on_date
from marketlake.operators.latest import latest_wins
from marketlake.operators.quality import enforce, quality_report
from marketlake.operators.returns import daily_returns, rate_returns
from marketlake.schemas import FX_DAILY, LAKE_TABLES
from marketlake.sinks.cells import write_cells
from marketlake.sinks.tables import (
    drop_partitions,
    replace_partitions,
    replace_rejects,
    replace_table,
    upsert_partitions,
)
from marketlake.sources.catalog import covered, define_raw
from marketlake.sources.rates import read_rate_files
from marketlake.plans.shared import discard, shared_folder
from marketlake.sources.tables import read_table, read_table_or_none
from marketlake.sources.ticks import (
    STATED_INDEX,
    folder_states,
    in_event_time,
    in_folders,
    index_rows,
    read_tick_csv,
)


@dataclass(frozen=True)
class Lake:
    """Folders of a lake below one root."""

    root: str

    @property
    def raw_ticks(self) -> str:
        return f"{self.root}/raw/ticks"

    @property
    def streamed_ticks(self) -> str:
        """Where a stream lands: Spark reads a folder with a stream's log by that log alone, so it
        is kept apart from files that others land."""
        return f"{self.root}/raw/ticks_streamed"

    @property
    def tick_index(self) -> str:
        return f"{self.root}/raw/_tick_index"

    @property
    def raw_rates(self) -> str:
        return f"{self.root}/raw/rates"

    @property
    def rejects(self) -> str:
        return f"{self.root}/raw/_errors"

    @property
    def cells(self) -> str:
        return f"{self.root}/serving/cells"

    def table(self, name: str) -> str:
        return f"{self.root}/{LAKE_TABLES[name][2]}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return read_table(spark, self.table(name), LAKE_TABLES[name][0])


def _stamp(load_ts: dt.datetime | None) -> Column:
    return F.current_timestamp() if load_ts is None else F.lit(load_ts)


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows and rejects while the job writes, instead of in passes of their own."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected"),
    )
    return counted, seen


FOLDER = ("folder_date", "folder_hour")
HOUR = ("date", "hour")


def tick_etl(
    spark: SparkSession,
    lake: Lake,
    day: str | None = None,
    hour: int | None = None,
    columns: list[str] | None = None,
    dedup_on: tuple[str, ...] | None = None,
    load_ts: dt.datetime | None = None,
    write_tasks: int | None = None,
) -> dict[str, int]:
    """Raw tick files to hourly bars, replacing the bars of the covered hours only.

    With ``day`` (and ``hour``) the bars of those event hours are rebuilt from all their ticks, in
    whatever folder these landed: an index says which event hours a folder's files hold. The job keeps it
    itself and knows it by the files' names, sizes and times, so it does not matter who landed them: a folder
    with files that the index has not seen is read, never passed over. So a day run gives what a full
    run gives, and in both an hour whose ticks have all gone loses its bar.

    The raw text is read and parsed once, into a staged table by validity; bars come from its
    valid part, and the rejects of the folders read are replaced by the other. ``dedup_on``
    names the columns that identify a trade, to drop replays. ``write_tasks`` helps when many tiny
    hour folders are written at once.
    """
    roots, states = [], {}
    for root in (lake.raw_ticks, lake.streamed_ticks):
        # listed before the files are read: what lands later is seen next time
        for f in folder_states(spark, root):
            folder = (f["date"], f["hour"])
            states[folder] = {**f, "state": f["state"] ^ states.get(folder, {"state": 0})["state"]}
            roots += [root] * (root not in roots)
    states = list(states.values())
    raw = read_tick_csv(spark, (roots or [lake.raw_ticks])[0], columns)
    for root in roots[1:]:
        raw = raw.unionByName(read_tick_csv(spark, root, columns), allowMissingColumns=True)
    index, unknown = _known_folders(spark, lake, states)
    tagged, seen = _observed(normalize_ticks(in_folders(raw, day, hour, index, unknown)), "ticks")
    staged = shared_folder(spark, "ticks")
    flagged = tagged.withColumn("rejected", F.col(REASON).isNotNull())
    flagged.write.partitionBy("rejected").parquet(staged)
    stage = spark.read.schema(flagged.schema).parquet(staged)
    valid = stage.filter(~F.col("rejected")).drop(REASON, "rejected")
    ticks = in_event_time(valid, day, hour)
    if dedup_on:
        ticks = dedup_trades(ticks, dedup_on)
    made = f"{staged}-bars"
    hourly = hourly_bars(ticks, _stamp(load_ts))
    hourly.write.parquet(made)
    bars = spark.read.schema(hourly.schema).parquet(made)
    replace_partitions(bars, lake.table("trades_agg_hourly"), HOUR, tasks=write_tasks)
    _clear_hours(spark, lake, bars, day, hour)
    rejects = stage.filter("rejected").drop("rejected")
    replace_rejects(
        spark, rejects, f"{lake.rejects}/ticks", FOLDER, read=None if day is None else stage.select(*FOLDER)
    )
    if unknown:
        fresh = spark.createDataFrame([tuple(f[c] for c in ("date", "hour", "state")) for f in unknown],
                                      "date DATE, hour INT, state BIGINT")
        index_rows(valid, fresh).coalesce(1).write.mode("append").parquet(lake.tick_index)
    for done in (staged, made):
        discard(spark, done)
    return dict(seen.get)


def _known_folders(
    spark: SparkSession, lake: Lake, states: list[dict]
) -> tuple[DataFrame | None, list[dict]]:
    """The index rows that hold for the folders as they are now, and the folders that have none."""
    stored = read_table_or_none(spark, lake.tick_index, STATED_INDEX)
    if stored is None or not states:
        return None, states
    now = spark.createDataFrame([tuple(f[c] for c in ("date", "hour", "state")) for f in states],
                                "date DATE, hour INT, state BIGINT")
    index = stored.join(F.broadcast(now), ["date", "hour", "state"])
    known = {tuple(r) for r in index.select("date", "hour").distinct().collect()}
    return index, [f for f in states if (f["date"], f["hour"]) not in known]


def _clear_hours(
    spark: SparkSession, lake: Lake, bars: DataFrame, day: str | None, hour: int | None
) -> None:
    """Remove the bars of the covered hours that the run made no bar for. Hours are partitions."""
    stored = read_table_or_none(spark, lake.table("trades_agg_hourly"), LAKE_TABLES["trades_agg_hourly"][0])
    if stored is None:
        return
    covered_hours = on_date(stored, day).select(*HOUR).distinct()
    if hour is not None:
        covered_hours = covered_hours.filter(F.col("hour") == hour)
    left = {tuple(r) for r in bars.select(*HOUR).distinct().collect()}
    gone = [{"date": r.date.isoformat(), "hour": r.hour} for r in covered_hours.collect() if tuple(r) not in left]
    drop_partitions(spark, lake.table("trades_agg_hourly"), HOUR, gone)


def rate_etl(
    spark: SparkSession,
    lake: Lake,
    day: str | None = None,
    load_ts: dt.datetime | None = None,
) -> dict[str, int]:
    """Raw rate files merged into the months they touch, latest load first.

    Always merges, also on a full run, so a month never shrinks. Files that tie on the
    load time are settled by name.
    """
    raw = read_rate_files(spark, lake.raw_rates, day)
    tagged, seen = _observed(normalize_rates(raw), "rates")
    rates = latest_wins(valid_rows(tagged), ("fx_date", "code"), ("file_name",))
    upsert_partitions(
        spark, rates.withColumn("load_ts", _stamp(load_ts)),
        lake.table("fx_daily"), FX_DAILY,
        keys=("fx_date", "code"), newest_first=("load_ts",), partition_by=("year", "month"),
    )
    # rate files are small; a second read costs less than staging them
    days = spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("date").alias("folder_date"))
    replace_rejects(
        spark, rejected_rows(normalize_rates(raw)), f"{lake.rejects}/rates", ("folder_date",),
        read=None if day is None else days,
    )
    return dict(seen.get)


def analytics(
    spark: SparkSession,
    lake: Lake,
    base: str = CORRELATION_BASE,
    quote: str = CORRELATION_QUOTE,
    mode: Mode = "pairs",
) -> None:
    """Full rebuild of returns, daily closes, correlation and monthly facts."""
    rates = rate_returns(lake.read(spark, "fx_daily"))
    replace_table(rates, lake.table("fx_daily_returns"), ("year", "month"))

    daily = daily_returns(daily_close(lake.read(spark, "trades_agg_hourly")))
    replace_table(daily, lake.table("crypto_daily"), ("symbol",))

    daily = lake.read(spark, "crypto_daily")
    returns = lake.read(spark, "fx_daily_returns")
    correlation = correlation_table(daily, returns, base, quote, mode)
    replace_table(correlation, lake.table("corr_btc_usdpln_63d"))

    replace_table(monthly_facts(daily), lake.table("crypto_monthly_facts"), ("symbol",))


CHECKED = ("fx_daily_returns", "crypto_daily", "corr_btc_usdpln_63d", "crypto_monthly_facts")


def check_report(spark: SparkSession, lake: Lake) -> DataFrame:
    return quality_report({name: lake.read(spark, name) for name in CHECKED})


def checks(spark: SparkSession, lake: Lake) -> None:
    """Raise ``QualityError`` naming every failed check."""
    enforce(check_report(spark, lake))


def facts(spark: SparkSession, lake: Lake, day: str | None = None) -> DataFrame:
    """Daily facts; a ``day`` filter prunes the bar partitions."""
    return daily_facts(
        on_date(lake.read(spark, "crypto_daily"), day),
        daily_volume(on_date(lake.read(spark, "trades_agg_hourly"), day)),
        on_date(lake.read(spark, "corr_btc_usdpln_63d"), day),
    )


def serving(
    spark: SparkSession,
    lake: Lake,
    day: str | None = None,
    load_ts: dt.datetime | None = None,
    spec: CellSpec = SERVED_CELLS,
) -> None:
    """Upsert the cells of one date, or of all dates, into the serving table."""
    cells = to_cells(facts(spark, lake, day), spec).withColumn("version", _stamp(load_ts))
    write_cells(spark, cells, lake.cells, [day] if day else [])


def latest_common_day(spark: SparkSession, lake: Lake, database: str = "finance") -> str | None:
    """Latest date that both raw inputs have, by their folders; no file is read."""
    define_raw(spark, lake.raw_ticks, lake.raw_rates, database)
    ticks = covered(spark, f"{database}.raw_ticks", "date")
    rates = covered(spark, f"{database}.raw_rates", "date")
    return latest_common(ticks, rates).first().date


def full_run(spark: SparkSession, lake: Lake, day: str | None = None) -> str:
    """Curate one day (the latest common one by default), rebuild, check and serve it."""
    day = day or latest_common_day(spark, lake)
    if day is None:
        raise ValueError("the raw inputs have no date in common")
    rate_etl(spark, lake, day)
    tick_etl(spark, lake, day)
    analytics(spark, lake)
    checks(spark, lake)
    serving(spark, lake, day)
    return day
