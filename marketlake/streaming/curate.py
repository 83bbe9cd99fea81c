"""Raw tick files to hourly bars, run by run: each file is read once, and late ticks are kept and named.

A run takes the files that have landed since the last one (``availableNow``). A batch stores its typed ticks in a
part of its own, ``(date, batch)``, so a batch that is run again replaces what it wrote, and then rebuilds the
hours its ticks are of from the stored ticks, not from the raw files.

The watermark is the stream's own: the latest event time of all earlier batches less ``delay``, from a ledger
with a row for each batch. A tick behind it is late. Late ticks are stored with the others, flagged;
their hours are taken for closed and left as they are until ``rebuild_late`` rebuilds just those.
``late_hours`` names the hours and counts the ticks that wait.

Meant for runs, not for a trigger of a few seconds: an hour is read again by each run that adds to it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.operators.bars import hourly_bars
from marketlake.operators.cleaning import REASON, dedup_trades, normalize_ticks, rejected_rows, valid_rows
from marketlake.sinks.tables import replace_partitions
from marketlake.sources.tables import read_table_or_none
from marketlake.streaming.ticks import AVAILABLE_NOW

TICKS = (
    "symbol STRING, price DOUBLE, quantity DOUBLE, trade_id BIGINT, event_ts TIMESTAMP_NTZ, late BOOLEAN, "
    "date DATE, batch BIGINT"
)
LEDGER = "batch BIGINT, last_event_ts TIMESTAMP_NTZ, ticks BIGINT, late BIGINT, rejected BIGINT"
REBUILT = "upto BIGINT"
HOUR = ("date", "hour")


@dataclass(frozen=True)
class Curated:
    """Folders of the incremental flow below one root."""

    root: str

    @property
    def ticks(self) -> str:
        return f"{self.root}/ticks"

    @property
    def bars(self) -> str:
        return f"{self.root}/bars"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def rebuilt(self) -> str:
        return f"{self.root}/rebuilt"


def ledger(spark: SparkSession, tables: Curated) -> DataFrame:
    """One row for each batch that has ended."""
    stored = read_table_or_none(spark, tables.ledger, LEDGER)
    return spark.createDataFrame([], LEDGER) if stored is None else stored


def _stored(spark: SparkSession, tables: Curated) -> DataFrame | None:
    return read_table_or_none(spark, tables.ticks, TICKS)


def rebuild_hours(
    spark: SparkSession,
    tables: Curated,
    hours: Sequence[tuple],
    dedup_on: tuple[str, ...] | None = None,
    tasks: int | None = None,
) -> None:
    """Replace the bars of ``hours`` (date, hour) by those of all stored ticks of these hours.

    Ticks are stored by date and sorted by time, so the parts of other dates, and row groups of other hours,
    are not read.
    """
    by_date: dict = {}
    for date, hour in sorted(hours):
        by_date.setdefault(date, []).append(hour)
    if not by_date:
        return
    any_of = F.lit(False)
    for date, list_ in by_date.items():
        any_of = any_of | ((F.col("date") == F.lit(date)) & F.hour("event_ts").isin(list_))
    ticks = _stored(spark, tables).filter(any_of).drop("late", "date", "batch")
    if dedup_on:
        ticks = dedup_trades(ticks, dedup_on)
    replace_partitions(hourly_bars(ticks), tables.bars, HOUR, tasks=tasks)


def _hours(ticks: DataFrame) -> list[tuple]:
    """(date, hour) of ticks: at most 24 for each date that they are of."""
    return [tuple(r) for r in ticks.select("date", F.hour("event_ts").alias("hour")).distinct().collect()]


def curate_batch(
    tables: Curated, delay: str, dedup_on: tuple[str, ...] | None = None, tasks: int | None = None
):
    """``foreachBatch`` function on raw ticks as ``read_tick_csv`` reads them."""

    def curate(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = ledger(spark, tables).filter(F.col("batch") < batch_id)
        border = earlier.agg((F.max("last_event_ts") - F.expr(f"INTERVAL {delay}")).alias("at")).first()["at"]
        late = F.lit(False) if border is None else F.col("event_ts") < F.lit(border).cast("timestamp_ntz")
        tagged = normalize_ticks(batch).withColumn("batch", F.lit(batch_id).cast("bigint")).persist()
        try:
            valid = valid_rows(tagged).withColumns({"late": late, "date": F.to_date("event_ts")})
            replace_partitions(valid, tables.ticks, ("date", "batch"), ("event_ts",), tasks=tasks)
            replace_partitions(rejected_rows(tagged), tables.rejects, ("batch",))
            rejected = tagged.filter(F.col(REASON).isNotNull()).count()
        finally:
            tagged.unpersist()
        stored = _stored(spark, tables)
        mine = None if stored is None else stored.filter(F.col("batch") == batch_id)
        seen = (0, 0, None)
        if mine is not None:
            rebuild_hours(spark, tables, _hours(mine.filter(~F.col("late"))), dedup_on, tasks)
            seen = mine.agg(F.count(F.lit(1)), F.count_if("late"), F.max("event_ts")).first()
        # last: what the ledger names is whole
        row = [(batch_id, seen[2], seen[0], seen[1], rejected)]
        replace_partitions(spark.createDataFrame(row, LEDGER).coalesce(1), tables.ledger, ("batch",))

    return curate


def start_curating(
    raw: DataFrame,
    tables: Curated,
    checkpoint: str,
    delay: str,
    dedup_on: tuple[str, ...] | None = None,
    tasks: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a run on a stream of raw ticks (``read_tick_csv(..., stream=True)``); by default it takes all
    files that have landed and ends."""
    return (
        raw.writeStream.foreachBatch(curate_batch(tables, delay, dedup_on, tasks))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def _waiting(spark: SparkSession, tables: Curated, upto: int | None = None) -> DataFrame | None:
    """Late ticks that no rebuild has taken in."""
    stored = _stored(spark, tables)
    if stored is None:
        return None
    done = read_table_or_none(spark, tables.rebuilt, REBUILT)
    last = None if done is None else done.agg(F.max("upto")).first()[0]
    found = stored.filter(F.col("late") & (F.col("batch") > F.lit(-1 if last is None else last)))
    return found if upto is None else found.filter(F.col("batch") <= upto)


def late_hours(spark: SparkSession, tables: Curated) -> DataFrame:
    """(date, hour, ticks) of the late ticks that wait for a rebuild of their hour."""
    waiting = _waiting(spark, tables)
    if waiting is None:
        return spark.createDataFrame([], "date DATE, hour INT, ticks BIGINT")
    return waiting.groupBy("date", F.hour("event_ts").alias("hour")).agg(F.count(F.lit(1)).alias("ticks"))


def rebuild_late(
    spark: SparkSession, tables: Curated, dedup_on: tuple[str, ...] | None = None, tasks: int | None = None
) -> list[tuple]:
    """Rebuild the hours of all late ticks of ended batches; returns them. A run that is lost halfway
    repeats the same hours."""
    upto = ledger(spark, tables).agg(F.max("batch")).first()[0]
    waiting = None if upto is None else _waiting(spark, tables, upto)
    if waiting is None:
        return []
    hours = _hours(waiting)
    rebuild_hours(spark, tables, hours, dedup_on, tasks)
    spark.createDataFrame([(upto,)], REBUILT).coalesce(1).write.mode("append").parquet(tables.rebuilt)
    return hours
