"""Raw tick files: CSV with a header under ``date=YYYY-MM-DD/hour=HH/``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.fixed_values import TICK_COLUMNS
from marketlake.operators.cleaning import require_columns
from marketlake.schemas import CORRUPT
from marketlake.sources.tables import load_or_none

FOLDERS = ("date", "hour")


def header_columns(spark: SparkSession, root: str) -> list[str]:
    """Column names in the header of the first file."""
    names = spark.read.option("header", True).csv(root).columns
    return [c for c in names if c not in FOLDERS]


def read_tick_csv(
    spark: SparkSession, root: str, columns: Sequence[str] | None = None, max_files: int | None = None,
    stream: bool = False,
) -> DataFrame:
    """All tick files under ``root`` as text columns plus ``folder_date``, ``folder_hour``.

    Pass ``columns`` (the header) to save the look at the first file. A file whose
    header differs fails instead of being misread by position; a row with too many or
    too few fields keeps its text in ``_corrupt_record`` and is rejected by
    ``normalize_ticks``. Folder values are typed, so ``hour=05`` is 5. With ``stream`` the files are read
    as a stream, each once and at most ``max_files`` in a batch.
    """
    columns = list(columns) if columns else header_columns(spark, root)
    fields = [f"`{c}` STRING" for c in (*columns, CORRUPT)]
    reader = spark.readStream if stream else spark.read
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = (
        # folder columns are left to partition discovery: given here too, they would be
        # taken for fields of the files where a stream sink wrote the folders
        reader.schema(", ".join(fields))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        # with pruning, a row's field count is only checked when all columns are read
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(root)
    )
    require_columns(raw, (*TICK_COLUMNS, *FOLDERS))
    return raw.select(
        *columns,
        CORRUPT,
        F.col("date").cast("date").alias("folder_date"),
        F.col("hour").cast("int").alias("folder_hour"),
    )


def span(day: str | None, hour: int | None) -> tuple[dt.datetime, dt.datetime] | None:
    """Event-time interval ``[start, end)`` of a date or one of its hours."""
    if day is None:
        if hour is not None:
            raise ValueError("an hour needs a date")
        return None
    start = dt.datetime.fromisoformat(day)
    if hour is None:
        return start, start + dt.timedelta(days=1)
    if not 0 <= hour <= 23:
        raise ValueError(f"hour {hour} is not in 0..23")
    start += dt.timedelta(hours=hour)
    return start, start + dt.timedelta(hours=1)


def _between(ts: Column, start: dt.datetime, end: dt.datetime) -> Column:
    low, high = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (start, end))
    return (ts >= low) & (ts < high)


FOLDER_INDEX = "event_date DATE, event_hour INT, ticks BIGINT, date DATE, hour INT"
#: the index as it is stored: with the state of the folder's files that a row was made from
STATED_INDEX = f"{FOLDER_INDEX}, state BIGINT"


def folder_states(spark: SparkSession, root: str) -> list[dict]:
    """(date, hour, state) of each folder; the state changes with any file that is added, replaced or gone.

    Only the listing is read, not the files. One row for each folder, as many as hours have landed; none
    where nothing has landed yet.
    """
    files = load_or_none(spark.read.format("binaryFile"), root)
    if files is None or "hour" not in files.columns:
        return []
    one = F.xxhash64("path", "length", "modificationTime")
    states = files.groupBy(F.col("date").cast("date").alias("date"), F.col("hour").cast("int").alias("hour")).agg(
        F.bit_xor(one).alias("state")
    )
    return [r.asDict() for r in states.collect()]


def index_rows(ticks: DataFrame, states: DataFrame) -> DataFrame:
    """Rows of the stored index for the folders in ``states``: which event hours their ticks are of. A
    folder without a valid tick has one row without an hour, so that it counts as known."""
    held = ticks.groupBy(
        F.to_date("event_ts").alias("event_date"), F.hour("event_ts").alias("event_hour"),
        F.col("folder_date").alias("date"), F.col("folder_hour").alias("hour"),
    ).agg(F.count(F.lit(1)).alias("ticks"))
    found = states.join(held, list(FOLDERS), "left")
    return found.select("event_date", "event_hour", "ticks", *FOLDERS, "state")


def in_folders(
    raw: DataFrame, day: str | None, hour: int | None = None, index: DataFrame | None = None,
    unknown: Sequence[dict] = (),
) -> DataFrame:
    """Rows of the folders that hold ticks of a date or hour, by an index of folders, and of the
    ``unknown`` folders, of which no index says what they hold.

    Without an index nothing says where a late tick may be, so all folders stay. With one, the
    folders come as literals, so no other is read.
    """
    wanted = span(day, hour)
    if wanted is None or index is None:
        return raw
    held = index.filter(F.col("event_date") == F.lit(day).cast("date"))
    if hour is not None:
        held = held.filter(F.col("event_hour") == hour)
    folders = {(r.date, r.hour) for r in held.select(*FOLDERS).distinct().collect()}
    folders |= {(f["date"], f["hour"]) for f in unknown}
    hours: dict = {}
    for date, hour_ in sorted(folders):
        hours.setdefault(date, []).append(hour_)
    any_of = F.lit(False)
    for date, list_ in hours.items():
        any_of = any_of | ((F.col("folder_date") == F.lit(date)) & F.col("folder_hour").isin(list_))
    return raw.filter(any_of)


def in_event_time(ticks: DataFrame, day: str | None, hour: int | None = None) -> DataFrame:
    """Ticks whose own time is in the date or hour, wherever they were landed."""
    wanted = span(day, hour)
    return ticks if wanted is None else ticks.filter(_between(F.col("event_ts"), *wanted))
