"""Trade streams: sources, exactly-once dedup, valid/reject routing, raw landing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.functions import ntz_to_instant
from marketlake.operators.cleaning import REASON, rejected_rows, valid_rows
from marketlake.sinks.tables import replace_partitions

AVAILABLE_NOW = {"availableNow": True}
EVERY_MINUTE = {"processingTime": "1 minute"}


def stream_text(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """New text files under ``root``, one message per line, as column ``value``."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(root)


def stream_table(
    spark: SparkSession, path: str, schema, max_files: int | None = None
) -> DataFrame:
    """A Parquet table as a stream of its files.

    A table may be a folder or a single file; the stream source takes a single file
    only when it is named by a pattern.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def with_event_time(ticks: DataFrame, delay: str, ts: str = "event_ts") -> DataFrame:
    """Add the instant ``event_time`` (zone-free UTC ``ts`` in) and its watermark.

    Watermarks need ``TIMESTAMP``; ``TIMESTAMP_NTZ`` is refused by Spark.
    """
    return ticks.withColumn("event_time", ntz_to_instant(ts)).withWatermark("event_time", delay)


def dedup_stream(
    ticks: DataFrame, keys: Sequence[str] = ("symbol", "trade_id")
) -> DataFrame:
    """Drop replays that arrive within the watermark delay.

    State is keyed by trade, so a hot symbol spreads over all state partitions, and
    ids older than the watermark are dropped.
    """
    return ticks.dropDuplicatesWithinWatermark(list(keys))


def route_batch(valid_root: str, rejects_root: str):
    """``foreachBatch`` function: valid ticks to one table, rejects to another.

    Output is partitioned by batch id and overwritten per partition, so a batch that is
    run again after a failure replaces its own output: exactly once.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        kept = batch.withColumn("batch", F.lit(batch_id).cast("bigint")).persist()
        try:
            good = valid_rows(kept).drop("payload").withColumn("date", F.to_date("event_ts"))
            replace_partitions(good, valid_root, ("date", "batch"))
            bad = rejected_rows(kept).select("payload", REASON, "batch")
            replace_partitions(bad, rejects_root, ("batch",))
        finally:
            kept.unpersist()

    return route


def start_routing(
    parsed: DataFrame,
    valid_root: str,
    rejects_root: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start routing a stream made by ``parse_trades``."""
    return (
        parsed.writeStream.foreachBatch(route_batch(valid_root, rejects_root))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def start_landing(
    ticks: DataFrame,
    root: str,
    checkpoint: str,
    columns: Sequence[str],
    trigger: dict | None = None,
    tasks: int | None = None,
) -> StreamingQuery:
    """Land raw ticks as CSV under ``date=/hour=`` once per trigger (a minute by default).

    The trigger is the merge window: each minute gives one file per folder and writing
    task. The file sink's log makes it exactly once. With ``tasks``, the rows of a folder
    are gathered into one file; leave it out for a stream too large for that.
    """
    landed = ticks.select(
        *columns, F.to_date("event_ts").alias("date"), F.hour("event_ts").alias("hour")
    )
    if tasks is not None:
        landed = landed.repartition(tasks, "date", "hour")
    return (
        landed.writeStream.format("csv")
        .option("header", True)
        .option("path", root)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date", "hour")
        .outputMode("append")
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )
