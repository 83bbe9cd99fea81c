"""Streaming bars: tumbling event-time windows with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.fixed_values import BAR_BUCKET
from marketlake.operators.bars import MEASURES, bars
from marketlake.operators.latest import latest_wins
from marketlake.sinks.tables import replace_partitions
from marketlake.streaming.ticks import AVAILABLE_NOW

KEY = ("symbol", "bucket_start_ts")


def stream_bars(ticks: DataFrame, bucket: str = BAR_BUCKET, **options) -> DataFrame:
    """Bars of a stream prepared by ``with_event_time``; same aggregates as in batch.

    State is one partial bar per (symbol, open bucket). Ticks later than the watermark
    are left out here; rebuild their hours from the raw layer with the batch job.
    """
    return bars(ticks, bucket, ("symbol",), ts="event_time", **options)


def start_closed_bars(
    made: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append each bar once, when the watermark has passed its end."""
    return (
        made.withColumn("date", F.to_date("bucket_start_ts"))
        .writeStream.format("parquet")
        .option("path", root)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date")
        .outputMode("append")
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def start_bar_updates(
    made: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Log every changed bar, open ones too; read the log with ``current_bars``.

    The log is partitioned by date and batch; a repeated batch replaces its own part.
    """

    def log(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumns(
            {"date": F.to_date("bucket_start_ts"), "batch": F.lit(batch_id).cast("bigint")}
        )
        replace_partitions(out, root, ("date", "batch"))

    return (
        made.writeStream.foreachBatch(log)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def current_bars(spark: SparkSession, root: str) -> DataFrame:
    """Latest state of every bar in the log of ``start_bar_updates``."""
    logged = spark.read.parquet(root)
    return latest_wins(logged, KEY, ("batch",)).select(*KEY, *MEASURES)
