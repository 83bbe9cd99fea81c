"""Keyed topic records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.fixed_values import TOPIC


def topic_records(
    df: DataFrame, key: str = "symbol", columns: Sequence[str] | None = None
) -> DataFrame:
    """``key`` and ``value`` (JSON of the row) as the topic sink wants them.

    Works on batch and streaming frames; the key decides the topic partition.
    """
    value = F.to_json(F.struct(*(columns or df.columns)))
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def publish(df: DataFrame, servers: str, topic: str = TOPIC, key: str = "symbol") -> None:
    """Batch publish with leader acknowledgement. Needs the public Kafka connector."""
    (
        topic_records(df, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "1")
        .option("topic", topic)
        .save()
    )


def publish_stream(
    df: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC, key: str = "symbol"
):
    """Start a streaming publish; at-least-once, as the topic sink is."""
    return (
        topic_records(df, key)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "1")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
