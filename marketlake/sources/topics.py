"""Topic source for trades. Needs the public Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.fixed_values import TOPIC


def topic_options(servers: str, topic: str = TOPIC, **options: str) -> dict[str, str]:
    """Reader options; the stream's checkpoint takes the place of a consumer group."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **options}


def read_topic_stream(
    spark: SparkSession, servers: str, topic: str = TOPIC, max_offsets: int | None = None
) -> DataFrame:
    """Unbounded topic rows; feed them to ``operators.cleaning.parse_trades``.

    ``max_offsets`` bounds a micro-batch, also after a long stop. ``minPartitions`` may be
    set by the caller to split a hot topic partition among tasks.
    """
    options = topic_options(servers, topic, startingOffsets="earliest")
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return spark.readStream.format("kafka").options(**options).load()


def sample_topic(
    spark: SparkSession, servers: str, n: int, topic: str = TOPIC
) -> DataFrame:
    """First ``n`` messages from the beginning, as text."""
    options = topic_options(servers, topic, startingOffsets="earliest", endingOffsets="latest")
    rows = spark.read.format("kafka").options(**options).load()
    return rows.orderBy("partition", "offset").limit(n).selectExpr(
        "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value"
    )
