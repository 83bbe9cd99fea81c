"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import durable


def _pairs(df: DataFrame, first, second) -> DataFrame:
    made = df.select(F.greatest(first, second).alias("hi"), F.least(first, second).alias("lo"))
    return made.where(F.col("hi") != F.col("lo")).distinct()


def components(edges: DataFrame, first: str, second: str) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its smallest node.

    Minima are aggregated before the shuffle and joined back, so a node with very many neighbours is
    split like any skewed join. A round keeps no more edges than it was given nodes and edges; a
    path of ``n`` nodes takes about ``log n`` rounds.
    """
    now = durable(_pairs(edges, F.col(first), F.col(second)))
    state = None
    while True:
        found = now.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")
        ).first()
        if not found["n"] or found == state:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        state = found
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = _pairs(
            both.join(least, "u").where(F.col("v") > F.col("u")), F.col("v"), F.least("m", "u")
        )
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(lowest, "hi")
        small = joined.select(F.explode(F.array("hi", "lo")).alias("u"), "m")
        now = durable(_pairs(small, F.col("u"), F.col("m")))
