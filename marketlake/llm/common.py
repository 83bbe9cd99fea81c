"""Helpers shared by the operators: blanks, durable cuts of lineage, a total order without one task."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the white space of the contracts, [\x20\x09-\x0D]
BLANKS = " \t\n\x0b\x0c\r"


def shared_checkpoints(spark: SparkSession) -> None:
    """Point the context at ``spark.checkpoint.dir``. Only a local session without that setting,
    as in tests, gets a temporary folder; on a cluster executors could not share one."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    context.setCheckpointDir(folder)


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder: its lineage ends there, so a lost
    executor costs no more than a new read."""
    shared_checkpoints(df.sparkSession)
    return df.checkpoint()


def shared_place(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder."""
    shared_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, place: str | None = None) -> DataFrame:
    """``df`` written as a table in the shared folder, or at ``place``, and read again: smaller than a
    checkpoint, and later steps read only the columns they use."""
    place = place or shared_place(df.sparkSession, "table")
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def emptied(spark: SparkSession, place: str) -> None:
    """Remove a table, or a folder of tables, of ``shared_place`` that no frame reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without_blanks(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_borders(df: DataFrame, key: str, parts: int) -> list:
    """Distinct borders that cut ``key`` into at most ``parts`` ranges of about equal rows."""
    shares = [k / parts for k in range(1, parts)]
    found = df.agg(F.percentile_approx(key, shares, 100 * parts)).first()[0]
    return sorted({b for b in found or [] if b is not None})


def range_bucket(key: Column, borders: list) -> Column:
    """How many of the sorted ``borders`` are at most ``key``, by binary search; 0 for null."""
    if not borders:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(borders).bit_length()))]
    at = F.array(*[F.lit(b) for b in borders])
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda n, s: F.when(F.coalesce(F.get(at, n + s - 1) <= key, F.lit(False)), n + s).otherwise(n),
    )


def seeded(seed: int, *columns: Column) -> Column:
    """A 64-bit hash that a rerun repeats."""
    return F.xxhash64(F.lit(seed), *columns)
