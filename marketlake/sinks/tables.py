"""Partitioned table writers.

Write options are set per write, never on the session. Plain Parquet has no
transactions: one writer per partition at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.cleaning import REASON
from marketlake.operators.latest import latest_wins, upsert
from marketlake.schemas import RATE_JSON
from marketlake.sources.tables import partition_predicate, read_table_or_none


def spread(df: DataFrame, columns: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Gather rows of one partition folder for few, large files.

    ``rebalance`` lets adaptive execution merge small partitions and *split* a hot one
    by size, which ``repartition`` by the same columns would leave to a single task.
    Where many tiny folders are written, their number costs more than their size:
    ``tasks`` then spreads the folders over that many tasks.
    """
    if not columns:
        return df
    if tasks is not None:
        return df.repartition(tasks, *columns)
    return df.hint("rebalance", *columns)


def _write(df, root, partition_by, mode, file_format, sort_by, options):
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode("overwrite").format(file_format)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", mode).partitionBy(*partition_by)
    writer.options(**options).save(root)


def replace_partitions(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    file_format: str = "parquet",
    tasks: int | None = None,
    **options: str,
) -> None:
    """Dynamic overwrite: only the partitions present in ``df`` are replaced."""
    df = spread(df, partition_by, tasks)
    _write(df, root, partition_by, "dynamic", file_format, sort_by, options)


def replace_table(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    file_format: str = "parquet",
    tasks: int | None = None,
    **options: str,
) -> None:
    """Static overwrite of the whole table, partitioned or not."""
    df = spread(df, partition_by, tasks)
    _write(df, root, partition_by, "static", file_format, sort_by, options)


def _only_in(df: DataFrame, partitions: Sequence[Mapping[str, object]]) -> DataFrame:
    """Fail the write on a row outside the named partitions; drop nothing."""
    if not partitions:
        return df
    inside = F.coalesce(partition_predicate(df, partitions), F.lit(False))
    message = F.lit(f"a row is outside the partitions {list(partitions)}")
    return df.filter(F.when(inside, True).otherwise(F.raise_error(message).cast("boolean")))


def upsert_partitions(
    spark: SparkSession,
    incoming: DataFrame,
    root: str,
    schema: str,
    keys: Sequence[str],
    newest_first: Sequence[str],
    partition_by: Sequence[str],
    partitions: Sequence[Mapping[str, object]] = (),
    sort_by: Sequence[str] = (),
    file_format: str = "parquet",
) -> None:
    """Merge ``incoming`` into the stored partitions it touches, newest row per key.

    On a full tie the incoming row beats the stored one. Stored partitions are picked
    by ``partitions`` (literal values, pruned before the scan) when the caller knows
    them, else by a semi-join with the partition values of ``incoming``. Partition columns
    must follow from the keys, so that no key moves to another partition.
    """
    columns = spark.createDataFrame([], schema).columns
    incoming = _only_in(incoming, partitions).select(*columns, F.lit(1).alias("_incoming"))
    order = (*newest_first, "_incoming")
    stored = read_table_or_none(spark, root, schema, file_format)
    if stored is None:
        merged = latest_wins(incoming, keys, order)
    else:
        if partitions:
            touched = stored.filter(partition_predicate(stored, partitions))
        else:
            values = incoming.select(*partition_by).distinct()
            touched = stored.join(values, list(partition_by), "left_semi")
        merged = upsert(touched.withColumn("_incoming", F.lit(0)), incoming, keys, order)
    replace_partitions(
        merged.select(*columns), root, partition_by, sort_by, file_format=file_format
    )


def land_ticks_csv(
    ticks: DataFrame, root: str, columns: Sequence[str], append: bool = False, tasks: int | None = None
) -> None:
    """Batch landing of raw ticks as CSV with a header, ``date=/hour=`` folders.

    Needs ``event_ts``, the time of landing; the folders of the ticks at hand are replaced, or with
    ``append`` get files beside those they have.
    """
    landed = ticks.select(
        *columns, F.to_date("event_ts").alias("date"), F.hour("event_ts").alias("hour")
    )
    if append:
        by = ("date", "hour")
        spread(landed, by, tasks).write.mode("append").partitionBy(*by).option("header", True).csv(root)
    else:
        replace_partitions(landed, root, ("date", "hour"), file_format="csv", tasks=tasks, header="true")


def drop_partitions(
    spark: SparkSession, root: str, by: Sequence[str], partitions: Sequence[Mapping[str, object]]
) -> None:
    """Remove partition folders, which no overwrite by a frame without their rows can do."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for values in partitions:
        files.delete(path(root, "/".join(f"{c}={values[c]}" for c in by)), True)


def land_rates_json(spark: SparkSession, rates: DataFrame, root: str) -> None:
    """Raw rates as JSON under ``date=``; a landed (date, code) is replaced.

    One file per currency and day would be millions of tiny files: a date is one folder
    with few files, and the rates already landed for it are merged.
    """
    landed = rates.select("currency", "code", "mid", F.col("fx_date").alias("date"))
    upsert_partitions(
        spark, landed, root, f"{RATE_JSON}, date DATE",
        keys=("date", "code"), newest_first=(), partition_by=("date",), file_format="json",
    )


def replace_rejects(
    spark: SparkSession,
    rejects: DataFrame,
    root: str,
    by: Sequence[str],
    read: DataFrame | None = None,
) -> None:
    """Write rejected rows with their reason by the folder they came from, ``by``.

    ``read`` holds the folders that were read (their columns ``by``): their earlier rejects go, also
    when none are left. Without it all folders were read and the whole table is replaced. So a
    row is there once, whatever runs have seen it.
    """
    if REASON not in rejects.columns:
        raise ValueError(f"rejects need a {REASON} column")
    if read is None:
        replace_table(rejects, root, by)
        return
    replace_partitions(rejects, root, by)
    kinds = ", ".join(f"{c} {rejects.schema[c].dataType.simpleString()}" for c in by)
    stored = read_table_or_none(spark, root, kinds)
    if stored is not None:
        held = stored.select(*by).distinct().join(read.select(*by).distinct(), list(by), "left_semi")
        gone = held.join(rejects.select(*by).distinct(), list(by), "left_anti")
        drop_partitions(spark, root, by, [r.asDict() for r in gone.collect()])
