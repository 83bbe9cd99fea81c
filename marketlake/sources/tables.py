"""Partitioned Parquet tables of the lake."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F


def read_table(
    spark: SparkSession,
    root: str,
    schema: str | None = None,
    columns: Sequence[str] | None = None,
    **partition: object,
) -> DataFrame:
    """Read from the table root; ``partition`` equalities prune folders.

    Partition columns come with their types because the root is read, never a glob.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(root)
    for name, value in partition.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value).cast(df.schema[name].dataType))
    return df if columns is None else df.select(*columns)


def load_or_none(reader: DataFrameReader, root: str) -> DataFrame | None:
    """What a reader finds at ``root``, or None when nothing was ever written there.

    Only a missing path counts as absent; an unreadable table raises.
    """
    try:
        return reader.load(root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_table_or_none(
    spark: SparkSession, root: str, schema: str, file_format: str = "parquet"
) -> DataFrame | None:
    """The table with a given schema, or None when it was never written."""
    return load_or_none(spark.read.schema(schema).format(file_format), root)


def partition_predicate(df: DataFrame, partitions: Sequence[Mapping[str, object]]) -> Column:
    """True for rows of the listed partitions; literals only, so folders are pruned."""
    any_of = F.lit(False)
    for values in partitions:
        one = F.lit(True)
        for name, value in values.items():
            one = one & (F.col(name) == F.lit(value).cast(df.schema[name].dataType))
        any_of = any_of | one
    return any_of
