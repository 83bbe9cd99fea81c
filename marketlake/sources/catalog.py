"""External tables over the lake, for SQL users."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from marketlake.operators.coverage import partition_values
from marketlake.schemas import LAKE_TABLES


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def define_table(
    spark: SparkSession,
    name: str,
    schema: str,
    location: str,
    partition_columns: Iterable[str] = (),
    using: str = "PARQUET",
) -> None:
    """Define an external table and bring its partitions in line with the folders that exist, those
    that have gone included. A table of that name over another location is an error."""
    by = ", ".join(f"`{c}`" for c in partition_columns)
    partitioned = f"PARTITIONED BY ({by}) " if by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING {using} "
        f"{partitioned}LOCATION {_literal(location)}"
    )
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    plain = lambda path: path.removeprefix("file:").rstrip("/").replace("///", "/")
    if found is not None and plain(found.data_type) != plain(location):
        raise ValueError(f"{name} is defined over {found.data_type}, not {location}")
    if by:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def define_lake(spark: SparkSession, lake_root: str, database: str = "finance") -> None:
    """The six curated and aggregated tables of a lake."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (schema, partition_columns, folder) in LAKE_TABLES.items():
        define_table(
            spark, f"{database}.{name}", schema, f"{lake_root}/{folder}", partition_columns
        )


def define_raw(spark: SparkSession, ticks: str, rates: str, database: str = "finance") -> None:
    """Raw folders as tables ``raw_ticks`` and ``raw_rates``, to ask for their partitions.

    They are redefined each time; dropping an external table leaves its files alone.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, location, by in (
        ("raw_ticks", ticks, {"date": "DATE", "hour": "INT"}),
        ("raw_rates", rates, {"date": "DATE"}),
    ):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        columns = ", ".join(["value STRING", *(f"{c} {t}" for c, t in by.items())])
        define_table(spark, f"{database}.{name}", columns, location, by, "TEXT")


def missing_tables(spark: SparkSession, database: str = "finance") -> list[str]:
    """Lake tables that the catalog does not know."""
    return [t for t in LAKE_TABLES if not spark.catalog.tableExists(f"{database}.{t}")]


def sample_rows(spark: SparkSession, table: str, n: int = 5) -> DataFrame:
    return spark.table(table).limit(n)


def covered(spark: SparkSession, table: str, *columns: str) -> DataFrame:
    """Registered partition values as text. Reads the catalog, not the data."""
    return partition_values(spark.sql(f"SHOW PARTITIONS {table}"), *columns)
