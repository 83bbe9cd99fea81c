"""Raw rates: one small JSON object per file, or whole rate documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.fixed_values import RATE_FILE_GLOB
from marketlake.functions import blank_to_null, file_name_date
from marketlake.operators.cleaning import tag_rejects
from marketlake.schemas import RATE_JSON, RATES_DOCUMENT


def read_rate_files(
    spark: SparkSession, root: str, day: str | None = None, glob: str = RATE_FILE_GLOB
) -> DataFrame:
    """Rate files with three-letter codes; ``fx_date`` comes from the file name.

    ``day`` selects the folder by its typed partition column.
    """
    raw = (
        spark.read.schema(f"{RATE_JSON}, date DATE")
        .option("pathGlobFilter", glob)
        .json(root)
    )
    if day is not None:
        raw = raw.filter(F.col("date") == F.lit(day).cast("date"))
    return raw.select(
        "code", "currency", "mid",
        file_name_date("_metadata.file_name").alias("fx_date"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("date").alias("folder_date"),
    )


def read_landed_rates(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """Rates landed by ``sinks.tables.land_rates``: the folder holds the date."""
    raw = spark.read.schema(f"{RATE_JSON}, date DATE").json(root)
    if day is not None:
        raw = raw.filter(F.col("date") == F.lit(day).cast("date"))
    return raw.withColumnRenamed("date", "fx_date")


def read_rate_documents(spark: SparkSession, root: str) -> DataFrame:
    """Landed documents, one per file, as text column ``value``."""
    return spark.read.text(root, wholetext=True)


def tag_rate_documents(documents: DataFrame, column: str = "value") -> DataFrame:
    """Add ``reject_reason``: ``malformed`` for text that is no list of tables, ``no_tables`` for an
    empty list, ``no_rates`` where not every table has rates. The text stays in its column."""
    tables = F.from_json(F.col(column), RATES_DOCUMENT)
    return tag_rejects(
        documents.withColumn("_tables", tables),
        {
            "malformed": F.col("_tables").isNull() | F.exists("_tables", lambda t: t.isNull()),
            "no_tables": F.size("_tables") == 0,
            "no_rates": F.exists("_tables", lambda t: F.coalesce(F.size(t["rates"]), F.lit(0)) <= 0),
        },
    ).drop("_tables")


def explode_rate_documents(
    documents: DataFrame,
    column: str = "value",
    today: Column | None = None,
    first_table_only: bool = False,
) -> DataFrame:
    """One row per rate of each table of each document.

    The date is ``effectiveDate``, or ``today`` when it is empty. Other columns stay. What gives no
    row is named by ``tag_rate_documents``.
    """
    today = F.current_date() if today is None else today
    tables = F.from_json(F.col(column), RATES_DOCUMENT)
    if first_table_only:
        tables = F.slice(tables, 1, 1)
    kept = [c for c in documents.columns if c != column]
    effective = F.coalesce(
        F.try_to_date(blank_to_null("_doc.effectiveDate"), "yyyy-MM-dd"), today
    )
    return documents.select(*kept, F.explode(tables).alias("_doc")).select(
        *kept,
        F.col("_doc.table").alias("table_name"),
        F.col("_doc.no").alias("table_no"),
        effective.alias("fx_date"),
        F.explode("_doc.rates").alias("_rate"),
    ).select(
        *kept, "table_name", "table_no", "fx_date",
        "_rate.currency", "_rate.code", "_rate.mid",
    )


def rate_file_name(code: Column | str, fx_date: Column | str) -> Column:
    """Published name of the file of one rate."""
    return F.concat(
        F.lit("nbp_rate_"), code, F.lit("_"), F.date_format(fx_date, "yyyyMMdd"), F.lit(".json")
    )
