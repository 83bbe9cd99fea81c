"""Census and preview of raw files. File contents are not read for the census."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
    )


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``path, length, modified`` of the files with content below ``root``.

    Spark's scans leave out empty files; ``file_census`` counts those.
    """
    return _files(spark, root, glob).select(
        "path", "length", F.col("modificationTime").alias("modified")
    )


def file_census(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """One row: number of files, of empty ones, of those with content, and bytes.

    The number of all files is the size of the file listing that planning the scan
    holds anyway; files with content are counted by the scan.
    """
    found = _files(spark, root, glob)
    total = F.lit(len(found.inputFiles())).cast("bigint")
    with_content = F.count(F.lit(1))
    return found.select("length").agg(
        total.alias("files"),
        (total - with_content).alias("empty_files"),
        with_content.alias("files_with_content"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
    )


def _lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Lines with their file and a position that rises through each file."""
    reader = spark.read.option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").alias("line"),
    )


def rows_per_file(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Number of lines of each file that has any."""
    return _lines(spark, root, glob).groupBy("path").agg(F.count(F.lit(1)).alias("lines"))


def first_lines(spark: SparkSession, root: str, n: int = 3, glob: str = "*.csv") -> DataFrame:
    """First ``n`` lines of every file; a partial group limit keeps ``n`` per task."""
    w = Window.partitionBy("path").orderBy("block", "line_id")
    return (
        _lines(spark, root, glob)
        .withColumn("line_no", F.row_number().over(w))
        .filter(F.col("line_no") <= n)
        .select("path", "line_no", "line")
    )


def newest_file(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """One row for the file modified last (greatest path on a tie)."""
    newest = F.struct("modified", "path")
    return list_files(spark, root, glob).agg(
        F.max_by("path", newest).alias("path"),
        F.max_by("length", newest).alias("length"),
        F.max("modified").alias("modified"),
    )


def preview_newest(
    spark: SparkSession, root: str, head: int = 50, tail: int = 10, glob: str = "*"
) -> DataFrame:
    """First ``head`` and last ``tail`` lines of the newest file, with their numbers from 1; in a
    short file they overlap, as the numbers tell.

    Only the name and the line count of that one file pass through the driver.
    """
    found = newest_file(spark, root, glob).first()
    if found is None or found.path is None:
        raise FileNotFoundError(f"no files under {root}")
    lines = _lines(spark, found.path)
    total = lines.count()

    def cut(part: str, n: int, order: list, number: Column) -> DataFrame:
        few = lines.orderBy(*order).limit(n)
        placed = few.withColumn("k", F.row_number().over(Window.orderBy(*order)))
        return placed.select(F.lit(part).alias("part"), number.cast("long").alias("line_no"), "line")

    rising = [F.col("block"), F.col("line_id")]
    falling = [F.col("block").desc(), F.col("line_id").desc()]
    return cut("head", head, rising, F.col("k")).unionByName(
        cut("tail", tail, falling, F.lit(total) + 1 - F.col("k"))
    )
