"""Wide-column serving rows as a long table ``(rowkey, family, qualifier, value)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.fixed_values import (
    ROW_KEY_DATE_FORMAT,
    SALT_BUCKETS,
    SERVED_CELLS,
    SERVING_TABLE,
)
from marketlake.functions import row_key
from marketlake.operators.latest import upsert

CELL_KEY = ("rowkey", "family", "qualifier")
CellSpec = Sequence[tuple[str, str, str, str | None]]

# Extra cells on top of the published ones: the close under its own name and the
# quote volume, which is computed anyway.
EXTENDED_CELLS: CellSpec = (
    *SERVED_CELLS,
    ("price", "close", "close", None),
    ("volume", "quote", "volume_quote_sum", None),
)


def with_row_key(facts: DataFrame, buckets: int = SALT_BUCKETS) -> DataFrame:
    return facts.withColumn("rowkey", row_key("symbol", "date", buckets))


def to_cells(facts: DataFrame, cells: CellSpec = SERVED_CELLS) -> DataFrame:
    """Unpivot facts to cells; null values and rows without a key give none. Narrow."""
    keyed = facts if "rowkey" in facts.columns else with_row_key(facts)

    def value(column: str, only: str | None) -> Column:
        text = F.col(column).cast("string")
        return text if only is None else F.when(F.col("symbol") == only, text)

    made = F.array(
        *[
            F.struct(
                F.lit(family).alias("family"),
                F.lit(qualifier).alias("qualifier"),
                value(column, only).alias("value"),
            )
            for family, qualifier, column, only in cells
        ]
    )
    return (
        keyed.filter(F.col("rowkey").isNotNull())
        .select("rowkey", "date", F.inline(made))
        .filter(F.col("value").isNotNull())
    )


def row_key_date(rowkey: Column | str) -> Column:
    """Date part of a row key: the text after its last separator."""
    return F.try_to_date(F.substring_index(rowkey, "|", -1), ROW_KEY_DATE_FORMAT)


def get_row(cells: DataFrame, rowkey: Column | str, family: str | None = None) -> DataFrame:
    """Cells of one row, or of one family of it.

    The date part of the key is a partition filter on the stored table, and the key
    filter is pushed to the scan, where row groups sorted by key are skipped.
    """
    key = F.lit(rowkey) if isinstance(rowkey, str) else rowkey
    hit = cells.filter(F.col("rowkey") == key)
    if "date" in cells.columns:
        hit = hit.filter(F.col("date") == row_key_date(key))
    return hit if family is None else hit.filter(F.col("family") == family)


def scan_rows(
    cells: DataFrame, limit: int, start: str | None = None, stop: str | None = None
) -> DataFrame:
    """All cells of the first ``limit`` rows in key order, from ``start`` to before ``stop``.

    The limit counts rows, not cells: a distributed top-k over distinct keys gives at
    most ``limit`` keys, which then select the cells.
    """
    if start is not None:
        cells = cells.filter(F.col("rowkey") >= start)
    if stop is not None:
        cells = cells.filter(F.col("rowkey") < stop)
    first = cells.select("rowkey").distinct().orderBy("rowkey").limit(limit)
    return cells.join(first, "rowkey", "left_semi")


def put_cells(cells: DataFrame, puts: DataFrame, version: str = "version") -> DataFrame:
    """Upsert: per cell the highest version wins; on a tie the put beats what is stored."""
    put = "_put"
    made = upsert(
        cells.withColumn(put, F.lit(0)), puts.withColumn(put, F.lit(1)), CELL_KEY, (version, put)
    )
    return made.drop(put)


def delete_cells(cells: DataFrame, deletes: DataFrame) -> DataFrame:
    """Remove the cells listed by ``rowkey`` or by ``rowkey, family[, qualifier]``."""
    keys = [c for c in CELL_KEY if c in deletes.columns]
    return cells.join(deletes.select(*keys).distinct(), keys, "left_anti")


def pivot_cells(
    cells: DataFrame, spec: CellSpec = SERVED_CELLS, version: str | None = "version"
) -> DataFrame:
    """One row per key with a column ``family_qualifier`` for each listed cell, its newest value.

    Cells without a ``version`` column must hold each cell once: say so with ``version=None``.
    """
    order = F.lit(0) if version is None else F.col(version)
    here = lambda family, qualifier: (F.col("family") == family) & (F.col("qualifier") == qualifier)
    picked = [
        F.max_by("value", F.when(here(family, qualifier), order)).alias(f"{family}_{qualifier}")
        for family, qualifier, _, _ in spec
    ]
    return cells.groupBy("rowkey").agg(*picked)


def _quoted(text: Column) -> Column:
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.concat(F.lit("'"), escaped, F.lit("'"))


def put_command(table: str = SERVING_TABLE) -> Column:
    """Text of the ``put`` command of one cell, quotes escaped."""
    parts = [
        _quoted(F.lit(table)),
        _quoted(F.col("rowkey")),
        _quoted(F.concat_ws(":", "family", "qualifier")),
        _quoted(F.col("value")),
    ]
    return F.concat(F.lit("put "), F.concat_ws(", ", *parts))
