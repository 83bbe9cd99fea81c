"""A stored table of versioned cells with puts, deletes, ordered scans and compaction.

Two Parquet tables below one root:

* ``cells``: resolved cells, each once, in folders by date, sorted by key, so by salt first;
* ``changes``: puts and delete markers not folded yet, in folders by date and batch.

A write only ever adds to ``changes``, so it never reads what is stored; a batch written again under its
name replaces itself. Reads settle both tables: of a cell the newest put, unless a marker of
the cell, its family or its row is as new or newer. ``compact`` folds changes into ``cells`` and takes the
markers away. It can stop anywhere: changes that are in ``cells`` already settle to the same cells.
One compaction at a time; puts may go on beside it, since it removes only the batches it has read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.fixed_values import SALT_BUCKETS
from marketlake.operators.cells import get_row, row_key_date
from marketlake.schemas import CELLS
from marketlake.sinks.tables import drop_partitions, replace_partitions
from marketlake.sources.tables import partition_predicate, read_table_or_none

PUT, DELETE = "put", "delete"
_ROW = ("date", "rowkey")
STORED = f"{CELLS}, folded STRING"
CHANGES = f"{CELLS}, kind STRING, batch STRING"


def salt_borders(buckets: int) -> list[str]:
    """First keys of the salts, in key order: "1|" comes after "10|"."""
    return sorted(f"{n}|" for n in range(buckets))


def settle(changes: DataFrame) -> DataFrame:
    """(date, rowkey, family, qualifier, value, version): the cells that are there.

    A marker without a qualifier covers its family, one without a family its row. Of equal versions a
    marker beats a put, and of puts the greatest batch, then value. Versions of a
    cell meet as partial maxima, so a cell put very often sends one row for each task; a window then
    holds the cells of one row.
    """
    put = F.col("kind") == PUT
    by_row, by_family = Window.partitionBy(*_ROW), Window.partitionBy(*_ROW, "family")
    row_wide = F.col("family").isNull()
    family_wide = ~row_wide & F.col("qualifier").isNull()
    cells = (
        changes.groupBy(*_ROW, "family", "qualifier")
        .agg(
            F.max(F.when(put, F.struct("version", "batch", "value"))).alias("_put"),
            F.max(F.when(~put, F.col("version"))).alias("_gone"),
        )
        .withColumn("_row_gone", F.max(F.when(row_wide, F.col("_gone"))).over(by_row))
        .withColumn("_family_gone", F.max(F.when(family_wide, F.col("_gone"))).over(by_family))
    )
    gone = F.greatest("_gone", "_row_gone", "_family_gone")
    there = F.col("_put").isNotNull() & F.coalesce(F.col("_put.version") > gone, F.lit(True))
    return cells.filter(there).select(*_ROW, "family", "qualifier", "_put.value", "_put.version")


def _required(df: DataFrame, *columns: str) -> DataFrame:
    """Fail on a null in ``columns``; drop nothing."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    message = F.lit(f"a change needs all of {', '.join(columns)}")
    return df.filter(F.when(whole, True).otherwise(F.raise_error(message).cast("boolean")))


@dataclass(frozen=True)
class CellStore:
    spark: SparkSession
    root: str
    buckets: int = SALT_BUCKETS

    @property
    def cells_root(self) -> str:
        return f"{self.root}/cells"

    @property
    def changes_root(self) -> str:
        return f"{self.root}/changes"

    def _made(self, changes: DataFrame, kind: str, batch: str) -> DataFrame:
        columns = self.spark.createDataFrame([], CHANGES).columns
        absent = {c: F.lit(None).cast("string") for c in ("family", "qualifier", "value") if c not in changes.columns}
        known = {"date": row_key_date("rowkey"), "kind": F.lit(kind), "batch": F.lit(batch)}
        return _required(changes.withColumns(absent | known), "date", "version").select(*columns)

    def _add(self, changes: DataFrame, kind: str, batch: str | None) -> None:
        made = self._made(changes, kind, batch or uuid.uuid4().hex)
        replace_partitions(made, self.changes_root, ("date", "batch"), ("rowkey",))

    def _fold(self, settled: DataFrame, run: str) -> None:
        columns = self.spark.createDataFrame([], STORED).columns
        made = settled.withColumn("folded", F.lit(run)).select(*columns)
        replace_partitions(made, self.cells_root, ("date",), ("rowkey",))

    def load(self, cells: DataFrame) -> None:
        """First load of a store, past the changes. Columns as in ``put``."""
        if read_table_or_none(self.spark, self.cells_root, STORED) is not None:
            raise ValueError(f"{self.root} holds cells: put into it")
        made = self._made(_required(cells, "family", "qualifier", "value"), PUT, "")
        self._fold(settle(made), uuid.uuid4().hex)

    def put(self, cells: DataFrame, batch: str | None = None) -> None:
        """Cells (rowkey, family, qualifier, value, version). Give ``batch`` where a write may be repeated."""
        self._add(_required(cells, "family", "qualifier", "value"), PUT, batch)

    def delete(self, keys: DataFrame, batch: str | None = None) -> None:
        """Markers (rowkey[, family[, qualifier]], version): rows, families or cells that go, with all
        their puts up to that version."""
        self._add(keys.drop("value"), DELETE, batch)

    def _all(self, changes: DataFrame | None) -> DataFrame:
        stored = read_table_or_none(self.spark, self.cells_root, STORED)
        empty = self.spark.createDataFrame([], CHANGES)
        parts = [
            df for df in (
                None if stored is None
                else stored.drop("folded").withColumns({"kind": F.lit(PUT), "batch": F.lit("")}),
                changes,
            ) if df is not None
        ]
        made = empty if not parts else parts[0]
        for other in parts[1:]:
            made = made.unionByName(other)
        return made

    def _changes(self) -> DataFrame | None:
        return read_table_or_none(self.spark, self.changes_root, CHANGES)

    def read(self) -> DataFrame:
        """All cells. Filters by date or key reach the scans of both tables."""
        return settle(self._all(self._changes()))

    def get(self, rowkey: Column | str, family: str | None = None) -> DataFrame:
        key = F.lit(rowkey) if isinstance(rowkey, str) else rowkey
        return get_row(self.read(), key, family)

    def scan(self, limit: int, start: str | None = None, stop: str | None = None) -> DataFrame:
        """All cells of the first ``limit`` rows in key order, from ``start`` to before ``stop``.

        Keys start with their salt, so the ranges between salts are visited in key order; row groups of
        a range that is not needed for ``limit`` rows are not read. At most ``limit`` keys come to the
        driver, and the first and last of them bound the scan of the cells.
        """
        key = F.col("rowkey")
        cells = self.read()
        if start is not None:
            cells = cells.filter(key >= start)
        if stop is not None:
            cells = cells.filter(key < stop)
        borders = salt_borders(self.buckets)
        keys: list[str] = []
        for low, high in zip([None, *borders], [*borders, None]):
            if len(keys) >= limit or (stop is not None and low is not None and low >= stop):
                break
            if start is not None and high is not None and high <= start:
                continue
            here = cells if low is None else cells.filter(key >= low)
            here = here if high is None else here.filter(key < high)
            first = here.select("rowkey").distinct().orderBy("rowkey").limit(limit - len(keys))
            keys += [r.rowkey for r in first.collect()]
        return cells.filter(key.between(keys[0], keys[-1]) if keys else F.lit(False))

    def compact(self, dates: Sequence[str] = ()) -> None:
        """Fold the changes of ``dates``, or of all dates, into the cells.

        Only dates with changes are rewritten. A date whose cells are all gone loses its folder.
        """
        changes = self._changes()
        if changes is None:
            return
        folders = changes.select(F.col("date").cast("string").alias("date"), "batch").distinct()
        if dates:
            folders = folders.filter(F.col("date").isin(list(dates)))
        folded = [r.asDict() for r in folders.collect()]
        if not folded:
            return
        days = [{"date": d} for d in sorted({f["date"] for f in folded})]
        taken = changes.filter(partition_predicate(changes, folded))
        merged = self._all(taken)
        run = uuid.uuid4().hex
        self._fold(settle(merged.filter(partition_predicate(merged, days))), run)
        stored = read_table_or_none(self.spark, self.cells_root, STORED)
        held = stored.filter(partition_predicate(stored, days)).groupBy(
            F.col("date").cast("string").alias("date")
        ).agg(F.max(F.col("folded") == run).alias("new"))
        empty = [{"date": r.date} for r in held.filter(~F.col("new")).collect()]
        # markers last: until then they still cover what an emptied folder holds
        drop_partitions(self.spark, self.cells_root, ("date",), empty)
        drop_partitions(self.spark, self.changes_root, ("date", "batch"), folded)
