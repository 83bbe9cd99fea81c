"""Sinks of the serving layer: cells table, text export, key-value upload."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.fixed_values import SERVING_TABLE
from marketlake.operators.cells import CELL_KEY, put_command
from marketlake.schemas import CELLS
from marketlake.sinks.tables import spread, upsert_partitions


class PutClient(Protocol):
    """What an uploader needs from a key-value store client."""

    def put(self, cells: Sequence[tuple[str, str, str, str]]) -> None: ...

    def close(self) -> None: ...


def write_cells(
    spark: SparkSession, cells: DataFrame, root: str, dates: Sequence[str] = ()
) -> None:
    """Upsert cells into the table, partitioned by date and sorted by row key.

    Needs a ``version`` timestamp. ``dates`` (those of the run) bounds what is read back.
    Earlier dates stay; sorted row groups make point reads skip data.
    """
    upsert_partitions(
        spark, cells, root, CELLS,
        keys=(*CELL_KEY, "date"),
        newest_first=("version",),
        partition_by=("date",),
        partitions=[{"date": d} for d in dates],
        sort_by=("rowkey",),
    )


def export_put_commands(cells: DataFrame, root: str, table: str = SERVING_TABLE) -> None:
    """Text files of ``put`` commands, one folder per date, written in parallel."""
    lines = spread(cells, ["date"]).select("date", put_command(table).alias("value"))
    lines.write.mode("overwrite").partitionBy("date").text(root)


def upload_cells(
    cells: DataFrame, connect: Callable[[], PutClient], batch_rows: int = 1_000
) -> DataFrame:
    """Send cells to a store from the executors; returns one row with the count sent.

    ``connect`` is called once per task. A lost task is run again and its puts are sent
    twice: a put overwrites its own cell, so the store ends up the same. The returned
    frame is lazy; reading its only row runs the upload.
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = connect()
        try:
            for pdf in batches:
                rows = list(pdf.itertuples(index=False, name=None))
                for at in range(0, len(rows), batch_rows):
                    client.put(rows[at : at + batch_rows])
                yield pd.DataFrame({"puts": [len(rows)]})
        finally:
            client.close()

    return (
        cells.select(*CELL_KEY, "value")
        .mapInPandas(send, "puts BIGINT")
        .agg(F.coalesce(F.sum("puts"), F.lit(0)).alias("puts"))
    )
