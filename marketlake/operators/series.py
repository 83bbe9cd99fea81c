"""Skew-safe row windows over long series.

``Window.partitionBy(entity)`` puts a whole series into one task. That is fine for
daily series, whose length is bounded by the calendar, but not for ticks or
minute bars, where one symbol may hold a third of all rows. ``cut_series`` cuts each
series at times into blocks of about a fixed number of rows, and gives each block the
rows before it that its frames look back to. A frame over at most ``halo`` earlier rows
then has the same result in a block as over the whole series.

The cuts come from a count of rows by (entity, time chunk), so rows are not numbered: each
finds its block by its own time and is shuffled once, by (entity, block).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketlake.functions import ntz_to_instant

CHUNK = "_chunk"
BLOCK = "_block"
HALO = "_halo"
_CUTS = "_cuts"
_SECONDS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}
#: chunk of rows without a time, before all others
_TIMELESS = -(2**63)


@dataclass(frozen=True)
class Blocks:
    """How to cut a long series.

    ``chunk`` ("30 seconds", "1 hour") is what is never cut: a block has fewer than ``rows`` rows
    and one chunk more, and repeats less than one chunk more than the frame needs. So it should be
    so short that one chunk of the hottest entity is well below ``rows``. Rows without a time are one
    chunk, the first of their entity.
    """

    chunk: str = "1 minute"
    rows: int = 1_000_000

    @property
    def seconds(self) -> int:
        number, unit = self.chunk.split()
        return int(number) * _SECONDS[unit.removesuffix("s")]


def time_chunk(df: DataFrame, ts: str, seconds: int) -> Column:
    """Number of the time chunk of ``ts`` since 1970; in no session zone, and null stays null."""
    kind = df.schema[ts].dataType.typeName()
    instant = F.col(ts) if kind == "timestamp" else ntz_to_instant(F.col(ts).cast("timestamp_ntz"))
    return F.floor(F.unix_seconds(instant) / F.lit(seconds)).cast("long")


def series_cuts(chunked: DataFrame, entity: Sequence[str], halo: int, rows: int) -> DataFrame:
    """(entity, starts, feeds), a row for each entity of more than one block.

    ``starts`` has the first chunk of each block but the first, ``feeds`` the chunk from which rows are
    repeated at its head. The counts by (entity, chunk) are bounded by the calendar, the cuts by the
    number of rows divided by ``rows``.
    """
    in_order = Window.partitionBy(*entity).orderBy(CHUNK)
    by_count = Window.partitionBy(*entity).orderBy("_before")
    counted = (
        chunked.groupBy(*entity, CHUNK)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_before",
            F.coalesce(F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        # with fewer than halo rows before it, a block gets all of them
        .withColumn(
            "_feed",
            F.coalesce(
                F.max(CHUNK).over(by_count.rangeBetween(Window.unboundedPreceding, -halo)),
                F.lit(_TIMELESS),
            ),
        )
        .withColumn(BLOCK, F.floor(F.col("_before") / F.lit(rows)))
    )
    cuts = (
        counted.filter(F.col(BLOCK) > 0)
        .groupBy(*entity, BLOCK)
        .agg(F.min(CHUNK).alias("start"), F.min("_feed").alias("feed"))
        .groupBy(*entity)
        .agg(F.array_sort(F.collect_list(F.struct("start", "feed"))).alias(_CUTS))
    )
    return cuts.select(
        *entity, F.col(f"{_CUTS}.start").alias("starts"), F.col(f"{_CUTS}.feed").alias("feeds")
    )


def _passed(key: Column, sorted_keys: Column) -> Column:
    """How many of ``sorted_keys`` are at most ``key``, by binary search."""
    bits = F.ceil(F.log2(F.size(sorted_keys) + 1)).cast("int")
    return F.aggregate(
        F.sequence(bits - 1, F.lit(0), F.lit(-1)),
        F.lit(0),
        lambda n, bit: F.when(
            F.coalesce(
                F.get(sorted_keys, n + F.call_function("shiftleft", F.lit(1), bit) - 1) <= key,
                F.lit(False),
            ),
            n + F.call_function("shiftleft", F.lit(1), bit),
        ).otherwise(n),
    )


def cut_series(
    df: DataFrame,
    entity: Sequence[str],
    ts: str,
    order: Sequence[str],
    halo: int,
    blocks: Blocks,
) -> tuple[DataFrame, WindowSpec]:
    """Blocks with halo rows, and the ordered window to use on them.

    ``ts`` is the first column of ``order``. A null entity is an entity, and rows without a time come
    first, as in a plain window. Drop the rows flagged ``_halo`` afterwards (``drop_halo``).
    """
    if halo > blocks.rows:
        raise ValueError(f"halo {halo} is longer than a block of {blocks.rows} rows")
    chunked = df.withColumn(CHUNK, F.coalesce(time_chunk(df, ts, blocks.seconds), F.lit(_TIMELESS)))
    cuts = series_cuts(chunked, entity, halo, blocks.rows).alias("r")
    same = F.lit(True)
    for k in entity:  # a null entity is an entity
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    whole = F.col("r.starts").isNull()
    own = F.when(whole, F.lit(0)).otherwise(_passed(F.col(f"l.{CHUNK}"), F.col("r.starts")))
    last = F.when(whole, F.lit(0)).otherwise(_passed(F.col(f"l.{CHUNK}"), F.col("r.feeds")))
    cut = (
        chunked.alias("l")
        .join(cuts, same, "left")
        .select(*[F.col(f"l.`{c}`") for c in df.columns], own.alias("_own"), last.alias("_last"))
        .withColumn(BLOCK, F.explode(F.sequence("_own", F.greatest("_own", "_last"))))
        .withColumn(HALO, F.col(BLOCK) > F.col("_own"))
        .drop("_own", "_last")
    )
    return cut, Window.partitionBy(*entity, BLOCK).orderBy(*order)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(BLOCK, HALO)


def over_series(
    df: DataFrame,
    entity: Sequence[str],
    ts: str,
    order: Sequence[str],
    halo: int,
    blocks: Blocks | None,
    columns,
) -> DataFrame:
    """Add window columns that look back at most ``halo`` rows.

    ``columns`` maps an ordered ``WindowSpec`` to ``{name: Column}``. Without ``blocks``
    one plain window per entity is used: right for calendar-bounded series.
    """
    if blocks is None:
        made: dict[str, Column] = columns(Window.partitionBy(*entity).orderBy(*order))
        return df.withColumns(made)
    cut, window = cut_series(df, entity, ts, order, halo, blocks)
    return drop_halo(cut.withColumns(columns(window)))
