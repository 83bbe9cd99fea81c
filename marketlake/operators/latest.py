"""Latest-wins deduplication and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_wins(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column | str]
) -> DataFrame:
    """One row per key: the first by ``newest_first`` (columns sort descending).

    ``row_number() = 1`` becomes a partial group limit before the shuffle, so a hot
    key sends one row per map task, not all its versions.
    """
    order = [F.col(c).desc() if isinstance(c, str) else c for c in newest_first]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[Column | str],
) -> DataFrame:
    """Union by name (absent columns become null), then the newest row per key."""
    both = existing.unionByName(incoming, allowMissingColumns=True)
    return latest_wins(both, keys, newest_first)
