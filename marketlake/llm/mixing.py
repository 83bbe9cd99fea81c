"""Mixing of sources to target weights by subset-sum budget fitting.

Sizes are exact word counts. Each source gets a target by water-filling: shares by weight, none above
``most`` times the source. A source takes all its documents ``floor(target / size)`` times and fits the
rest of its budget with a bounded knapsack: documents counted by exact size, a proportional share of
every size first, then a dynamic program over the sums that the documents left over can reach. Which
documents of a size are taken follows a seeded hash.

Ranks within (source, size) are counted in ``SLOTS`` hash slots first, so that no task holds a whole
source or a whole group of copies. Only scalars of the water-filling come to the driver.

Defined results: null text has size 0 and empty texts too, nothing is taken of them; a null source is a
source of its own, the last; a source without words has target 0; repeated rows count each; ties of the
hash go by id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import durable, parallelism, seeded, stored

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
SLOTS = 4096
SEED = 20
#: longest documents' worth of words that the dynamic program fills, and the most sums that it may keep
ROOM, STATES = 8, 1 << 24


def word_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str, draw: Column) -> DataFrame:
    """(doc_id, source, draw, size); ``bytes.split`` cuts at exactly the blanks of the contract."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [0 if t is None else len(t.encode("utf-8").split()) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["source"], batch["draw"], pa.array(sizes, pa.int64())],
                names=["doc_id", "source", "draw", "size"],
            )

    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), draw.alias("draw"), F.col(text_col).alias("text")
    )
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    return narrow.mapInArrow(count, f"doc_id {kinds['doc_id']}, source {kinds['source']}, draw long, size long")


def source_targets(sized: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """(source, source_size, target) by water-filling; one pass over the sources for each round."""
    spark = sized.sparkSession
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # code point order is the byte order of UTF-8; ranks are cut from ranges, not from one task
    slices = durable(
        totals.repartitionByRange(parallelism(spark), F.col("source").asc_nulls_last())
        .withColumn("slice", F.spark_partition_id())
    )
    # one row for each slice, of which there are as many as shuffle partitions
    running = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = slices.groupBy("slice").count().select(
        "slice", F.coalesce(F.sum("count").over(running), F.lit(0)).alias("before")
    )
    place = (
        F.row_number().over(Window.partitionBy("slice").orderBy(F.col("source").asc_nulls_last()))
        + F.col("before") - 1
    )
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = durable(
        slices.join(F.broadcast(before), "slice").select(
            "source", "source_size",
            F.element_at(cycle, (F.pmod(place, F.lit(len(weights))) + 1).cast("int")).alias("weight"),
        )
    )
    words = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    rate, full = 0.0, -1
    while True:
        above = F.col("source_size") * F.lit(most) <= F.col("weight") * F.lit(rate)
        state = weighed.agg(
            F.count_if(above).alias("full"),
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("free"),
        ).first()
        if state["full"] == full or not state["free"]:
            break
        full = state["full"]
        rate = (words - most * state["held"]) / state["free"]
    share = F.least(F.col("source_size") * F.lit(most), F.col("weight") * F.lit(rate))
    return weighed.select("source", "source_size", share.cast("double").alias("target"))


def fit_counts(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each size to take, at most ``counts``, so that their sizes sum to
    ``budget`` or to the nearest sum below it that the sizes left over allow.

    A proportional share of each size keeps the mix like its source; whole documents from the
    longest down bring the rest within ``ROOM`` of the longest documents. That rest goes to the dynamic
    program, which notes for every sum the step that first reached it. Where it can't be met exactly, the
    room is doubled as long as ``STATES`` sums hold it.
    """
    total = sum(s * n for s, n in zip(sizes, counts))
    if budget >= total:
        return list(counts)
    room, best = ROOM * max(sizes, default=0), None
    while True:
        taken, short = _fill(sizes, counts, budget, total, min(room, STATES))
        if best is None or short < best[1]:
            best = taken, short
        if short == 0 or room >= min(budget, STATES):
            return best[0]
        room *= 2


def _fill(sizes: list[int], counts: list[int], budget: int, total: int, room: int) -> tuple[list[int], int]:
    """Counts by size, and how far their sum ends below ``budget``; about ``room`` words are left to choose."""
    taken = [int(n * budget // total) for n in counts]
    left = budget - sum(s * n for s, n in zip(sizes, taken))
    order = sorted((i for i, s in enumerate(sizes) if s > 0), key=lambda i: -sizes[i])
    for i in order:
        more = min(counts[i] - taken[i], max(0, left - room) // sizes[i])
        taken[i] += more
        left -= more * sizes[i]
    reached = np.zeros(left + 1, bool)
    reached[0] = True
    first = np.full(left + 1, -1, np.int32)
    steps: list[tuple[int, int]] = []
    for i in reversed(order):  # short documents first: they reach every sum soonest
        spare, block = min(counts[i] - taken[i], left // sizes[i]), 1
        while spare > 0 and not reached[left]:
            block = min(block, spare)
            by = block * sizes[i]
            new = np.flatnonzero(reached[:-by] & ~reached[by:]) + by
            first[new] = len(steps)
            reached[new] = True
            steps.append((i, block))
            spare -= block
            block *= 2
        if reached[left]:
            break
    at = int(np.flatnonzero(reached)[-1])
    short = left - at
    while at:
        i, block = steps[first[at]]
        taken[i] += block
        at -= block * sizes[i]
    return taken, short


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("size").reset_index(drop=True)
    budget = int(round(float(pdf["budget"].iloc[0])))
    chosen = fit_counts([int(x) for x in pdf["size"]], [int(x) for x in pdf["docs"]], budget)
    return pd.DataFrame({"source_key": pdf["source_key"], "size": pdf["size"], "chosen": chosen})


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST,
    seed: int = SEED,
    drawn_by: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, source, size, source_size, target, repeats, taken), one row for each row of ``docs``;
    ``taken`` is ``size * repeats``. Rows of a source and size are chosen in the order of a seeded hash of the
    columns ``drawn_by``, the id unless named."""
    # a null source must join: its key is empty, other keys start with a mark
    key = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    sized = durable(
        word_counts(docs, id_col, text_col, source_col, seeded(seed, *[F.col(c) for c in drawn_by or (id_col,)]))
        .withColumn("source_key", key)
        .withColumn("slot", F.pmod("draw", F.lit(SLOTS)))
    )
    targets = durable(
        source_targets(sized, weights, most)
        .withColumn("source_key", key)
        .withColumn(
            "whole",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0),
        )
        .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
        .drop("source")
    )
    slots = durable(sized.groupBy("source_key", "size", "slot").agg(F.count(F.lit(1)).alias("slot_docs")))
    lengths = slots.groupBy("source_key", "size").agg(F.sum("slot_docs").alias("docs"))
    fitted = (
        lengths.join(targets.select("source_key", "budget"), "source_key")
        .groupBy("source_key")
        .applyInPandas(_fit, "source_key string, size long, chosen long")
    )
    # rows of a (source, size): at most SLOTS; the running count says where a slot starts
    earlier = Window.partitionBy("source_key", "size").orderBy("slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        slots.withColumn("start", F.coalesce(F.sum("slot_docs").over(earlier), F.lit(0)))
        .join(fitted, ["source_key", "size"])
        .join(targets, "source_key")
        .drop("slot_docs", "budget")
    )
    within = Window.partitionBy("source_key", "size", "slot").orderBy("draw", F.col("doc_id").asc_nulls_last())
    ranked = sized.withColumn("place", F.row_number().over(within))
    repeats = F.col("whole") + (F.col("start") + F.col("place") <= F.col("chosen")).cast("long")
    return ranked.join(starts, ["source_key", "size", "slot"]).select(
        "doc_id", "source", "size", "source_size", "target",
        repeats.alias("repeats"), (F.col("size") * repeats).alias("taken"),
    )


def drop_unmixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how
) -> DataFrame:
    """The rows of the mix with all columns of ``docs``: each row as often as it is taken. Rows are told apart
    by a key of their own, so rows of one id, or without an id, are taken each for itself; which ones are
    taken depends on id and text, and no column's name can clash."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    keyed = stored(docs.select(row, F.monotonically_increasing_id().alias("key")))
    told = keyed.select(
        "key", F.col("row")[id_col].alias("owner"), F.col("row")[text_col].alias("text"), F.col("row")[source_col].alias("source")
    )
    taken = (
        mix(told, "key", "text", "source", drawn_by=("owner", "text"), **how)
        .where(F.col("repeats") > 0)
        .select(F.col("doc_id").alias("key"), "repeats")
    )
    times = F.explode(F.array_repeat(F.lit(True), F.col("repeats").cast("int")))
    return keyed.join(taken, "key").select("row", times.alias("time")).select("row.*")
