"""Compression of vectors to short codes: one codebook for each part, refined with adaptive distance bounds.

A vector is cut into equal parts; a part is replaced by the number of the nearest entry of its codebook.
Components are integers (``floor(scale * x)``), so distances, sums and ties are exact and a rerun agrees.

Rounds follow Drake and Hamerly: each part keeps its ``b`` closest entries, in order, with a lower bound of the
distance to each, and one outer bound for all others. When entries have moved, bounds shrink by as much.
Entries whose bound lies above the exact distance to the own one are out; the rest are compared in
integers, all of them only where the outer bound does not hold. ``b`` begins at a quarter of the entries and
shrinks, for each part, to what the last round needed, but not below an eighth. Bounds only save work:
they are kept in 16 bits, rounded down, and what they leave open is decided in integers.

State goes from round to round as a table in the shared folder. Only codebooks, their sums and a histogram
of needed bounds come to the driver: their size is that of the codebooks, whatever the number of rows.

Defined results: rows whose vector is null, empty, or has null or non-finite components are dropped; vectors of
another length than the first, lengths that the parts do not divide and components too large for
exact 64-bit sums are errors; rows without an id are coded, but begin a codebook only after all others; rows of
one id are rows of their own, ordered by their components; with fewer rows than entries codebooks are
shorter; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: of the parts that the bounds settle, how many the next width must settle too
SETTLED = 127 / 128
_ROWS = 1024
_UP, _DOWN = 1 + 1e-9, 1 - 1e-9
_STATE = "values array<int>, nearest binary, bounds binary, outer binary, need binary"


def _integers(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows whose vector is kept, its length for each; all their components), scaled and rounded down."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    numbers = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null becomes NaN
    owner = np.repeat(np.arange(len(sizes)), sizes)
    broken = np.bincount(owner[~np.isfinite(numbers)], minlength=len(sizes))
    keep = (sizes > 0) & (broken == 0)
    return np.flatnonzero(keep), sizes, np.floor(scale * numbers[keep[owner]])


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(book)), np.int64)
    for k in range(x.shape[1]):
        away = x[:, k, None] - book[:, k]
        out += away * away
    return out


def _down16(values: np.ndarray) -> np.ndarray:
    """16-bit floats at most as large as ``values``."""
    near = np.minimum(values, 65504).astype(np.float16)
    return np.where(near.astype(np.float64) > values, np.nextafter(near, np.float16(-np.inf)), near)


def closest(x: np.ndarray, book: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distance, entries, bounds, outer) by full comparison: the ``width`` closest entries in order."""
    entries = len(book)
    keys = _distances(x, book) * entries + np.arange(entries)
    if width < entries:
        keys = np.partition(keys, width, axis=1)[:, : width + 1]
    keys.sort(axis=1)
    bounds = np.sqrt(keys // entries) * _DOWN
    outer = bounds[:, width] if width < entries else np.full(len(x), np.inf)
    return keys[:, 0] // entries, keys[:, :width] % entries, bounds[:, :width], outer


def refined(
    x: np.ndarray, book: np.ndarray, move: np.ndarray, nearest: np.ndarray, bounds: np.ndarray, outer: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distance, entries, bounds, outer, need) after entries have moved by at most ``move``. ``need`` says how
    many other entries had to be compared; the number of entries kept stands for all of the codebook."""
    entries, width = len(book), nearest.shape[1]
    away = x - book[nearest[:, 0]]
    distance = (away * away).sum(axis=1)
    bounds, outer = bounds - move[nearest], outer - move.max()
    rest = np.hstack([bounds[:, 1:], outer[:, None]])
    # least bound of all entries from each place on; an entry as near with a smaller number would win
    least = np.minimum.accumulate(rest[:, ::-1], axis=1)[:, ::-1]
    need = (least <= (np.sqrt(distance) * _UP)[:, None]).sum(axis=1)
    bounds[:, 0] = np.sqrt(distance) * _DOWN
    some = np.flatnonzero((need > 0) & (need < width))
    if len(some):
        look = int(need[some].max()) + 1
        listed = nearest[some, :look].astype(np.int64)
        away = x[some, None, :] - book[listed]
        keys = (away * away).sum(axis=2) * entries + listed
        keys.sort(axis=1)
        distance[some], nearest[some, :look] = keys[:, 0] // entries, keys % entries
        bounds[some, :look] = np.sqrt(keys // entries) * _DOWN
    lost = np.flatnonzero(need == width)
    if len(lost):
        distance[lost], nearest[lost], bounds[lost], outer[lost] = closest(x[lost], book, width)
    return distance, nearest, bounds, outer, need


def _packed(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _assigned(
    state: DataFrame, books: np.ndarray, moves: np.ndarray | None, had: list[int], widths: list[int], last: bool
) -> DataFrame:
    """One assignment of every part to its nearest entry; with ``last`` codes and errors instead of state."""
    parts, _, wide = books.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, _ROWS) for b in batches for at in range(0, b.num_rows, _ROWS)):
            n = batch.num_rows
            values = batch["values"].flatten().to_numpy().astype(np.int64).reshape(n, parts, wide)
            own, error = np.empty((n, parts), np.uint8), np.zeros(n, np.int64)
            need, outers = np.zeros((n, parts), np.uint8), np.empty((n, parts), np.float16)
            lists, limits, at = [], [], 0
            if moves is not None:
                kept, held = _packed(batch["nearest"], np.uint8), _packed(batch["bounds"], np.float16)
                beyond = _packed(batch["outer"], np.float16)
            for p in range(parts):
                x, book, b = values[:, p], books[p], widths[p]
                if moves is None:
                    distance, nearest, bounds, outer = closest(x, book, b)
                else:
                    nearest, bounds = kept[:, at : at + had[p]], held[:, at : at + had[p]].astype(np.float64)
                    at += had[p]
                    outer = np.minimum(beyond[:, p], bounds[:, b:].min(axis=1, initial=np.inf))
                    distance, nearest, bounds, outer, need[:, p] = refined(
                        x, book, moves[p], nearest[:, :b].copy(), bounds[:, :b], outer
                    )
                error += distance
                own[:, p] = nearest[:, 0]
                lists.append(nearest.astype(np.uint8))
                limits.append(_down16(bounds))
                outers[:, p] = _down16(outer)
            if last:
                made = [pa.array([r.tobytes().hex() for r in own], pa.string()), pa.array(error)]
            else:
                made = [batch["values"], _binary(np.hstack(lists)), _binary(np.hstack(limits)), _binary(outers),
                        _binary(need)]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["carried"], *made], names=names)

    kinds = {f.name: f.dataType.simpleString() for f in state.schema}
    schema = f"id {kinds['id']}, carried {kinds['carried']}, " + ("code string, error long" if last else _STATE)
    names = ["id", "carried", *[c.split()[0] for c in schema.split(", ")[-2 if last else -5 :]]]
    columns = ["id", "carried", "values"] + (["nearest", "bounds", "outer"] if moves is not None else [])
    return state.select(*columns).mapInArrow(assign, schema)


def _sums(state: DataFrame, shape: tuple[int, int, int], widths: list[int]) -> tuple[np.ndarray, ...]:
    """(rows of each entry, their component sums, how many rows needed 0, 1, ... other entries by part)."""
    parts, entries, wide = shape
    starts = np.cumsum([0, *widths[:-1]])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # place 0 counts, 1 to wide are sums, the last place is the histogram
        totals = np.zeros((parts, max(entries, max(widths) + 1), wide + 2), np.int64)
        for batch in (b.slice(at, _ROWS) for b in batches for at in range(0, b.num_rows, _ROWS)):
            values = batch["values"].flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, parts, wide)
            own, need = _packed(batch["nearest"], np.uint8)[:, starts], _packed(batch["need"], np.uint8)
            for p in range(parts):
                np.add.at(totals[p, :, 0], own[:, p], 1)
                np.add.at(totals[p, :, 1 : wide + 1], own[:, p], values[:, p])
                np.add.at(totals[p, :, wide + 1], need[:, p], 1)
        found = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c.astype(np.int32)) for c in found], pa.array(totals[found])],
            names=["part", "entry", "place", "total"],
        )

    rows = (
        state.select("values", "nearest", "need")
        .mapInArrow(add, "part int, entry int, place int, total long")
        .groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))
        .collect()  # the codebooks' size, not the table's
    )
    totals = np.zeros((parts, max(entries, max(widths) + 1), wide + 2), np.int64)
    for r in rows:
        totals[r.part, r.entry, r.place] = r.total
    return totals[:, :entries, 0], totals[:, :entries, 1 : wide + 1], totals[:, :, wide + 1]


def next_widths(needed: np.ndarray, widths: list[int], entries: int) -> list[int]:
    """For each part the smallest width that would have settled nearly all that the present one did."""
    least, out = max(1, entries // 8), []
    for counts, width in zip(needed, widths):
        settled = np.cumsum(counts[:width])
        wanted = int(np.searchsorted(settled, settled[-1] * SETTLED)) + 1 if settled[-1] else width
        out.append(max(min(least, width), min(width, wanted)))
    return out


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    carry_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """((id, carried, code, error), codebooks): one row for each vector kept, its entries as two hex digits for
    each part and the sum of its squared distances; codebooks as integers by part, entry and position."""
    if not 0 < entries <= 256:
        raise ValueError("two hex digits name at most 256 entries")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, _ROWS) for b in batches for at in range(0, b.num_rows, _ROWS)):
            rows, sizes, numbers = _integers(batch["vector"], scale)
            if not len(rows):
                continue
            wide = int(sizes[rows[0]]) // parts
            limit = math.isqrt((1 << 61) // (4 * max(1, wide) * entries))
            if (sizes[rows] % parts).any() or (np.abs(numbers) > min(limit, 1 << 30)).any():
                raise ValueError(f"a vector does not cut into {parts} parts or a component is beyond {limit / scale}")
            offsets = np.concatenate([[0], np.cumsum(sizes[rows])]).astype(np.int32)
            values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers.astype(np.int32)))
            some = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch["id"].take(some), batch["carried"].take(some), values], names=["id", "carried", "values"]
            )

    narrow = vectors.select(
        F.col(id_col).alias("id"), F.col(carry_col).alias("carried"), F.col(vector_col).alias("vector")
    )
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    head = f"id {kinds['id']}, carried {kinds['carried']}"
    kept = stored(narrow.mapInArrow(parse, f"{head}, values array<int>"))
    first = kept.orderBy(F.col("id").asc_nulls_last(), "values").limit(entries).select("values").collect()
    if not first:
        nothing = vectors.sparkSession.createDataFrame([], f"{head}, code string, error long")
        return nothing, np.zeros((parts, 0, 0), np.int64)
    size = len(first[0]["values"])
    if kept.where(F.size("values") != size).take(1):
        raise ValueError(f"vectors differ in length from the first, which has {size} components")
    seeds = np.array([r["values"] for r in first], np.int64)
    books = seeds.reshape(len(seeds), parts, -1).swapaxes(0, 1)
    entries = len(seeds)
    widths = [max(1, entries // 4)] * parts
    had, moves, state = widths, None, kept
    for _ in range(rounds):
        state = stored(_assigned(state, books, moves, had, widths, last=False))
        rows, sums, needed = _sums(state, books.shape, widths)
        moved = np.where(rows[:, :, None] > 0, sums // np.maximum(rows, 1)[:, :, None], books)
        shift = _lengths(moved - books)
        had = widths
        if moves is not None:  # the first round compares all and says nothing about need
            widths = next_widths(needed, widths, entries)
        moves, books = shift, moved
    return _assigned(state, books, moves, had, widths, last=True), books


def _lengths(away: np.ndarray) -> np.ndarray:
    """Lengths of moves, rounded up."""
    return np.sqrt((away * away).sum(axis=2)) * _UP


def codebook_table(spark, books: np.ndarray) -> DataFrame:
    """(part, entry, components) of codebooks."""
    rows = [(p, e, [int(v) for v in entry]) for p, book in enumerate(books) for e, entry in enumerate(book)]
    return spark.createDataFrame(rows, "part int, entry int, components array<long>")


def restored(coded: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``coded`` with the vector that its code stands for: the entries' components, scaled back."""

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.arange(len(books))
        for batch in batches:
            vectors = [
                (books[parts, list(bytes.fromhex(code))].reshape(-1) + 0.5) / scale for code in batch["code"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(vectors, pa.list_(pa.float64()))], names=[*batch.schema.names, "vector"]
            )

    from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

    schema = StructType([*coded.schema.fields, StructField("vector", ArrayType(DoubleType()))])
    return coded.mapInArrow(restore, schema)
