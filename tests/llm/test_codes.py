"""Vector codes against plain integer k-means, and the odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm.codes import closest, codebook_table, next_widths, refined, restored, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int"


def plain(rows, parts, entries, rounds, scale=256):
    """Codes and books by comparing everything in every round."""
    kept = [r for r in rows if r[1] and all(v is not None and np.isfinite(v) for v in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([[int(np.floor(scale * np.float64(np.float32(v)))) for v in r[1]] for r in kept], np.int64)
    x = x.reshape(len(kept), parts, -1)
    books = x[:entries].swapaxes(0, 1).copy()
    for turn in range(rounds + 1):
        away = ((x[:, :, None, :] - books[None]) ** 2).sum(-1)
        own = away.argmin(-1)
        if turn == rounds:
            break
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[own[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    error = np.take_along_axis(away, own[:, :, None], 2).sum((1, 2))
    return sorted((r[0] is None, r[0] or 0, bytes(o.tolist()).hex(), int(e)) for r, o, e in zip(kept, own, error)), books


@pytest.mark.parametrize("entries, rounds", [(64, 2), (16, 5), (5, 3)])
def test_equals_plain_rounds(spark, entries, rounds):
    rng = np.random.default_rng(entries)
    centres = rng.normal(0, 0.4, (12, 16))
    rows = [(int(i), [float(v) for v in np.float32(centres[i % 12] + rng.normal(0, 0.1, 16))], int(i % 3)) for i in range(700)]
    rows += rows[:5] + [(None, rows[3][1], None), (10_000, None, 1), (10_001, [], 1), (10_002, [float("nan")] * 16, 1),
                        (10_003, [None] * 16, 1), (10_004, [float("inf")] * 16, 1)]
    docs = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("clash") for c in ("id", "code", "values", "need")})
    coded, books = vector_codes(docs, parts=4, entries=entries, rounds=rounds)
    got = sorted((r["id"] is None, r["id"] or 0, r["code"], r["error"]) for r in coded.collect())
    want, want_books = plain(rows, 4, entries, rounds)
    assert got == want
    assert (books == want_books).all()


def test_few_rows_empty_table_and_errors(spark):
    two = spark.createDataFrame([(2, [0.5] * 16, 1), (1, [0.25] * 16, None)], VECTORS)
    coded, books = vector_codes(two)
    assert sorted(map(tuple, coded.collect())) == [(1, None, "00" * 16, 0), (2, 1, "01" * 16, 0)]
    assert books.shape == (16, 2, 1)
    none, books = vector_codes(two.limit(0))
    assert none.columns == ["id", "carried", "code", "error"] and not none.take(1) and not books.size
    for bad in ([0.5] * 32, [0.5] * 17, [1e30] * 16):
        with pytest.raises(Exception, match="vector"):
            vector_codes(two.unionAll(spark.createDataFrame([(3, bad, 1)], VECTORS)))[0].collect()


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(3)
    x = rng.integers(-200, 200, (3000, 4))
    book = rng.integers(-200, 200, (64, 4))
    _, nearest, bounds, outer = closest(x, book, 16)
    moved = book + rng.integers(-6, 7, book.shape)
    move = np.sqrt(((moved - book) ** 2).sum(1))
    distance, nearest, bounds, outer, need = refined(x, moved, move, nearest, bounds, outer)
    away = ((x[:, None] - moved) ** 2).sum(-1)
    assert (nearest[:, 0] == away.argmin(1)).all() and (distance == away.min(1)).all()
    true = np.sqrt(np.take_along_axis(away, nearest.astype(int), 1))
    assert (bounds <= true + 1e-9).all()
    rest = away.astype(float)
    np.put_along_axis(rest, nearest.astype(int), np.inf, 1)
    assert (outer <= np.sqrt(rest.min(1)) + 1e-9).all()
    assert (need < 16).mean() > 0.9
    widths = next_widths(np.array([np.bincount(need, minlength=17)]), [16], 64)
    assert 8 <= widths[0] <= 16


def test_restored_vectors_are_near(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(0, 0.2, 32)], 0) for i in range(400)]
    coded, books = vector_codes(spark.createDataFrame(rows, VECTORS))
    assert codebook_table(spark, books).count() == 16 * 64
    for r in restored(coded, books).collect():
        away = sum((a - b) ** 2 for a, b in zip(r["vector"], rows[r["id"]][1])) * 256 * 256
        assert away == pytest.approx(r["error"], rel=0.2, abs=200)
