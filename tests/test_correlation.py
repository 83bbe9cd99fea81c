import datetime as dt
import math
import random

import numpy as np
import pytest

from marketlake.operators.correlation import (
    correlation_table,
    pair_returns,
    rolling_correlation,
    rolling_sums,
)

SCHEMA = "base string, quote string, date date, x double, y double"
DAY = dt.date(2024, 1, 1)


def frame(spark, values, base="b", quote="q"):
    rows = [(base, quote, DAY + dt.timedelta(days=i), x, y) for i, (x, y) in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def corr(df, **options):
    return [r["corr"] for r in rolling_correlation(df, **options).orderBy("date").collect()]


def test_pairs_mode_skips_rows_with_a_null(spark):
    got = corr(frame(spark, [(None, 1.0), (1.0, 2.0), (2.0, 4.0), (4.0, 5.0)]))
    assert got[:2] == [None, None]
    assert got[2] == pytest.approx(1.0)
    assert got[3] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4, 5])[0, 1])


def test_compat_mode_counts_every_row(spark):
    values = [(None, 1.0), (1.0, 2.0), (2.0, 4.0), (4.0, 5.0)]
    got = corr(frame(spark, values), mode="compat")
    expected = []
    for end in range(1, 5):
        part = values[:end]
        xs, ys = [x for x, _ in part if x is not None], [y for _, y in part]
        sx, sy = sum(xs), sum(ys)
        sxy = sum(x * y for x, y in part if x is not None)
        spread = (end * sum(x * x for x in xs) - sx * sx) * (end * sum(y * y for y in ys) - sy * sy)
        ok = end >= 2 and xs and spread > 0
        expected.append((end * sxy - sx * sy) / math.sqrt(spread) if ok else None)
    assert got == [None if e is None else pytest.approx(e) for e in expected]


def test_constant_series_gives_null(spark):
    for mode in ("pairs", "compat"):
        assert corr(frame(spark, [(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)]), mode=mode) == [None] * 3


def test_min_pairs(spark):
    got = corr(frame(spark, [(1.0, 2.0), (2.0, 3.0), (3.0, 5.0)]), min_pairs=3)
    assert got[:2] == [None, None] and got[2] is not None


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        rolling_correlation(frame(spark, [(1.0, 2.0)]), mode="x")


def test_frame_is_63_rows_per_pair(spark):
    rng = random.Random(3)
    values = [(rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(100)]
    other = [(rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(100)]
    df = frame(spark, values).unionByName(frame(spark, other, "b2"))
    made = rolling_correlation(df)
    for base, series in (("b", values), ("b2", other)):
        got = [r["corr"] for r in made.filter(made.base == base).orderBy("date").collect()]
        for i in range(1, 100):
            part = np.array(series[max(0, i - 62) : i + 1])
            if len(part) > 1:
                assert got[i] == pytest.approx(np.corrcoef(part.T)[0, 1], abs=1e-9)
    counts = [r.n for r in rolling_sums(df).filter("base = 'b'").orderBy("date").collect()]
    assert counts == [min(i + 1, 63) for i in range(100)]


def test_pair_returns_takes_listed_pairs_only(spark):
    day = DAY
    base = spark.createDataFrame(
        [("A", day, 0.1), ("B", day, 0.2), ("C", day, 0.3)], "symbol string, date date, ret_1d double"
    )
    quote = spark.createDataFrame(
        [("USD", day, 1.0), ("EUR", day, 2.0), ("USD", day + dt.timedelta(1), 3.0)],
        "code string, fx_date date, ret_1d double",
    )
    made = pair_returns(base, quote, [("A", "USD"), ("A", "EUR"), ("B", "USD"), ("B", "USD")])
    assert sorted((r.base, r.quote, r.x, r.y) for r in made.collect()) == [
        ("A", "EUR", 0.1, 2.0), ("A", "USD", 0.1, 1.0), ("B", "USD", 0.2, 1.0),
    ]
    table = correlation_table(base, quote, "A", "USD")
    assert table.columns == ["date", "corr_btc_usdpln_63d"] and table.count() == 1
