import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketlake.sinks.cellstore import CellStore

PUTS = "rowkey string, family string, qualifier string, value string, version int"
MARKS = "rowkey string, family string, qualifier string, version int"


def timed(df):
    return df.withColumn("version", F.timestamp_seconds("version"))


def brute(changes):
    """The cells that are there, from (kind, key, family, qualifier, value, version) in order of batches."""
    puts, gone = {}, []
    for kind, key, family, qualifier, value, version in changes:
        if kind == "put":
            at = (key, family, qualifier)
            if at not in puts or version >= puts[at][0]:
                puts[at] = (version, value)
        else:
            gone.append((key, family, qualifier, version))
    return {
        at: v for at, (t, v) in puts.items()
        if not any(k == at[0] and f in (None, at[1]) and q in (None, at[2]) and g >= t for k, f, q, g in gone)
    }


def held(cells):
    rows = cells.collect()
    made = {(r.rowkey, r.family, r.qualifier): r.value for r in rows}
    assert len(made) == len(rows)
    return made


def test_random_changes_equal_brute_force(spark, tmp_path):
    rng = random.Random(4)
    store = CellStore(spark, str(tmp_path / "cells"))
    keys = [f"{k % 3}|S{k}|2024010{1 + k % 2}" for k in range(6)]
    done = []
    for batch in range(6):
        puts, marks = [], []
        for _ in range(25):
            at = (rng.choice(keys), rng.choice("fg"), rng.choice("ab"))
            puts.append((*at, f"{batch}-{len(done) + len(puts):04}", rng.randrange(8)))
        for depth in (1, 2, 3):
            key, *rest = (rng.choice(keys), rng.choice("fg"), rng.choice("ab"))
            parts = (rest + [None, None])[: depth - 1] + [None] * (3 - depth)
            marks.append((key, *parts, rng.randrange(8)))
        store.put(timed(spark.createDataFrame(puts, PUTS)), f"p{batch}")
        store.delete(timed(spark.createDataFrame(marks, MARKS)), f"q{batch}")
        done += [("put", *p) for p in puts] + [("gone", k, f, q, None, t) for k, f, q, t in marks]
        if batch == 2:
            store.put(timed(spark.createDataFrame(puts, PUTS)), f"p{batch}")  # a batch written again
        if batch in (1, 4):
            before = held(store.read())
            store.compact(["2024-01-01"] if batch == 1 else ())
            assert held(store.read()) == before
            # after folding, markers are gone: late versions below them would come back, as in any such store
            done = [("put", *at, v, t) for at, (t, v) in _versions(store).items()] if batch == 4 else done
            if batch == 1:
                done = [d for d in done if d[1].endswith("02")] + [
                    ("put", *at, v, t) for at, (t, v) in _versions(store).items() if at[0].endswith("01")]
        assert held(store.read()) == brute(done)


def _versions(store):
    rows = store.read().withColumn("version", F.unix_seconds("version")).collect()
    return {(r.rowkey, r.family, r.qualifier): (r.version, r.value) for r in rows}


def test_a_deleted_date_disappears(spark, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"))
    rows = [("1|A|20240101", "f", "a", "x", 1), ("2|B|20240101", "f", "a", "y", 1), ("1|A|20240102", "f", "a", "z", 1)]
    assert store.read().count() == 0
    store.load(timed(spark.createDataFrame(rows, PUTS)))
    with pytest.raises(ValueError, match="holds cells"):
        store.load(timed(spark.createDataFrame(rows, PUTS)))
    store.delete(timed(spark.createDataFrame([("1|A|20240101", 2)], "rowkey string, version int")))
    store.compact()
    stored = spark.read.parquet(store.cells_root)
    assert {r.rowkey for r in stored.collect()} == {"2|B|20240101", "1|A|20240102"}
    store.delete(timed(spark.createDataFrame([("2|B|20240101", "f", 2)], "rowkey string, family string, version int")))
    store.compact()
    assert {p.name for p in (tmp_path / "cells" / "cells").iterdir() if p.is_dir()} == {"date=2024-01-02"}
    assert not any((tmp_path / "cells" / "changes").glob("date=*/batch=*/*.parquet"))
    assert held(store.read()) == {("1|A|20240102", "f", "a"): "z"}


def test_put_after_delete_and_ties(spark, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"))
    at = ("1|A|20240101", "f", "a")
    store.put(timed(spark.createDataFrame([(*at, "old", 1)], PUTS)), "a")
    store.delete(timed(spark.createDataFrame([(*at, 1)], MARKS)), "b")
    assert held(store.read()) == {}
    store.put(timed(spark.createDataFrame([(*at, "new", 2)], PUTS)), "c")
    assert held(store.read()) == held(store.get(at[0])) == held(store.get(at[0], "f")) == {at: "new"}
    assert held(store.get(at[0], "g")) == {}


def test_a_change_without_a_key_or_value_fails(spark, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"))
    for row in ((None, "f", "a", "x", 1), ("1|A|20240101", None, "a", "x", 1), ("1|A|20240101", "f", "a", None, 1)):
        with pytest.raises(PySparkException, match="a change needs"):
            store.put(timed(spark.createDataFrame([row], PUTS)))


@pytest.mark.parametrize("compacted", [False, True])
def test_scan_in_key_order(spark, tmp_path, compacted):
    store = CellStore(spark, str(tmp_path / "cells"), buckets=11)
    keys = sorted(f"{s}|S{k}|2024010{1 + k % 3}" for s in ("0", "1", "10", "2", "x") for k in range(4))
    rows = [(k, "f", q, "v", 1) for k in keys for q in "ab"]
    store.put(timed(spark.createDataFrame(rows, PUTS)))
    if compacted:
        store.compact()
    store.delete(timed(spark.createDataFrame([(keys[1], 1)], "rowkey string, version int")))
    left = keys[:1] + keys[2:]
    for limit, start, stop in ((1, None, None), (5, None, None), (99, None, None), (3, "1|", None),
                               (9, "10|S2", "2|S1"), (4, "3", None), (0, None, None)):
        wanted = [k for k in left if k >= (start or "") and (stop is None or k < stop)][:limit]
        got = store.scan(limit, start, stop).collect()
        assert sorted(r.rowkey for r in got) == sorted(k for k in wanted for _ in "ab"), (limit, start, stop)


def test_scan_reads_the_key_range_it_needs(spark, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"))
    rows = [(f"{s}|S{k}|20240101", "f", "a", "v", 1) for s in "012" for k in range(5)]
    store.put(timed(spark.createDataFrame(rows, PUTS)))
    store.compact()
    text = store.scan(3)._jdf.queryExecution().executedPlan().toString()
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", text)
    assert len(pushed) == 2  # cells and changes
    for filters in pushed:
        assert "GreaterThanOrEqual(rowkey,0|S0|20240101)" in filters
        assert "LessThanOrEqual(rowkey,0|S2|20240101)" in filters
