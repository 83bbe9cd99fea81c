"""Shards are even, gapless and keep groups whole; a hot group fills as few shards as it can."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marketlake.llm.shards import shard_documents, shares, write_shards


def placed(docs, **how):
    return shard_documents(docs, **how).collect()


def check(rows, shards):
    sizes, slots = Counter(r["shard"] for r in rows), defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(0 <= s < shards for s in sizes)
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def cut(rows):
    """(links cut, links) counted pair by pair."""
    groups = defaultdict(list)
    for r in rows:
        groups[bytes(r["link"])].append(r["shard"])
    pairs = [(a != b) for g in groups.values() for i, a in enumerate(g) for b in g[:i]]
    return sum(pairs), len(pairs)


def test_groups_that_fit_stay_whole(spark):
    rows = [(i, f"text {i}") for i in range(600)] + [(1000 + i, f"copy {i // 3}") for i in range(450)]
    got = placed(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(got) == len(rows)
    check(got, 24)
    missed, pairs = cut(got)
    assert pairs == 450 and missed <= 9
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[3]["size"] == len("text 3") + 8


def test_all_linked_and_a_group_larger_than_shards(spark):
    rows = [(i, "hot") for i in range(400)] + [(1000 + i, f"pair {i // 2}") for i in range(800)]
    got = placed(spark.createDataFrame(rows, "doc_id long, text string"), shards=12)
    check(got, 12)
    hot = Counter(r["shard"] for r in got if r["doc_id"] < 1000)
    # 400 copies fill four shards of 100; at random each of twelve would hold 33
    assert sum(n for _, n in hot.most_common(5)) >= 340
    pairs = defaultdict(set)
    for r in got:
        if r["doc_id"] >= 1000:
            pairs[bytes(r["link"])].add(r["shard"])
    assert sum(len(s) == 1 for s in pairs.values()) >= 360


def test_odd_rows(spark, odd, none):
    got = placed(odd)
    assert len(got) == odd.count()
    check(got, 24)
    nulls = [r for r in got if r["doc_id"] in (3, 4)]
    assert {(r["size"], r["text_crc32"]) for r in nulls} == {(8, 0)}
    assert placed(none) == []
    few = placed(odd, shards=3, link=F.col("source"))
    check(few, 3)


def test_quotas():
    demand = [[0, 10, 0], [0, 0, 0], [0, 10, 0]]
    taken = shares(demand, [10, 5, 10], 15)
    assert taken[0] == taken[2] == 1.0 and 0.45 < taken[1] <= 0.5
    # an exchange between full shards is free
    assert shares([[0, 4], [4, 0]], [9, 9], 9) == pytest.approx([1.0, 1.0])


def test_written_shards(spark, odd, tmp_path):
    write_shards(odd, str(tmp_path / "out"), shards=3, file_rows=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == odd.count() and set(back.columns) == {"doc", "slot", "shard"}
    same = back.select("doc.*")
    assert same.exceptAll(odd).count() == 0 and odd.exceptAll(same).count() == 0
