import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlake.llm.mixing import drop_unmixed, fit_counts, mix


def targets(sizes, weights=(5, 2, 1), most=3):
    """Water-filling by hand: sources by code point, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full = set()
    while True:
        free = [s for s in order if s not in full]
        left = sum(sizes.values()) - most * sum(sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] >= most * sizes[s]}
        if not above:
            return {s: share.get(s, most * sizes[s]) for s in order}
        full |= above


def test_targets_and_taken(spark, odd):
    rows = mix(odd).collect()
    sizes, taken = defaultdict(int), Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size and r.taken == r.size * r.repeats
    expected = targets(sizes)
    assert len(rows) == odd.count()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mix(odd).collect()), key=str)


def test_sources_come_near_their_target(spark):
    rows = [(k, "w " * (k % 37 + 1), f"s{k % 7}") for k in range(900)]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 60), st.integers(1, 9), max_size=8), st.integers(0, 3000))
def test_fit_is_the_nearest_sum_below(found, budget):
    sizes, counts = sorted(found), [found[s] for s in sorted(found)]
    took = fit_counts(sizes, counts, budget)
    total = sum(s * n for s, n in zip(sizes, counts))
    assert all(0 <= t <= n for t, n in zip(took, counts))
    if budget >= total:
        assert took == counts
        return
    got = sum(s * t for s, t in zip(sizes, took))
    assert got == nearest(sizes, counts, [n * budget // total for n in counts], budget)  # the proportional share stays


def nearest(sizes, counts, least, budget):
    """The nearest sum at or below ``budget`` with at least ``least`` of each size, as bits of one integer."""
    sums = 1 << sum(s * n for s, n in zip(sizes, least))
    for s, n, t in zip(sizes, counts, least):
        for _ in range(n - t):
            sums |= sums << s
    return (sums & ((1 << (budget + 1)) - 1)).bit_length() - 1


@pytest.mark.parametrize("seed", range(6))
def test_fit_of_long_documents_is_nearest_too(seed):
    """Budgets far beyond the room of the program: many sizes, one document or a few of each."""
    rnd = random.Random(seed)
    sizes = sorted(rnd.sample(range(1000, 1400), 150)) if seed % 2 else sorted(rnd.sample(range(1, 20_000), 60))
    counts = [rnd.randrange(1, 3) for _ in sizes]
    total = sum(s * n for s, n in zip(sizes, counts))
    for share in (3, 2):
        budget = total // share
        took = fit_counts(sizes, counts, budget)
        assert all(0 <= t <= n for t, n in zip(took, counts))
        shared = [n * budget // total for n in counts]
        assert sum(s * t for s, t in zip(sizes, took)) == nearest(sizes, counts, shared, budget)


def test_fit_of_very_long_documents_ends_near_its_budget():
    sizes = list(range(100_000, 140_000, 40))
    budget = sum(sizes) // 3
    assert 0 <= budget - sum(s * t for s, t in zip(sizes, fit_counts(sizes, [1] * 1000, budget))) < 40


def test_drop_repeats_what_is_taken_more_than_once(spark, odd, none):
    got = drop_unmixed(odd)
    assert got.columns == odd.columns
    assert mix(none).count() == drop_unmixed(none).count() == 0
    rows = [(1, "a b c", "s"), (2, "d e f g h i j k l", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    # 12 words; 9 for s, which is thrice its size; 3 for t, whose only document is longer
    assert Counter(r.doc_id for r in drop_unmixed(docs).collect()) == {1: 3}


def test_rows_of_one_id_or_none_are_taken_each_for_itself(spark):
    # all words of one source are taken, once
    rows = [(1, "a b c", "s"), (1, "d e", "s"), (None, "f g h i", "s"), (None, "f g h i", "s"), (2, "k", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as key", "2 as owner", "3 as repeats")
    got = drop_unmixed(docs)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((r[0], r[1]) for r in rows)
