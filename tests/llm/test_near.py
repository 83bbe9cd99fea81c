import random
from itertools import combinations

import numpy as np
import pytest

from marketlake.llm.components import components
from marketlake.llm.near import DOCUMENTS, drop_near_copies, minima, near_components, packed
from marketlake.llm.shingles import shingle_set


def shingles(text):
    words = [w.lower() for w in (text or "").encode().split()]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def brute(rows, percent):
    """(doc_id, set size, component, kept) for rows with ids."""
    sets = {i: shingles(t) for i, t in rows}
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((root(a), root(b)))
            top[high] = low
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in sets)


def varied(seed, groups=12, chain=60):
    """Unrelated texts, groups of copies with few and many edits, and one long chain of small edits,
    whose ends have nothing in common."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(5000)}"
    texts = []
    for g in range(groups):
        base = [word() for _ in range(rnd.choice((3, 30, 120)))]
        texts.append(list(base))
        for _ in range(rnd.randrange(8)):
            copy = list(base)
            for _ in range(rnd.choice((0, 1, 2, 4))):
                copy[rnd.randrange(len(copy))] = word()
            texts.append(copy)
    now = [word() for _ in range(150)]
    for k in range(chain):
        now = list(now)
        now[(k * 7) % 150 : (k * 7) % 150 + 2] = [word(), word()]
        texts.append(now)
    rnd.shuffle(texts)
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


@pytest.mark.parametrize("percent", [80, 85])
def test_equals_all_pairs(spark, percent):
    rows = varied(percent)
    got = near_components(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()
    assert sorted(map(tuple, got)) == brute(rows, percent)


def test_a_hot_group_of_borderline_copies(spark):
    rnd = random.Random(4)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for k in range(700):  # more than two blocks, about half of the pairs on either side of the threshold
        copy = list(base)
        for at in rnd.sample(range(100), rnd.choice((1, 2, 3))):
            copy[at] = f"x{k}-{at}"
        rows.append((k, " ".join(copy)))
    got = near_components(spark.createDataFrame(rows, "doc_id long, text string"), percent=85).collect()
    assert sorted(map(tuple, got)) == brute(rows, 85)


def test_odd_rows(spark, odd, none):
    got = near_components(odd)
    assert got.count() == odd.count()
    found = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert found[1].component_id == found[2].component_id == 1 and found[2].n_shingles == 2
    assert found[7].component_id == 6 and found[6].kept and not found[7].kept
    assert all(found[k].component_id == k and found[k].n_shingles == 0 for k in (3, 4, 5))
    kept = drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 8]
    assert near_components(none).count() == drop_near_copies(none).count() == 0


def test_estimate_is_corrected_for_chance():
    rnd = np.random.default_rng(1)
    a = shingle_set(rnd.integers(0, 2**63, 4000, dtype=np.uint64))
    b = np.sort(np.concatenate([rnd.choice(a, 3000, replace=False), shingle_set(rnd.integers(0, 2**63, 600, dtype=np.uint64))]))
    exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    apart = packed(minima(a, DOCUMENTS)[None], DOCUMENTS)[0] ^ packed(minima(b, DOCUMENTS)[None], DOCUMENTS)[0]
    bits = apart
    for k in (1, 2, 3):
        bits = bits | apart >> np.uint64(k)
    equal = 1 - int(np.bitwise_count(bits & np.uint64(int("1" * 16, 16))).sum()) / 128
    assert abs((equal - 1 / 16) / (15 / 16) - exact) < 0.15


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 700)] + [(7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {(r.node, r.component) for r in got} == (
        {(k, 100) for k in range(101, 161)} | {(k, 500) for k in range(501, 700)})
