import hashlib
from collections import defaultdict

import pytest

from marketlake.llm.exact import drop_exact_copies, exact_groups, frequent, digests


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        plain = (text or "").translate({c: None for c in (9, 10, 11, 12, 13, 32)})
        groups[hashlib.sha256(plain.encode()).hexdigest()].append((doc_id, len(text or "")))
    out = []
    for digest, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        out += [(d, keep, len(members), d == keep, digest) for d, _ in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("support", [0.001, 0.2, 0.9])
def test_groups_equal_brute_force(spark, odd, support):
    got = exact_groups(odd, support=support).collect()
    assert sorted(map(tuple, got), key=str) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_a_third_of_all_rows_in_one_group(spark):
    rows = [(k, "hot  text" if k % 3 == 0 else f"text {k % 50}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    heavy = frequent(digests(docs), 0.1).collect()
    assert [(r.keep_id, r.group_size) for r in heavy] == [(0, 200)]
    assert sorted(map(tuple, exact_groups(docs, support=0.1).collect()), key=str) == brute(rows)


def test_drop_keeps_one_whole_row_of_each_text(odd, none):
    kept = drop_exact_copies(odd)
    assert kept.columns == odd.columns
    texts = ["".join((r.text or "").split()) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == 5
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [2, 5, 6, 8]
    assert exact_groups(none).count() == drop_exact_copies(none).count() == 0
