"""Search against scores worked out one by one, and the odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from marketlake.llm.common import shared_place
from marketlake.llm.lexical import _Found, _visit, build_index, search, term_counts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    held = [(d, Counter(terms_of(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in held:
            m = 75 + 25 * c.total() * n // total
            score = 0
            for t in terms_of(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score:
                scored.append((-score, d is None, d or 0))
        out += [(item, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def found(spark, docs, items, k=20):
    root = shared_place(spark, "index")
    build_index(docs, root)
    return sorted(map(tuple, search(spark, root, items, k=k).collect()), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)] + ["The", "ÉTÉ", "naïve", "x_y", "日本"]
    weights = [1 / (k + 1) for k in range(len(words))]
    text = lambda n: " ".join(rng.choices(words, weights, k=n))
    docs = [(i, text(rng.choice([1, 3, 40, 40, 200, 900]))) for i in range(700)]
    docs += [(None, text(40)), (5, docs[5][1]), (900, None), (901, ""), (902, "-- ..")] + [(950 + i, docs[7][1]) for i in range(40)]
    items = [(i, text(rng.choice([1, 5, 30]))) for i in range(40)] + [(40, None), (41, "nowhere"), (42, "the THE the"), (0, "w1")]
    got = found(
        spark, spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("m", "chunk", "terms")}),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert got == sorted(brute(docs, items, 20), key=str)


def test_odd_and_empty_tables(spark, odd, none):
    items = [(1, "alpha BETA word3"), (2, None)]
    asked = spark.createDataFrame(items, "item_id long, text string")
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert found(spark, odd, asked) == sorted(brute(rows, items, 20), key=str)
    assert found(spark, none, asked) == []
    assert found(spark, odd, asked.limit(0)) == []


def test_terms_of_long_texts_are_counted_by_pieces():
    text = "ab " * 700_000 + "É" * 10
    assert term_counts(text) == {b"ab": 700_000, "É".encode() * 10: 1}


def test_strata_below_the_kth_score_are_passed_over():
    seen = _Found(1, 2)
    stratum = lambda bound, impact, ids: (
        np.array([bound]), np.array([0]), np.zeros(len(ids), int), np.array(impact), np.arange(len(ids)), np.array(ids)
    )
    low = stratum(5, [5, 4], [1, 2])
    high = stratum(9, [9, 8, 7], [3, 4, 5])
    broken = (np.array([6]), None, None, None, None, None)  # not looked into
    _visit([low, broken, high], np.array([[1]]), seen)
    assert seen.score.tolist() == [9, 8] and seen.id.tolist() == [3, 4]
