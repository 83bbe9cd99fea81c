import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm.queries import op6_toxicity
from marketlake.llm.toxicity import drop_toxic, fit, held_out, label_model, scored, toxicity


def planted(spark, n=1500):
    rnd = random.Random(2)
    docs, labels = [], []
    for k in range(n):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice((15, 60, 200)))]
        toxic = k % 9 == 0
        if toxic:
            for _ in range(max(1, len(words) // 30)):
                words[rnd.randrange(len(words))] = rnd.choice(("vile", "rotten", f"zork{rnd.randrange(40)}"))
        docs.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_rows_are_told_apart(spark):
    docs, labels = planted(spark)
    got = toxicity(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    away = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.toxic for r in away]) > 0.97
    # held-out labels are not looked at
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity(docs, turned).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score) for r in got)


def test_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    away = op6_toxicity(spark, sf).join(labels, "doc_id").where("held_out and toxic is not null").collect()
    assert np.mean([r.predicted == r.toxic for r in away]) > 0.9


def test_label_model_counts_repeating_voters_once():
    rnd = np.random.default_rng(0)
    truth = rnd.random(4000) < 0.2
    fires = lambda p, q: np.where(truth, rnd.random(4000) < p, rnd.random(4000) < q)
    good, weak = fires(0.7, 0.01), fires(0.4, 0.2)
    votes = np.stack([good, fires(0.6, 0.01), weak, weak, weak, weak], axis=1).astype(float)
    post, found = label_model(votes, np.ones(4000))
    assert found["related"][2, 3] > 0.9 and found["related"][0, 2] < 0.2
    only_weak = votes[:, 2].astype(bool) & ~votes[:, :2].any(axis=1)
    assert (post[only_weak] < 0.5).all() and np.mean((post > 0.5) == truth) > 0.9


def test_label_model_learns_rates_from_agreement_alone():
    rnd = np.random.default_rng(3)
    truth = rnd.random(6000) < 0.15
    rates = [(0.6, 0.01), (0.5, 0.02), (0.3, 0.005), (0.4, 0.05), (0.55, 0.03)]
    votes = np.stack([np.where(truth, rnd.random(6000) < p, rnd.random(6000) < q) for p, q in rates], axis=1).astype(float)
    post, found = label_model(votes, np.ones(6000))
    for k, (p, q) in enumerate(rates):
        assert abs(found["fires"][1, k] - p) < 0.08 and abs(found["fires"][0, k] - q) < 0.03
    assert abs(found["prior"] - 0.15) < 0.05 and np.mean((post > 0.5) == truth) > 0.95
    # counted patterns give what single rows give
    patterns, times = np.unique(votes, axis=0, return_counts=True)
    again, _ = label_model(patterns, times.astype(float))
    for pattern, p in zip(patterns, again):
        assert post[(votes == pattern).all(axis=1)] == pytest.approx(p, abs=1e-3)


def test_words_that_no_voter_knows_count(spark):
    """A word without a vote is learned from the posterior of the documents that it comes with."""
    docs, labels = planted(spark)
    docs = docs.join(labels, "doc_id").withColumn(
        "text", F.when((F.col("toxic") == 1) & (F.col("doc_id") % 2 == 0), F.concat("text", F.lit(" murk"))).otherwise(
            F.when(F.col("doc_id") % 97 == 0, F.concat("text", F.lit(" murk"))).otherwise(F.col("text")))
    ).select("doc_id", "text")
    model = fit(docs, labels)
    assert model.hashed and any(model.words > 0)
    told = spark.createDataFrame([(1, "w1 w2 w3 murk w4"), (2, "w1 w2 w3 w5 w4")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in scored(told, model).collect()}
    assert score[1] > score[2]


def test_odd_rows(spark, odd, none):
    _, labels = planted(spark, 40)
    docs, _ = planted(spark)
    nothing = toxicity(odd, labels.where("false"))
    assert {(r.score, r.predicted) for r in nothing.collect()} == {(0.0, 0)} and nothing.count() == odd.count()
    assert toxicity(none, labels).count() == 0 and drop_toxic(none, labels).count() == 0
    kept = drop_toxic(odd, labels.withColumn("toxic", F.lit(None).cast("int")))
    assert kept.columns == odd.columns and kept.count() == odd.count()
    model = fit(*planted(spark))
    same = scored(odd.select("doc_id", "text"), model).where("text is null or text = ''").collect()
    assert len({r.score for r in same}) == 1 and same[0].score < 0.5
