"""Toxicity by weak supervision.

Voters are lexicon words, word-start patterns and densities of such words, found among labelled training
rows; each votes on a document by firing on it or abstains. Labels choose the voters and so fix their side; they
go no further. A generative label model looks at the votes alone: EM estimates from their agreement how
often each voter fires on either class and how common the classes are, and the correlations between voters within
a class discount voters that repeat each other. Its posterior labels train a linear classifier over the
votes and over hashed words of the text, so words that no voter knows count too. The classifier scores documents
in one narrow pass.

The model is fitted on a bounded sample, ``sample_rows`` rows with the smallest seeded hash; the score of
a document depends on its text alone. Nothing in the scoring pass is bounded or cut.

Defined results: null and empty texts get the score of a text without any vote; without labelled rows of
both classes all scores are 0; rows whose label is null are not learned from; repeated rows repeat.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import durable, seeded

SAMPLE_ROWS = 20_000
#: candidate words and word starts that the sample is matched with, and the most voters
CANDIDATES, VOTERS = 4096, 384
#: how many voters each toxic training document should get
COVER = 6
#: a voter must be this many times likelier in toxic documents
RATIO = 20.0
STARTS = range(3, 9)
#: shares of matching words at which a density pattern fires
DENSITY = (1 / 800, 1 / 400, 1 / 200, 1 / 140, 1 / 100, 1 / 70, 1 / 50, 1 / 25, 1 / 10)
#: buckets of hashed words, and the most of them that the classifier looks at
BUCKETS, FEATURES = 1 << 16, 512
#: belief that a document without any vote is toxic
UNHEARD = 0.01
_CACHE_WORDS = 1 << 17
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """Rows that are kept from learning: crc32 of the id as text divisible by ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts == 0


def word_features(raw: str) -> list[str]:
    """``=word`` and ``start*`` for the starts that are shorter than the word."""
    word = _EDGES.sub("", raw.lower())
    return ["=" + word, *(word[:k] + "*" for k in STARTS if len(word) > k)] if word else []


def bucket(raw: str) -> int:
    """Hashed word, -1 for what has no letter or digit."""
    word = _EDGES.sub("", raw.lower())
    return crc32(word.encode("utf-8", "replace")) % BUCKETS if word else -1


class Matcher(dict):
    """Numbers of the lexicon entries that a raw word matches, and its bucket if that is one of ``hashed``;
    emptied when it has grown past a fixed size."""

    def __init__(self, lexicon: list[str], hashed: dict[int, int] | None = None):
        super().__init__()
        self.numbers = {v: k for k, v in enumerate(lexicon)}
        self.hashed = hashed or {}

    def __missing__(self, raw: str) -> tuple[tuple[int, ...], int]:
        if len(self) > _CACHE_WORDS:
            self.clear()
        entries = tuple(self.numbers[f] for f in word_features(raw) if f in self.numbers)
        found = entries, self.hashed.get(bucket(raw), -1) if self.hashed else -1
        if len(raw) <= 64:
            self[raw] = found
        return found

    def read(self, text: str | None) -> tuple[list[int], int, list[int], int]:
        """Entries that occur in a text, how many steps of ``DENSITY`` the share of its words that
        match any reaches, its features of ``hashed``, and how many distinct words it has."""
        words = (text or "").split()
        distinct = set(words)
        entries: set[int] = set()
        features: set[int] = set()
        matching = set()
        for raw in distinct:
            hit, feature = self[raw]
            if hit:
                entries.update(hit)
                matching.add(raw)
            if feature >= 0:
                features.add(feature)
        hits = sum(map(matching.__contains__, words)) if matching else 0
        step = sum(hits >= share * len(words) for share in DENSITY) if hits else 0
        return sorted(entries), step, sorted(features), len(distinct)


def worth(distinct: int) -> float:
    """What a hashed word counts in a text of so many distinct words: chance words of a long text add up
    to no more than those of a short one."""
    return float(1 / np.sqrt(1 + distinct / 50))


@dataclass
class Model:
    """``entry`` maps a lexicon entry to its voter; the last ``len(DENSITY)`` voters are patterns that
    fire when the share of matching words reaches their step. All abstain below step ``gate``: a
    single chance match in a long text is no vote. ``hashed`` maps a bucket to its place in ``words``."""

    lexicon: list[str] = field(default_factory=list)
    entry: dict[int, int] = field(default_factory=dict)
    gate: int = 0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(DENSITY)))
    hashed: dict[int, int] = field(default_factory=dict)
    words: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -np.inf

    def votes(self, found: list[int], step: int) -> list[int]:
        if step < self.gate:
            return []
        lexical = [self.entry[k] for k in found if k in self.entry]
        return lexical + [len(self.entry) + k for k in range(self.gate - 1, step)]

    def score(self, found: list[int], step: int, features: list[int], distinct: int) -> float:
        if not self.lexicon:
            return 0.0
        z = self.bias + self.weights[self.votes(found, step)].sum() + worth(distinct) * self.words[features].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def label_model(votes: np.ndarray, times: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, dict]:
    """Posterior of class 1 for each vote pattern, a row of 0/1 that occurs ``times`` times, and what was
    estimated from the votes alone: how often a voter fires in either class, how common class 1 is, and how
    voters correlate within a class. Voters that fire together share their weight by these correlations, as do those that stay silent.

    All voters speak for class 1: EM starts from patterns with votes on that side. Documents without any vote
    say nothing of that class; they keep ``UNHEARD`` and anchor the other, or the classes could drift apart
    along languages instead. Two imagined documents for each voter and class, which it fires on in twenty of
    a hundred and in one of a thousand, keep rates off zero."""
    v = votes.shape[1]

    def correlations(weights: np.ndarray) -> np.ndarray:
        """Between voters over weighted patterns, each about its own mean; none where one hardly fires."""
        apart = votes - weights @ votes / weights.sum()
        joint = apart.T @ (apart * weights[:, None])
        spread = np.sqrt(np.diag(joint))
        return joint / (np.outer(spread, spread) + 0.5)

    # voters that fire alike in all documents are one voter from the start
    related = correlations(times)
    related[related < 0.9] = 0
    np.fill_diagonal(related, 1)
    silent = ~votes.any(axis=1)
    many = (votes / (votes @ related).clip(1)).sum(axis=1)
    post = np.where(silent, UNHEARD, many**2 / (many**2 + 9))  # a lone vote is no agreement
    spoken, guess = 2.0, (0.001, 0.2)
    fires = np.zeros((2, v))
    for step in range(rounds):
        for c, w in enumerate((times * (1 - post), times * post)):
            fires[c] = (w @ votes + spoken * guess[c]) / (w.sum() + spoken)
        prior = (times @ post + 1) / (times.sum() + 2)
        if step % 10 == 5:  # what the classes leave unexplained
            related = np.maximum(correlations(times * (1 - post)), correlations(times * post))
            related[related < 0.1] = 0
            np.fill_diagonal(related, 1)
        old = post
        quiet = 1 - votes
        odds = np.log(prior / (1 - prior)) + (votes / (votes @ related).clip(1)) @ np.log(fires[1] / fires[0])
        odds = odds + (quiet / (quiet @ related).clip(1)) @ np.log((1 - fires[1]) / (1 - fires[0]))
        post = np.where(silent, UNHEARD, 1 / (1 + np.exp(-np.clip(odds, -30, 30))))
        if step > 10 and np.abs(post - old).max() < 1e-6:
            break
    return post, {"fires": fires, "related": related, "prior": prior}


def linear_fit(
    features: np.ndarray, times: np.ndarray, target: np.ndarray, ridge: float | np.ndarray = 0.05, rounds: int = 40
) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps; the bias is not shrunk."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w, shrink = np.zeros(x.shape[1]), np.append(np.broadcast_to(ridge, features.shape[1]), 1e-6)
    loss = np.inf
    for _ in range(rounds):
        z = np.clip(x @ w, -30, 30)
        p = 1 / (1 + np.exp(-z))
        now = np.sum(times * (np.logaddexp(0, z) - target * z)) + 0.5 * np.sum(shrink * w * w)
        if loss - now < 1e-7 * (1 + abs(now)):
            break
        loss = now
        curve = x.T @ (x * (times * (p * (1 - p) + 1e-6))[:, None]) + np.diag(shrink)
        w = w - np.linalg.solve(curve, x.T @ (times * (p - target)) + shrink * w)
    return w[:-1], float(w[-1])


def _choose(votes: np.ndarray, times: np.ndarray, worth: np.ndarray) -> list[int]:
    """Voters that cover each of the toxic patterns ``COVER`` times, the most useful first, so that words
    which only copies of one document share add little."""
    lacking = np.full(len(votes), COVER)
    chosen: list[int] = []
    free = np.ones(votes.shape[1], bool)
    while len(chosen) < VOTERS:
        gain = np.where(free, (times * (lacking > 0)).astype(np.float32) @ votes * worth, 0)
        best = int(gain.argmax()) if len(gain) else 0
        if not len(gain) or gain[best] <= 0:
            break
        chosen.append(best)
        free[best] = False
        lacking = lacking - votes[:, best]
    return chosen


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> Model:
    """Fit on rows that are not held out. ``labels`` has ``id_col`` and ``label_col``."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
        .dropDuplicates(["id"])
    )
    rows = known.count()
    if not rows:
        return Model()
    if rows > sample_rows:  # a hash range of the size asked for
        draw = F.pmod(seeded(seed, F.col("id")), F.lit(1 << 20))
        known = known.where(draw < int((1 << 20) * sample_rows / rows))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # at most about sample_rows ids
    sample = durable(
        texts.join(F.broadcast(known), "id").dropDuplicates(["text"])
        .select("label", "text", (F.pmod(seeded(seed + 1, F.col("text")), F.lit(2)) == 0).alias("first"))
    )
    # entries found in one half are judged in the other: what only copies or chance brought fails there
    size = {(r["first"], r["label"]): r["count"] for r in sample.groupBy("first", "label").count().collect()}
    whole = [sum(n for (_, label), n in size.items() if label == k) for k in (0, 1)]
    if not all(whole):
        return Model()
    one, two = sample.where("first"), sample.where("not first")
    if len(size) < 4:  # a half lacks a class
        one = two = sample
        size = {(half, label): whole[label] for half in (True, False) for label in (0, 1)}
    (clean, toxic), (clean2, toxic2) = ((size[half, 0], size[half, 1]) for half in (True, False))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch["label"].to_pylist(), batch["text"].to_pylist()):
                found: set[str] = set()
                for raw in set((text or "").split()):
                    found.update(word_features(raw))
                seen[label].update(found)
        # only what occurs in toxic rows can become a voter; clean counts are taken for those later
        names = list(seen[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([seen[1][f] for f in names], pa.int64())],
            names=["feature", "toxic"],
        )

    least = max(2, toxic // 200)
    hot = one.where(F.col("label") == 1).mapInArrow(count, "feature string, toxic long")
    frequent = hot.groupBy("feature").agg(F.sum("toxic").alias("toxic")).where(F.col("toxic") >= least)
    ranked = frequent.orderBy(F.col("toxic").desc(), "feature").limit(8 * CANDIDATES).collect()
    names = [r["feature"] for r in ranked]
    shared = sample.sparkSession.sparkContext.broadcast(names)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"].to_pylist():
                seen.update(matcher.read(text)[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())],
            names=["number", "clean"],
        )

    cool = one.where(F.col("label") == 0).mapInArrow(match, "number int, clean long")
    in_clean = np.zeros(len(names))
    for r in cool.groupBy("number").agg(F.sum("clean").alias("clean")).collect():
        in_clean[r["number"]] = r["clean"]
    in_toxic = np.array([r["toxic"] for r in ranked], float)
    odds = (in_toxic / toxic) / ((in_clean + 0.5) / (clean + 1))
    good = np.flatnonzero(odds >= RATIO) if len(names) else np.zeros(0, int)
    good = good[np.argsort(-in_toxic[good] * np.log(odds[good]), kind="stable")][:CANDIDATES]
    if not len(good):
        return Model()
    picked = [names[k] for k in good]

    def readings(lexicon: list[str]) -> list:
        """Equal readings of the second half are counted, so few rows travel: most clean rows match
        nothing."""
        lent = sample.sparkSession.sparkContext.broadcast(lexicon)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(lent.value)
            for batch in batches:
                rows = [matcher.read(t) for t in batch["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch["label"], pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                     pa.array([r[1] for r in rows], pa.int32())],
                    names=["label", "found", "step"],
                )

        made = two.mapInArrow(read, "label int, found array<int>, step int")
        counted = made.groupBy("label", "found", "step").agg(F.count(F.lit(1)).alias("n"))
        return counted.orderBy("label", "found", "step").collect()

    seen = np.zeros((2, len(picked)))
    for r in readings(picked):
        seen[r["label"], r["found"]] += r["n"]
    odds = (seen[1] / toxic2) / ((seen[0] + 0.5) / (clean2 + 1))
    proven = np.flatnonzero((seen[1] > 0) & (odds >= RATIO))
    if not len(proven):
        return Model()
    picked, odds = [picked[k] for k in proven], odds[proven]
    patterns = readings(picked)
    clean, toxic = clean2, toxic2
    times = np.array([r["n"] for r in patterns], float)
    steps = np.array([r["step"] for r in patterns])
    is_toxic = np.array([r["label"] == 1 for r in patterns])
    ladder = range(1, len(DENSITY) + 1)
    apart = [times @ ((steps >= k) * np.where(is_toxic, 1 / toxic, -1 / clean)) for k in ladder]
    model = Model(picked, gate=1 + int(np.argmax(apart)))
    bad = [r["found"] for r in patterns if r["label"] == 1 and r["step"] >= model.gate]
    votes = np.zeros((len(bad), len(picked)), np.float32)
    for row, found in enumerate(bad):
        votes[row, found] = 1
    chosen = _choose(votes, times[is_toxic & (steps >= model.gate)], np.log(odds))
    del votes
    model.entry = {number: k for k, number in enumerate(chosen)}
    votes = np.zeros((len(patterns), len(chosen) + len(DENSITY)))
    for row, r in enumerate(patterns):
        votes[row, model.votes(r["found"], r["step"])] = 1
    posterior, _ = label_model(votes, times)
    believed = {(tuple(r["found"]), r["step"]): float(p) for r, p in zip(patterns, posterior)}
    base = float(times @ posterior / times.sum())
    lent = sample.sparkSession.sparkContext.broadcast((picked, believed))

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many texts hold a bucket, and how many of these are believed to be toxic."""
        lexicon, belief = lent.value
        matcher = Matcher(lexicon)
        held, mass = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for batch in batches:
            for text in batch["text"].to_pylist():
                here = list({bucket(raw) for raw in (text or "").split()} - {-1})
                found, step, _, _ = matcher.read(text)
                held[here] += 1
                mass[here] += belief[tuple(found), step]
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(held[at]), pa.array(mass[at])], names=["bucket", "held", "mass"]
        )

    leaning = (
        two.mapInArrow(lean, "bucket int, held double, mass double").groupBy("bucket")
        .agg(F.sum("held").alias("held"), F.sum("mass").alias("mass"))
        .where((F.col("held") >= 4) & (F.abs(F.col("mass") - base * F.col("held")) > 4 * F.sqrt(F.col("held") * base * (1 - base))))
        .orderBy(F.round(-F.abs(F.col("mass") - base * F.col("held")) / F.sqrt("held"), 6), "bucket").limit(FEATURES).collect()
    )
    model.hashed = {r["bucket"]: k for k, r in enumerate(leaning)}
    hashed = sample.sparkSession.sparkContext.broadcast(model.hashed)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, belief = lent.value
        matcher = Matcher(lexicon, hashed.value)
        for batch in batches:
            rows = [matcher.read(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int32())), pa.array([r[3] for r in rows], pa.int64()),
                 pa.array([belief[tuple(r[0]), r[1]] for r in rows], pa.float64())],
                names=["found", "step", "features", "distinct", "target"],
            )

    schema = "found array<int>, step int, features array<int>, distinct long, target double"
    # at most sample_rows rows; ordered, so that sums are added alike in every run
    seen_rows = two.mapInArrow(look, schema).orderBy("found", "step", "features", "distinct").collect()
    voters, size = len(chosen) + len(DENSITY), len(chosen) + len(DENSITY) + len(leaning)
    x = np.zeros((len(seen_rows), size))
    for row, r in enumerate(seen_rows):
        x[row, model.votes(r["found"], r["step"])] = 1
        x[row, [voters + k for k in r["features"]]] = worth(r["distinct"])
    ridge = np.where(np.arange(size) < voters, 0.05, 1.0)
    weights, model.bias = linear_fit(x, np.ones(len(x)), np.array([r["target"] for r in seen_rows]), ridge)
    model.weights, model.words = weights[:voters], weights[voters:]
    return model


def scored(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = shared.value
        matcher = Matcher(fitted.lexicon, fitted.hashed)
        for texts in parts:
            yield pd.Series([fitted.score(*matcher.read(t)) for t in texts], dtype="float64")

    return docs.withColumn(score_col, score(F.col(text_col)))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``."""
    model = fit(docs, labels, id_col, text_col)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return scored(narrow, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below one half."""
    model = fit(docs, labels, id_col, text_col)
    # a struct keeps the columns apart from the score, whatever their names
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("text", F.col(f"row.`{text_col}`"))
    return scored(rows, model).where(F.col("score") < 0.5).select("row.*")
