"""Ranked lexical search over an index that is cut by document length.

Documents with an equal normaliser ``m``, which depends on their length alone, are a stratum. In a stratum the
postings of a term are kept by term frequency, most frequent first, so an impact is worked out once for
each frequency and not for each posting, and the first run bounds what a term can add there. A search
bounds the score of every stratum for every item, visits strata from the highest bound down, and passes over
those whose bound lies below the item's k-th best score so far. Nothing is left out that could rank.

The index is a table: a row for each stratum or, of large strata, for each chunk of at most ``CHUNK_DOCS``
documents and about ``CHUNK_TERMS`` terms, dealt by row number, so neither a common length nor a common word is
one task. All documents are indexed, whole. Items are searched in blocks that bound what is broadcast: an item's
weights and terms; each task holds the k best rows of each item in the block and one chunk at a time.

Defined results: null and empty texts and texts without a term are not found and not counted; an item without
a term, or without a document of positive score, has no rows; equal scores go by ascending id, rows without an
id last; rows of one id, and items of one id, are rows of their own; texts of any length are counted
whole, piece by piece; an empty table gives none.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.llm.common import durable, stored
from marketlake.llm.near import _grouped

K = 20
CHUNK_DOCS, CHUNK_TERMS = 1024, 1 << 18
#: an items block holds at most so many (item, distinct term) cells, unless a single item has more
BLOCK_CELLS = 1 << 22
#: strata of several chunks that may be broadcast, 16 bytes each; more are joined by a shuffle
BROADCAST_STRATA = 100_000
_SLICE = 1 << 20
#: ASCII other than digits and letters becomes a blank, A-Z become a-z, all else is part of a term
_FOLD = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)
_STRATA = "m long, ids array<long>, terms array<binary>, term_at array<int>, run_tf array<int>, run_at array<int>, places array<int>"
_LAST = np.iinfo(np.int64).max


def term_counts(text: str | None) -> Counter:
    """How often each term is in a text."""
    raw, found, at = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD), Counter(), 0
    while at < len(raw):
        end = raw.find(b" ", at + _SLICE)
        end = len(raw) if end < 0 else end
        found.update(raw[at:end].split())
        at = end
    return found


def _counted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs) of the rows with a term: terms parted by blanks, frequencies as 32-bit words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
            found = [term_counts(t.as_py()) for t in batch["text"]]
            some = [k for k, c in enumerate(found) if c]
            held = [found[k] for k in some]
            yield pa.RecordBatch.from_arrays(
                [batch["id"].take(pa.array(some, pa.int32())), pa.array([c.total() for c in held], pa.int64()),
                 pa.array([b" ".join(c) for c in held], pa.binary()),
                 pa.array([np.fromiter(c.values(), "<i4", len(c)).tobytes() for c in held], pa.binary())],
                names=["id", "n", "terms", "tfs"],
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(count, "id long, n long, terms binary, tfs binary")


def _starts(changes: np.ndarray) -> np.ndarray:
    """Where runs begin, and the end, of rows that differ from the one before where ``changes`` says so."""
    return np.concatenate([[0], np.flatnonzero(changes) + 1, [len(changes) + 1]]).astype(np.int32)


def _stratum(group: pa.Table) -> list:
    """One index row of the documents of one chunk."""
    terms = pc.split_pattern(group["terms"].combine_chunks(), " ")
    owner = np.repeat(np.arange(len(terms)), pc.list_value_length(terms).to_numpy())
    coded = terms.flatten().dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    tf = np.frombuffer(b"".join(group["tfs"].to_pylist()), "<i4").astype(np.int64)
    order = np.lexsort((owner, -tf, code))
    code, tf = code[order], tf[order]
    new_term = code[1:] != code[:-1]
    run_at = _starts(new_term | (tf[1:] != tf[:-1]))
    term_at = np.searchsorted(run_at, _starts(new_term)).astype(np.int32)
    ids = group["id"].combine_chunks()
    return [group["m"][0].as_py(), ids, coded.dictionary, term_at, tf[run_at[:-1]].astype(np.int32), run_at,
            owner[order].astype(np.int32)]


def build_index(docs: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the index of ``docs`` below ``root``: its strata, and the counts of documents and terms."""
    counted = stored(_counted(docs, id_col, text_col))
    sizes = counted.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms"))
    sizes.write.parquet(f"{root}/sizes")
    total = docs.sparkSession.read.parquet(f"{root}/sizes").first()
    m = F.lit(75) + F.expr(f"(25 * n * {total['documents']}L) div {max(1, total['terms'])}L")
    rows = counted.withColumns({"m": m, "draw": F.monotonically_increasing_id()})
    cuts = rows.groupBy("m").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK_DOCS), F.ceil(F.sum("n") / CHUNK_TERMS)).alias("chunks")
    )
    # strata of one chunk, most of them, need no row; the others are few, but grow with the table
    cuts = durable(cuts.where(F.col("chunks") > 1))
    few = F.broadcast(cuts) if cuts.count() <= BROADCAST_STRATA else cuts
    chunk = F.pmod(F.xxhash64("draw"), F.coalesce("chunks", F.lit(1).cast("long")))
    dealt = rows.join(few, "m", "left").withColumn("chunk", chunk)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [f.split()[0] for f in _STRATA.split(", ")]
        kinds = [pa.int64(), *[pa.list_(k) for k in (pa.int64(), pa.binary(), *[pa.int32()] * 4)]]
        for group in _grouped(batches, ["m", "chunk"]):
            made = _stratum(group)
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(made, kinds)], names=fields)

    (
        dealt.select("m", "chunk", "id", "terms", "tfs")
        .repartition("m", "chunk")
        .sortWithinPartitions("m", "chunk", F.col("id").asc_nulls_last())
        .mapInArrow(gather, _STRATA)
        .write.parquet(f"{root}/strata")
    )


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Blocks of (item, term counts)."""
    block, terms = [], set()
    for row in items.toLocalIterator():
        counts = term_counts(row["text"])
        more = terms | counts.keys()
        if block and (len(block) + 1) * len(more) > BLOCK_CELLS:
            yield block
            block, more = [], set(counts)
        block.append((row["item"], counts))
        terms = more
    if block:
        yield block


class _Found:
    """The best rows of each item that a task has seen."""

    def __init__(self, items: int, k: int):
        self.k, self.item = k, np.empty(0, np.int64)
        self.score, self.id = np.empty(0, np.int64), np.empty(0, np.int64)
        #: what a row must reach
        self.least = np.ones(items, np.int64)
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, item: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.waiting.append((item, score, ids))
        self.size += len(item)
        if self.size > 2 * self.k * len(self.least) or not len(self.item):
            self.settle()

    def settle(self) -> None:
        item, score, ids = (np.concatenate(c) for c in zip((self.item, self.score, self.id), *self.waiting))
        order = np.lexsort((ids, -score, item))
        item, score, ids = item[order], score[order], ids[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        best = place < self.k
        full = place == self.k - 1
        self.least[item[full]] = score[full]
        self.item, self.score, self.id = item[best], score[best], ids[best]
        self.waiting, self.size = [], 0


def _visit(strata: list[tuple], weights: np.ndarray, found: _Found) -> None:
    """Score the strata of a batch, from the highest bound down. A stratum is (bound of each item, numbers of
    the terms, term number of each posting, impact of each posting, document of each posting, ids)."""
    for bound, terms, term, impact, place, ids in sorted(strata, key=lambda s: -int(s[0].max(initial=0))):
        items = np.flatnonzero(bound >= found.least)
        if not len(items):
            continue
        impacts = np.zeros((len(terms), len(ids)), weights.dtype)
        impacts[term, place] = impact
        scores = (weights[items][:, terms] @ impacts).astype(np.int64)
        item, at = np.nonzero(scores >= found.least[items, None])
        found.add(items[item], scores[item, at], ids[at])


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def search(
    spark: SparkSession, root: str, items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = K
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of the index for each row of ``items``."""
    strata = spark.read.parquet(f"{root}/strata")
    total = spark.read.parquet(f"{root}/sizes").first()
    asked = durable(items.select(
        F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"), F.col(text_col).alias("text")
    ))
    parts = [_search_block(spark, strata, total["documents"], block, k) for block in _blocks(asked.select("item", "text"))]
    best = spark.createDataFrame([], "item long, doc_id long, score long")
    for part in parts:
        best = best.unionAll(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _search_block(spark: SparkSession, strata: DataFrame, documents: int, block: list[tuple], k: int) -> DataFrame:
    names = sorted(set().union(*[counts for _, counts in block]))
    asked = spark.sparkContext.broadcast(names)

    def holds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, wanted = np.zeros(len(asked.value), np.int64), pa.array(asked.value, pa.binary())
        for batch in batches:
            for row in range(batch.num_rows):
                at = pc.index_in(batch["terms"][row].values, wanted).to_numpy(zero_copy_only=False)
                hit = ~np.isnan(at) if at.dtype.kind == "f" else np.ones(len(at), bool)
                ends = batch["run_at"][row].values.to_numpy()[batch["term_at"][row].values.to_numpy()]
                totals[at[hit].astype(np.int64)] += np.diff(ends)[hit]
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], names=["term", "df"])

    held = (
        strata.select("terms", "term_at", "run_at").mapInArrow(holds, "term long, df long")
        .groupBy("term").agg(F.sum("df").alias("df")).collect()  # one row for each term of the block at most
    )
    weight = {names[r["term"]]: math.floor(1000 * math.log((2 * documents + 2) / (2 * r["df"] + 1))) for r in held}
    known = sorted(weight)
    number = {t: i for i, t in enumerate(known)}
    weights = np.zeros((len(block), len(known)), np.int64)
    for i, (_, counts) in enumerate(block):
        for t, n in counts.items():
            if t in number:
                weights[i, number[t]] = n * weight[t]
    # an impact is below 10**6; sums of products below 2**53 are exact in doubles
    if weights.sum(axis=1).max(initial=0) < 1 << 33:
        weights = weights.astype(np.float64)
    shared = spark.sparkContext.broadcast((known, weights, np.array([item for item, _ in block], np.int64)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights, items = shared.value
        wanted, found = pa.array(known, pa.binary()), _Found(len(items), k)
        for batch in (b.slice(at, 64) for b in batches for at in range(0, b.num_rows, 64)):
            strata = []
            for row in range(batch.num_rows):
                get = lambda name: batch[name][row].values.to_numpy()  # noqa: E731, B023
                at = pc.index_in(batch["terms"][row].values, wanted)
                local = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                if not len(local):
                    continue
                terms = pc.drop_null(at).to_numpy().astype(np.int64)
                m, term_at, tf, run_at = batch["m"][row].as_py(), get("term_at"), get("run_tf").astype(np.int64), get("run_at")
                kinds, of = np.unique(tf, return_inverse=True)
                impact = ((1_000_000_000 * kinds) // (1000 * kinds + 12 * m))[of]  # once for each frequency
                bound = (weights[:, terms] @ impact[term_at[local]].astype(weights.dtype)).astype(np.int64)
                runs = _ranges(term_at[local], term_at[local + 1])
                sizes = run_at[runs + 1] - run_at[runs]
                term = np.repeat(np.repeat(np.arange(len(local)), term_at[local + 1] - term_at[local]), sizes)
                ids = batch["ids"][row].values.fill_null(_LAST).to_numpy()
                strata.append((bound, terms, term, np.repeat(impact[runs], sizes),
                               get("places")[_ranges(run_at[runs], run_at[runs + 1])], ids))
            _visit(strata, weights, found)
        if found.waiting:
            found.settle()
        ids = pa.array(found.id, mask=found.id == _LAST)
        yield pa.RecordBatch.from_arrays(
            [pa.array(items[found.item]), ids, pa.array(found.score)], names=["item", "doc_id", "score"]
        )

    return durable(strata.mapInArrow(score, "item long, doc_id long, score long"))
