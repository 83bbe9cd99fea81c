"""Substring deduplication of passages: MinHash banding of paragraphs, and equal runs of words anywhere.

Paragraphs are lines. Those of ``MIN_WORDS`` words or more are signed; ten bands of three minima meet pairs
at a similarity of 0.8 with a probability above 0.999, and what meets is verified by the exact Jaccard
similarity of word 5-shingles. Components of verified links, equal paragraphs included, that reach over
several documents are passages: the document with the smallest id keeps its paragraphs, all others
lose theirs.

Words that stand in a run of ``RUN_WORDS`` or more words which a document with a smaller id holds too go as
well, wherever the run begins and ends: inside a paragraph, across line ends, over short lines. Every
window of ``RUN_WORDS`` words is marked by the least hash of its runs of ``MARK_WORDS`` words, so equal
windows have equal marks and none is missed. Documents that agree on all the words of a mark's windows are
settled at once; what is left, one document for each such frame, window by window. Words are told apart by what is not blank, A-Z
lower-cased; a line that loses all its words goes whole.

Shorter lines and runs stay: they are headings, licence lines and the like, which clean documents share too.

Defined results: null and empty texts have one empty paragraph and lose nothing; rows of one id
are one document; repeats inside one document stay; rows without an id neither keep nor lose; an empty
table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import durable, emptied, shared_place, stored
from marketlake.llm.near import BROADCAST_IDS, Banding, near_components
from marketlake.llm.shingles import WordHashes, mixed, portions

MIN_WORDS = 20
PERCENT = 80
RUN_WORDS, MARK_WORDS = 50, 16
PARAGRAPHS = Banding(minima=64, bands=10, rows=3)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _words(line: str):
    """Number of words of a line. Where single blanks part them, they are counted by what is left
    without blanks, at a tenth of the cost of a pattern."""
    col = F.col(line)
    odd = col.startswith(" ") | col.endswith(" ")
    for mark in ("  ", "\t", "\x0b", "\f", "\r"):
        odd = odd | F.contains(col, F.lit(mark))
    plain = F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit(""))) + 1
    return F.when(odd, F.regexp_count(col, F.lit(r"[^\x20\x09-\x0D]+"))).otherwise(plain)


def _paragraphs(text_col: str):
    return F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")


def _lines(docs: DataFrame, id_col: str, text_col: str, min_words: int, percent: int) -> DataFrame:
    """(doc_id, digest, position, component_id, first_doc_id) of the paragraphs that other documents share."""
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("owner"), _digest(text_col).alias("digest"), F.col(text_col).alias("text")
    )

    def split(rows: DataFrame) -> DataFrame:
        return (
            rows.select("owner", "digest", F.posexplode(_paragraphs("text")).alias("position", "line"))
            .where((F.length("line") >= 2 * min_words - 1) & (_words("line") >= min_words))
        )

    lines = split(rows)
    place = ["owner", "digest", "position"]

    def texts_of(places: DataFrame) -> DataFrame:
        found = lines.join(places, place)
        if places.count() <= BROADCAST_IDS:
            # only rows that hold a wanted line are split again
            homes = F.broadcast(places.select("owner", "digest").distinct())
            found = split(rows.join(homes, ["owner", "digest"])).join(F.broadcast(places), place)
        return found.select(F.col("node").alias("row"), "line")

    spark, signed = docs.sparkSession, shared_place(docs.sparkSession, "signed")
    # a line is told from others by its place, and equal lines are found by their sets' 128-bit digests
    found = durable(
        near_components(
            lines.withColumn("row", F.monotonically_increasing_id()), "row", "line", percent, how=PARAGRAPHS,
            carry=tuple(place), texts_of=texts_of, place=signed,
        )
        .select("component_id", *place)
    )
    emptied(spark, signed)
    shared = durable(
        found.groupBy("component_id").agg(F.min("owner").alias("first_doc_id"), F.max("owner").alias("last"))
        .where(F.col("first_doc_id") != F.col("last")).drop("last")
    )
    return found.join(shared, "component_id").select(
        F.col("owner").alias("doc_id"), "digest", "position", "component_id", "first_doc_id"
    )


def passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, position, component_id, first_doc_id), one row for each paragraph that other documents
    share; ``first_doc_id`` is the document that keeps the passage."""
    return _lines(docs, id_col, text_col, min_words, percent).drop("digest")


def _digest(text_col: str):
    """Tells rows of one id apart that hold other texts."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _runs(words: np.ndarray, *widths: int) -> list[np.ndarray]:
    """Hash of each run of so many words, for each of ``widths``, by runs of powers of two."""
    out: list[np.ndarray | None] = [None] * len(widths)
    power, size = words, 1
    while True:
        for k, width in enumerate(widths):
            if width & size:
                have = width & (size - 1)
                part = power[have : have + len(words) - width + 1]
                out[k] = part if out[k] is None else mixed(out[k]) + part
        if 2 * size > max(widths):
            return [mixed(x) for x in out]
        power, size = mixed(power[:-size]) + power[size:], 2 * size


def _marked(words: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, mark, frame, first, last) of texts laid end to end: a mark, the hash of all words of its
    windows and of its place in them, and the first and last of those windows."""
    counts = np.maximum(np.diff(cuts) - RUN_WORDS + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    if not len(text):
        return text, words[:0], words[:0], text, text
    grams, windows = _runs(words, MARK_WORDS, RUN_WORDS)
    wide = RUN_WORDS - MARK_WORDS + 1
    # windows inside a text, by their place in all; the least of each moves on only
    inside = np.arange(len(text)) + np.repeat(cuts[:-1] - np.cumsum(counts) + counts, counts)
    at = np.lib.stride_tricks.sliding_window_view(grams, wide).argmin(axis=1)[inside] + inside
    new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    text, picked = text[new], at[new]
    first, last = inside[new], inside[np.append(new[1:], len(at)) - 1]
    # the first and the last window overlap, so the two hold all words between
    place = ((picked - first) * wide + last - first).astype(np.uint64)
    frames = mixed(mixed(windows[first]) + windows[last]) + place
    return text, grams[picked], frames, first - cuts[text], last - cuts[text]


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, start, end, first_doc_id): words ``start`` to before ``end`` of a text are also in the
    document ``first_doc_id``, which has a smaller id: the smallest of those that agree on all words of a
    mark's windows, or, window by window, of all that hold the window. The rows overlap."""
    texts = docs.where(F.col(id_col).isNotNull() & (F.length(text_col) >= 2 * RUN_WORDS - 1)).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), _digest(text_col).alias("digest")
    )
    kind = texts.schema["doc_id"].dataType.simpleString()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in (b.slice(*part) for b in batches for part in portions(b["text"])):
            row, marks, frames, first, last = _marked(*hashes.of_all(batch["text"]))
            if len(row):
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(row), batch["digest"].take(row), pa.array(marks.view(np.int64)),
                     pa.array(frames.view(np.int64)), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                    names=["doc_id", "digest", "mark", "frame", "first", "last"],
                )

    # what later steps no longer read goes at once
    spark = docs.sparkSession
    at = {name: shared_place(spark, name) for name in ("marks", "hits")}
    marks = stored(
        texts.mapInArrow(mark, f"doc_id {kind}, digest long, mark long, frame long, first int, last int"), at["marks"]
    )
    shared = durable(
        marks.groupBy("mark").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("top"))
        .where(F.col("low") != F.col("top")).select("mark")
    )
    hits = stored(marks.join(shared, "mark"), at["hits"])
    emptied(spark, at["marks"])
    frames = durable(hits.groupBy("mark", "frame").agg(F.min("doc_id").alias("first_doc_id")))
    framed = stored(hits.join(frames, ["mark", "frame"]).drop("frame"))
    emptied(spark, at["hits"])
    # a frame says all words of its windows: a smaller id that holds it holds them all
    whole = framed.where(F.col("doc_id") != F.col("first_doc_id")).select(
        "doc_id", "digest", F.col("first").alias("start"), (F.col("last") + RUN_WORDS).alias("end"), "first_doc_id"
    )
    # between the frames of a mark, the windows of the documents that hold each first decide
    several = (
        frames.groupBy("mark").agg(F.min("first_doc_id").alias("low"), F.max("first_doc_id").alias("top"))
        .where(F.col("low") != F.col("top")).select("mark")
    )
    open_ = durable(
        framed.where(F.col("doc_id") == F.col("first_doc_id")).join(several, "mark").groupBy("doc_id", "digest")
        .agg(F.collect_set(F.struct("mark", "first", "last")).alias("marks"), F.sum(F.lit(1)).alias("held"))
    )

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in (b.slice(*part) for b in batches for part in portions(b["text"])):
            words, cuts = hashes.of_all(batch["text"])
            windows = _runs(words, RUN_WORDS)[0].view(np.int64)
            held = batch["marks"].flatten()
            mark, first, last = (held.field(c).to_numpy() for c in ("mark", "first", "last"))
            sizes = last - first + 1
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch["marks"]).to_numpy())
            row = np.repeat(row, sizes)
            start = np.arange(len(row)) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)
            same = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(same), batch["digest"].take(same), pa.array(np.repeat(mark, sizes)),
                 pa.array(windows[start + cuts[row]]), pa.array(start.astype(np.int32))],
                names=["doc_id", "digest", "mark", "window", "start"],
            )

    # 16 bytes a mark
    wanted = F.broadcast(open_) if (open_.agg(F.sum("held")).first()[0] or 0) <= BROADCAST_IDS else open_
    wanted = wanted.drop("held")
    windows = stored(
        texts.join(wanted, ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])
        .mapInArrow(spell, f"doc_id {kind}, digest long, mark long, window long, start int")
    )
    least = durable(
        windows.groupBy("mark", "window").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("top"))
        .where(F.col("first_doc_id") != F.col("top")).drop("top")
    )
    single = windows.join(least, ["mark", "window"]).where(F.col("doc_id") != F.col("first_doc_id")).select(
        "doc_id", "digest", "start", (F.col("start") + RUN_WORDS).alias("end"), "first_doc_id"
    )
    return whole.unionByName(single)


def _without(text: str, removed: set[int], runs: list[tuple[int, int]]) -> str:
    """``text`` without the lines of ``removed`` and without the words of the sorted ``runs``."""
    out, word, at = [], 0, 0
    for k, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
        start, word = word, word + len(line.split())
        if k in removed:
            continue
        while at < len(runs) and runs[at][1] <= start:
            at += 1
        if start == word or at == len(runs) or runs[at][0] >= word:
            out.append(line)
            continue
        if runs[at][0] <= start and word <= runs[at][1]:
            continue
        places = [m.span() for m in _WORD.finditer(line)]
        stays = [True] * len(places)
        near = at
        while near < len(runs) and runs[near][0] < word:
            low, high = max(runs[near][0], start) - start, min(runs[near][1], word) - start
            stays[low:high] = [False] * (high - low)
            near += 1
        if any(stays):
            # a word that goes takes the blanks before it, at the start of a line those after it
            kept, end = [], None
            for place, stay in enumerate(stays):
                if stay:
                    before = places[place - 1][1] if place else 0
                    kept.append(line[places[place][0] if end is None and place else before : places[place][1]])
                    end = place
            tail = line[places[-1][1] :] if stays[-1] else b""
            out.append(b"".join(kept) + tail)
    return b"\n".join(out).decode("utf-8", "surrogatepass")


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
    percent: int = PERCENT, runs: bool = False,
) -> DataFrame:
    """(doc_id, n_paragraphs, shared, removed, first_doc_ids, runs, text), one row for each row of ``docs``:
    positions of the paragraphs that other documents share, of those removed, the documents that keep
    them or the runs, the runs of words removed (from, to before), and the text without both. Without
    ``runs`` whole paragraphs only are removed."""
    away = F.col("doc_id") != F.col("first_doc_id")
    run = "struct<start:int,end:int>"
    lines = _lines(docs, id_col, text_col, min_words, percent).select(
        "doc_id", "digest", "position", F.when(away, F.col("position")).alias("gone"),
        F.when(away, F.col("first_doc_id")).alias("keeper"), F.lit(None).cast(run).alias("run"),
    )
    if runs:
        nothing = F.lit(None).cast("int")
        lines = lines.unionByName(repeated_runs(docs, id_col, text_col).select(
            "doc_id", "digest", nothing.alias("position"), nothing.alias("gone"),
            F.col("first_doc_id").alias("keeper"), F.struct("start", "end").alias("run"),
        ))
    by_doc = lines.groupBy("doc_id", "digest").agg(
        *[F.sort_array(F.collect_set(c)).alias(to)
          for c, to in (("position", "shared"), ("gone", "removed"), ("keeper", "first_doc_ids"), ("run", "runs"))]
    )
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        _digest(text_col).alias("digest"),
    ).join(by_doc, ["doc_id", "digest"], "left")
    none = F.array().cast("array<int>")
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    made = rows.select(
        "doc_id",
        F.size(_paragraphs("text")).cast("long").alias("n_paragraphs"),
        F.coalesce("shared", none).alias("shared"),
        F.coalesce("removed", none).alias("removed"),
        F.coalesce("first_doc_ids", F.array().cast(f"array<{kind}>")).alias("first_doc_ids"),
        F.coalesce("runs", F.array().cast(f"array<{run}>")).alias("runs"),
        "text",
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            touched = pc.or_(*[pc.greater(pc.list_value_length(batch[c]), 0) for c in ("removed", "runs")])
            rows = np.flatnonzero(touched.to_numpy(zero_copy_only=False))
            texts, spans = [], [[] for _ in range(batch.num_rows)]
            upto = np.cumsum(pc.list_value_length(batch["runs"]).to_numpy()).tolist()
            flat = batch["runs"].flatten()
            pairs = list(zip(flat.field("start").to_pylist(), flat.field("end").to_pylist()))
            for row in rows.tolist():
                found = _merged(pairs[upto[row - 1] if row else 0 : upto[row]])
                texts.append(_without(batch["text"][row].as_py(), set(batch["removed"][row].as_py()), found))
                spans[row] = [{"start": a, "end": b} for a, b in found]
            columns = [batch[c] for c in batch.schema.names[:-2]]
            text = pc.replace_with_mask(batch["text"], touched, pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(spans, batch.schema.field("runs").type), text], names=batch.schema.names
            )

    return made.mapInArrow(cut, made.schema)
