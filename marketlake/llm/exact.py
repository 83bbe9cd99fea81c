"""Exact deduplication with a split for heavy hitters; DataFrame functions only.

A Misra-Gries summary (``freqItems``) of the digests finds every digest that makes up more than
``support`` of the rows. At most ``2 / support`` candidates exist; exact counts verify them, and the
winners of those that hold are joined map-side by broadcast, so no row of a huge group is shuffled.
All other groups have at most ``support`` of the rows and take an ordinary shuffle on the digest.

Defined results: a null text counts as empty; empty texts are equal to each other; of equal texts the
one with the most code points wins, then the smallest id, null ids last; a row that repeats whole
carries the flag of its twin, and ``drop_exact_copies`` leaves one of them; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import durable, without_blanks

SUPPORT = 0.001


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.length(text).cast("long").alias("n_chars"),
        F.sha2(without_blanks(text), 256).alias("text_sha256"),
    )


def frequent(hashed: DataFrame, support: float) -> DataFrame:
    """(text_sha256, longest, keep_id, group_size) of the digests in more than ``support`` of the rows:
    Misra-Gries candidates, verified by exact counts. Never more than ``1 / support`` rows."""
    candidates = hashed.stat.freqItems(["text_sha256"], support).select(
        F.explode(F.col("text_sha256_freqItems")).alias("text_sha256")
    )
    counted = (
        hashed.join(F.broadcast(candidates), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max("n_chars").alias("longest"))
    )
    verified = durable(counted.where(F.col("group_size") > support * hashed.count()))
    first = (
        hashed.join(F.broadcast(verified), "text_sha256")
        .where(F.col("n_chars") == F.col("longest"))
        .groupBy("text_sha256", "longest", "group_size")
        .agg(F.min("doc_id").alias("keep_id"))
    )
    return durable(first)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of ``docs``."""
    hashed = durable(digests(docs, id_col, text_col))
    heavy = frequent(hashed, support)
    marked = hashed.join(F.broadcast(heavy), "text_sha256", "left")
    by_text = Window.partitionBy("text_sha256")
    best_first = by_text.orderBy(F.col("n_chars").desc(), F.col("doc_id").asc_nulls_last())
    ordinary = marked.where(F.col("group_size").isNull()).select(
        "doc_id",
        F.first("doc_id").over(best_first).alias("keep_id"),
        F.count(F.lit(1)).over(by_text).alias("group_size"),
        "text_sha256",
    )
    massive = marked.where(F.col("group_size").isNotNull()).select(
        "doc_id", "keep_id", "group_size", "text_sha256"
    )
    return ordinary.unionByName(massive).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def drop_exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns and one row for each text."""
    heavy = frequent(durable(digests(docs, id_col, text_col)), support)
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    text = F.coalesce(F.col(text_col), F.lit(""))
    tagged = docs.select(
        row,
        F.col(id_col).alias("doc_id"),
        F.length(text).cast("long").alias("n_chars"),
        F.sha2(without_blanks(text), 256).alias("text_sha256"),
    )
    candidates = tagged.join(F.broadcast(heavy), "text_sha256", "left").where(
        F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))
    )
    best = Window.partitionBy("text_sha256").orderBy(
        F.col("n_chars").desc(), F.col("doc_id").asc_nulls_last()
    )
    first = candidates.select("row", F.row_number().over(best).alias("place"))
    return first.where(F.col("place") == 1).select("row.*")
