"""A pipeline over ``documents`` in five stages: toxicity, exact copies, near copies, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and gets the rows its predecessor kept. All but the last return
the columns of the table they got; a document that the mix takes more than once comes that many times,
and one that it does not take is gone. The last returns a row for each of these with its token ids.

Defined results: null and empty texts hold no toxic word, null counts as empty for exact copies, of which the row with
the longest text and then the smallest id stays; texts without words have no near copy and count for nothing in the mix. The
near-duplicate and mixing stages decide row by row, also for repeated ids and rows without one. Empty tables
stay empty, very long texts are read whole, and columns of any name are handed on.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.bpe import encode_documents
from marketlake.llm.common import shared_checkpoints
from marketlake.llm.exact import drop_exact_copies
from marketlake.llm.mixing import drop_unmixed
from marketlake.llm.near import drop_near_copies
from marketlake.llm.queries import table, word_vocabulary
from marketlake.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_unmixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, word_vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("encoding", encoding),
]

#: neither a trained classifier nor a byte-pair encoding can be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    shared_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
