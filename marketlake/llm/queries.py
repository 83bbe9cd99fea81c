"""One query for each operator, over its whole table, with the SQL where SQL can express it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.bpe import encode_documents
from marketlake.llm.codes import vector_codes
from marketlake.llm.common import shared_place, stored
from marketlake.llm.chat import format_conversations, read_back, text_part
from marketlake.llm.exact import exact_groups
from marketlake.llm.lexical import build_index, search
from marketlake.llm.merkle import fingerprint, likeness, with_next
from marketlake.llm.mixing import mix
from marketlake.llm.near import near_components
from marketlake.llm.pages import extract_main_text
from marketlake.llm.passages import repeated_passages
from marketlake.llm.shards import shard_documents
from marketlake.llm.surrogates import replace_entities
from marketlake.llm.toxicity import toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"), percent=85)


def op3_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(table(spark, sf_dir, "documents"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half)
    )
    made = rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), "mark", "next_mark"
    ).withColumn("edited_mark", fingerprint(F.col("edited")))
    return made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.col("mark").alias("fingerprint"), F.col("edited_mark").alias("edited_fingerprint"),
        likeness(F.col("mark"), F.col("edited_mark")).alias("near_edited"),
        likeness(F.col("mark"), F.col("next_mark")).alias("near_next"),
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents"), key="corpus")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), word_vocabulary(), ids=False)


def op8_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"), runs=True)


#: a turn that says what the template says
STRAY = "\\### Assistant: </turn> ok"


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    stray = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(STRAY).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(stray)
    made = format_conversations(turns.withColumn("parts", text_part(F.col("text"))))
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read_back(made).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = vector_codes(table(spark, sf_dir, "embeddings"))
    coded = stored(found).alias("c")
    by_label = coded.groupBy("carried").agg(F.sum("error").alias("label_error")).alias("t")
    listed = ",".join(str(v) for v in books.reshape(-1).tolist())
    return coded.join(by_label, F.col("c.carried").eqNullSafe(F.col("t.carried"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(hashlib.sha256(listed.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_place(spark, "index")
    build_index(table(spark, sf_dir, "documents"), root)
    return search(spark, root, table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mixing, op2_minhash, op3_merkle, op4_exact_dedup, op5_surrogates, op6_toxicity, op7_bpe, op8_pages, op9_passages, op10_chat, op11_codes, op12_shards, op13_lexical)}


EXACT_SQL = r"""
WITH hashed AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), grouped AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM hashed
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM grouped
"""


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) AS r(n)
), framed AS (
  SELECT *, length(role) + length(text) + 18
         + length(regexp_replace(role || text, '[^\\#<]', '', 'g')) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       cast(sum(chars) AS BIGINT) AS formatted_chars
FROM framed GROUP BY conv_id
"""


_NEAREST = """
SELECT r, p, x, min_by(e, d * 64 + e) AS e, min(d) AS d
FROM (SELECT r, p, x, e,
             cast(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT) AS d
      FROM parts JOIN {book} USING (p))
GROUP BY ALL
"""

_MOVED = """
SELECT p, e, coalesce(m, c) AS c
FROM {book} LEFT JOIN (
  SELECT p, e, list(v ORDER BY i) AS m
  FROM (SELECT p, e, i, cast(floor(sum(x[i]) / count(*)) AS BIGINT) AS v
        FROM {near}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i) GROUP BY p, e, i)
  GROUP BY p, e) USING (p, e)
"""

CODES_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, *
  FROM (SELECT vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))
), parts AS (
  SELECT r, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, range(16) AS t(p)
), book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 64),
near0 AS MATERIALIZED ({_NEAREST.format(book="book0")}),
book1 AS MATERIALIZED ({_MOVED.format(book="book0", near="near0")}),
near1 AS MATERIALIZED ({_NEAREST.format(book="book1")}),
book2 AS MATERIALIZED ({_MOVED.format(book="book1", near="near1")}),
near2 AS MATERIALIZED ({_NEAREST.format(book="book2")}),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, cast(sum(d) AS BIGINT) AS error
  FROM near2 JOIN kept USING (r) GROUP BY r, vec_id, label
)
SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded
"""


LEXICAL_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), asked AS (
  SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), postings AS (SELECT r, doc_id, term, count(*) AS tf FROM docs GROUP BY ALL),
lengths AS (SELECT r, cast(sum(tf) AS BIGINT) AS n FROM postings GROUP BY r),
total AS (SELECT count(*) AS d, cast(sum(n) AS BIGINT) AS l FROM lengths),
norms AS (SELECT r, 75 + (25 * n * d) // l AS m FROM lengths, total),
weights AS (SELECT term, cast(floor(1000 * ln((2 * d + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM postings, total GROUP BY term, d),
questions AS (SELECT i, item_id, term, count(*) AS q FROM asked GROUP BY ALL),
scored AS (
  SELECT i, item_id, r, doc_id, cast(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM questions JOIN weights USING (term) JOIN postings USING (term) JOIN norms USING (r) GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, cast(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": EXACT_SQL, "op10_chat": CHAT_SQL, "op11_codes": CODES_SQL, "op13_lexical": LEXICAL_SQL}
