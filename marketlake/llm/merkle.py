"""Document fingerprints: a Merkle tree over sections, paragraphs and their pieces; DataFrame functions only.

Sections end with blank lines, paragraphs are lines, and a paragraph's leaves are pieces of up to six words
that end with a sentence. A run of line ends stays with the last paragraph before it. A node is the SHA-256 of its children's hashes, so equal roots mean
equal texts, and where roots differ, equal branches need no look inside. The fingerprint is one string:

    root section:paragraph=leaf.size,leaf.size;paragraph=...|section:...

with the root's 64 hex digits, 12 for each section and paragraph and 8 for each leaf, whose ``size`` is in
code points. Likeness of two fingerprints is the share of their leaves in common, by size: twice the shared
over the sum of both, each distinct leaf counted once.

Defined results: a null or empty text is one empty leaf; equal texts have equal fingerprints; blank
lines and white space belong to the pieces or paragraphs around them, so any edit changes the root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import parallelism, range_bucket, range_borders

#: up to five words that end no sentence, then one that may
PIECE = r"\s*(?:\S*[^\s.!?]\s+){0,5}\S+\s*"
#: between sections nothing is taken out; between paragraphs the one line end
SECTION, PARAGRAPH = r"(?<=\n\n)(?![\n]|\z)", r"(?<!\n)\n(?!\n)"
LEAF_DIGITS, BRANCH_DIGITS = 8, 12


def _hash(text: Column) -> Column:
    return F.sha2(text, 256)


def _section(section: Column) -> Column:
    """(hash, text form) of a section."""
    def paragraph(line: Column) -> Column:
        pieces = F.regexp_extract_all(line, F.lit(PIECE), F.lit(0))
        return F.transform(
            F.when(F.size(pieces) > 0, pieces).otherwise(F.array(line)),
            lambda piece: F.struct(_hash(piece).alias("hash"), F.length(piece).alias("size")),
        )

    def branch(leaves: Column) -> Column:
        short = F.transform(
            leaves, lambda x: F.concat(F.substring(x["hash"], 1, LEAF_DIGITS), F.lit("."), x["size"].cast("string"))
        )
        return F.struct(
            _hash(F.array_join(F.transform(leaves, lambda x: x["hash"]), "")).alias("hash"),
            F.array_join(short, ",").alias("form"),
        )

    # each step stands alone, since an expression used twice inside a lambda is computed twice
    leaves = F.transform(F.split(section, PARAGRAPH), paragraph)
    branches = F.transform(leaves, branch)
    return F.transform(
        F.array(branches),
        lambda b: F.struct(
            _hash(F.array_join(F.transform(b, lambda x: x["hash"]), "")).alias("hash"),
            F.array_join(
                F.transform(b, lambda x: F.concat(F.substring(x["hash"], 1, BRANCH_DIGITS), F.lit("="), x["form"])), ";"
            ).alias("form"),
        ),
    )[0]


def fingerprint(text: Column) -> Column:
    sections = F.transform(F.split(F.coalesce(text, F.lit("")), SECTION), _section)
    made = F.transform(
        F.array(sections),
        lambda s: F.concat(
            _hash(F.array_join(F.transform(s, lambda x: x["hash"]), "")), F.lit(" "),
            F.array_join(
                F.transform(s, lambda x: F.concat(F.substring(x["hash"], 1, BRANCH_DIGITS), F.lit(":"), x["form"])), "|"
            ),
        ),
    )
    return made[0]


def leaves(fingerprint: Column) -> Column:
    """The distinct leaves, ``hash.size`` each."""
    return F.array_distinct(F.regexp_extract_all(fingerprint, F.lit(r"[0-9a-f]{8}\.\d+"), F.lit(0)))


def _weight(found: Column) -> Column:
    return F.aggregate(
        found, F.lit(0).cast("long"), lambda n, x: n + F.substr(x, F.lit(LEAF_DIGITS + 2)).cast("long")
    )


def likeness(left: Column, right: Column) -> Column:
    """0 to 1 from two fingerprints alone."""
    sides = F.array(F.struct(leaves(left).alias("a"), leaves(right).alias("b")))
    part = F.transform(
        sides,
        lambda s: F.struct(
            _weight(F.array_intersect(s["a"], s["b"])).alias("both"),
            (_weight(s["a"]) + _weight(s["b"])).alias("sum"),
        ),
    )[0]
    same_root = F.substring(left, 1, 64) == F.substring(right, 1, 64)
    return F.when(same_root, 1.0).otherwise(
        F.transform(F.array(part), lambda p: F.when(p["sum"] > 0, 2 * p["both"] / p["sum"]).otherwise(0.0))[0]
    )


def differing_branches(left: Column, right: Column) -> Column:
    """Where ``right`` was edited: (section, paragraph) numbers, from 0, of the paragraphs of ``right``
    whose branch is not at the same place in ``left``. Sections with equal hashes are not looked into."""
    split = lambda f: F.split(F.substr(f, F.lit(66)), r"\|")
    pairs = F.arrays_zip(split(left).alias("l"), split(right).alias("r"))

    def inside(pair: Column, section: Column) -> Column:
        old, new = (F.split(F.substr(F.coalesce(x, F.lit("")), F.lit(BRANCH_DIGITS + 2)), ";") for x in (pair["l"], pair["r"]))
        numbered = F.transform(new, lambda x, k: F.struct(section.alias("section"), k.alias("paragraph"), x.alias("x")))
        changed = F.filter(numbered, lambda n: ~F.coalesce(F.get(old, n["paragraph"]) == n["x"], F.lit(False)))
        return F.transform(changed, lambda n: F.struct(n["section"], n["paragraph"]))

    none = F.array().cast("array<struct<section:int,paragraph:int>>")
    found = F.transform(
        pairs,
        lambda p, k: F.when(
            p["r"].isNull() | F.coalesce(
                F.substring(p["l"], 1, BRANCH_DIGITS) == F.substring(p["r"], 1, BRANCH_DIGITS), F.lit(False)), none,
        ).otherwise(inside(p, k)),
    )
    return F.when(F.substring(left, 1, 64) == F.substring(right, 1, 64), none).otherwise(F.flatten(found))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, mark, next_text, next_mark) where ``mark`` is the fingerprint and ``next`` the document
    that follows in descending id, ties by text; after the last comes the first.

    Rows are dealt by ranges of the id, with borders at quantiles, and each range also gets the first
    row of the one that follows: one shuffle of the texts, whatever the ids.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    borders = range_borders(narrow, "doc_id", 4 * parallelism(spark))
    placed = narrow.withColumn("range", range_bucket(F.col("doc_id"), borders))
    # at most as many rows as there are ranges
    tops = placed.groupBy("range").agg(F.max("doc_id").alias("top")).orderBy(F.col("range").desc()).collect()
    follow = [(r["range"], tops[(k + 1) % len(tops)]["top"]) for k, r in enumerate(tops)]
    kind = narrow.schema["doc_id"].dataType.simpleString()
    wanted = F.broadcast(spark.createDataFrame(follow, f"range int, top {kind}"))
    heads = (
        narrow.join(wanted, F.col("doc_id").eqNullSafe(F.col("top")))
        .groupBy("range", "doc_id").agg(F.max("text").alias("text"))
        .select("doc_id", "text", "range", F.lit(1).alias("guest"))
    )
    rows = placed.withColumn("guest", F.lit(0)).unionByName(heads).withColumn("mark", fingerprint(F.col("text")))
    order = Window.partitionBy("range").orderBy(
        "guest", F.col("doc_id").desc_nulls_last(), F.col("text").desc()
    )
    return rows.select(
        "doc_id", "text", "mark", "guest",
        F.lead("text").over(order).alias("next_text"), F.lead("mark").over(order).alias("next_mark"),
    ).where(F.col("guest") == 0).drop("guest")
