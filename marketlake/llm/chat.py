"""Chat formatting with typed content parts; DataFrame functions only.

A turn is a list of parts (kind, body, ref, tokens). A visitor, one expression for each kind, flattens
them in order: text is escaped, and image, audio and document parts become placeholders whose reference
and expanded token count go to the list of attachments. The template writes

    ### role ###\n<text>\n</turn>\n

for each turn. Control strings inside roles and texts cannot be met: each back slash, ``#`` and ``<`` there
gets a back slash before it, so a ``#`` after a blank or a ``<`` after a line end is always the template's,
and taking these back slashes away gives the text back whole. The loss mask is a list of (start, length) in code points over the formatted text: all
assistant texts, in order, without markers.

Turns are formatted row by row; only then are the rows of a conversation gathered, in turn order, ties by
role and text. A conversation is one training example, so its rows meet in one row of the result.

Defined results: null or empty text is empty; a null role is an empty name; a conversation of no assistant
has no loss; repeated rows are turns of their own; each row without a conversation id,
repeated ones too, is a conversation of its own; long conversations cost time in proportion to their turns; an empty table gives none. Parts of an unknown kind become a placeholder that names the kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, AFTER_ROLE, CLOSE = "### ", " ###\n", "\n</turn>\n"
LEARNED_ROLE = "assistant"
#: tokens that an attachment stands for when its part does not say
EXPANDED = {"image": 256, "audio": 128, "document": 512}

PART = "struct<kind:string,body:string,ref:string,tokens:int>"


def escaped(text: Column) -> Column:
    for mark in ("\\", "#", "<"):  # the back slash first: those added later stay single
        text = F.replace(text, F.lit(mark), F.lit("\\" + mark))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\#<])", "$1")


def visited(part: Column) -> Column:
    """What a part looks like in the text."""
    kind = F.coalesce(part["kind"], F.lit("unknown"))
    return F.when(kind == "text", escaped(F.coalesce(part["body"], F.lit("")))).otherwise(
        F.concat(F.lit("<|"), escaped(kind), F.lit(":"), escaped(F.coalesce(part["ref"], F.lit(""))), F.lit("|>"))
    )


def attached(part: Column) -> Column:
    usual = F.lit(0)
    for kind, tokens in EXPANDED.items():
        usual = F.when(part["kind"] == kind, F.lit(tokens)).otherwise(usual)
    return F.struct(
        part["kind"].alias("kind"), part["ref"].alias("ref"),
        F.coalesce(part["tokens"], usual).alias("tokens"),
    )


def text_part(text: Column) -> Column:
    """A turn of plain text as its only part."""
    none = F.lit(None)
    return F.array(
        F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("body"),
                 none.cast("string").alias("ref"), none.cast("int").alias("tokens"))
    )


def format_conversations(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts"
) -> DataFrame:
    """(conv_id, n_turns, formatted, loss_mask, attachments, expanded_tokens), one row for each conversation.
    ``parts_col`` is an array of ``PART``."""
    parts = F.coalesce(F.col(parts_col), F.lit(None).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    role = F.coalesce(F.col(role_col), F.lit(""))
    body = F.array_join(F.transform(parts, visited), "")
    others = F.filter(parts, lambda p: F.coalesce(p["kind"], F.lit("unknown")) != "text")
    lead = F.concat(F.lit(OPEN), escaped(role), F.lit(AFTER_ROLE))
    rows = turns.select(
        F.col(id_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"), role.alias("role"), lead.alias("lead"), body.alias("body"),
            F.transform(others, attached).alias("attached"),
        ).alias("made"),
    )
    # a running start for each turn, so that the mask needs no search in the text
    length = F.length("made.lead") + F.length("made.body") + F.lit(len(CLOSE))
    earlier = Window.partitionBy("conv_id").orderBy("made").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(length).over(earlier), F.lit(0)).cast("long")
    turn = F.struct("start", "made.role", "made.lead", "made.body", "made.attached")
    gathered = (
        rows.where(F.col("conv_id").isNotNull())
        .withColumn("start", start)
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(turn)).alias("made"))
        .unionByName(  # a row without an id meets no other
            rows.where(F.col("conv_id").isNull())
            .withColumn("start", F.lit(0).cast("long"))
            .select("conv_id", F.array(turn).alias("made"))
        )
    )
    mask = F.transform(
        F.filter("made", lambda t: t["role"] == LEARNED_ROLE),
        lambda t: F.struct(
            (t["start"] + F.length(t["lead"])).alias("start"), F.length(t["body"]).cast("long").alias("length")
        ),
    )
    pieces = F.transform("made", lambda t: F.concat(t["lead"], t["body"], F.lit(CLOSE)))
    attachments = F.flatten(F.transform("made", lambda t: t["attached"]))
    return gathered.select(
        "conv_id",
        F.size("made").cast("long").alias("n_turns"),
        F.array_join(pieces, "").alias("formatted"),
        mask.alias("loss_mask"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns``, an array of (role, text), and ``loss_text``, taken from the formatted
    text and the mask alone."""
    bodies = F.filter(F.split("formatted", CLOSE), lambda t: t != "")
    turns = F.transform(
        bodies,
        lambda t: F.struct(
            unescaped(F.substr(F.substring_index(t, AFTER_ROLE, 1), F.lit(len(OPEN) + 1))).alias("role"),
            unescaped(F.substr(t, F.instr(t, AFTER_ROLE) + F.lit(len(AFTER_ROLE)))).alias("text"),
        ),
    )
    learned = F.transform(
        "loss_mask",
        lambda s: unescaped(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )
    return formatted.withColumn("turns", turns).withColumn("loss_text", F.array_join(learned, ""))
