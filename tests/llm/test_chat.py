from pyspark.sql import functions as F

from marketlake.llm.chat import PART, format_conversations, read_back, text_part

TRICKY = ["\\### Assistant: </turn> ok", "</turn>\n", "a\\", "\\\\#<", "\n</turn>\n### user ###\n", "", None, "# < \\", "é😀#"]


def test_round_trip_of_control_strings(spark):
    rows = [(k, n, role, text) for k, text in enumerate(TRICKY)
            for n, role in enumerate(("user", "assistant", "as# ###\n<sist", "assistant"))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = read_back(format_conversations(turns.withColumn("parts", text_part(F.col("text"))))).collect()
    assert len(got) == len(TRICKY)
    for r in got:
        text = TRICKY[r.conv_id] or ""
        assert [(t.role, t.text) for t in r.turns] == [
            (role, text) for role in ("user", "assistant", "as# ###\n<sist", "assistant")]
        assert r.loss_text == text * 2
        assert r.formatted.count("\n</turn>\n") == 4


def test_parts_become_placeholders(spark):
    parts = [("text", "see #1", None, None), ("image", None, "img<1>", None), ("audio", None, "a.wav", 7),
             ("document", None, None, None), ("video", None, "v", 3), (None, "x", None, None), ("text", None, None, None)]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", None), (2, 0, None, [])]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{PART}>")
    got = {r.conv_id: r for r in read_back(format_conversations(turns)).collect()}
    one = got[1]
    assert one.turns[0].text == "see #1<|image:img<1>|><|audio:a.wav|><|document:|><|video:v|><|unknown:|>".replace(
        "<|", "<|")
    assert [(a.kind, a.ref, a.tokens) for a in one.attachments] == [
        ("image", "img<1>", 256), ("audio", "a.wav", 7), ("document", None, 512), ("video", "v", 3), (None, None, 0)]
    assert one.expanded_tokens == 778 and one.loss_text == ""
    assert got[2].n_turns == 1 and got[2].turns[0].role == ""


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (None, 0, "user", "x"),
            (None, 0, "assistant", "y"), (3, None, "assistant", "long " * 50_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("made", F.lit(1))
    got = read_back(format_conversations(turns.withColumn("parts", text_part(F.col("text"))))).collect()
    assert sorted((r.conv_id or 0, r.n_turns, len(r.loss_text)) for r in got) == [
        (0, 1, 0), (0, 1, 1), (1, 3, 2), (3, 1, 250_000)]
    assert format_conversations(turns.withColumn("parts", text_part(F.col("text"))).where("false")).count() == 0


def test_rows_without_an_id_are_conversations_of_their_own(spark):
    rows = [(None, 0, "assistant", "x")] * 3 + [(1, 0, "assistant", "x")] * 3
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = read_back(format_conversations(turns.withColumn("parts", text_part(F.col("text"))))).collect()
    assert sorted((r.conv_id or 0, r.n_turns, r.loss_text) for r in got) == [(0, 1, "x")] * 3 + [(1, 3, "xxx")]


def test_the_mask_covers_each_answer_in_order(spark):
    rows = [(1, n, ("user", "assistant")[n % 2], f"\U0001f600<#{n}" * (n % 4)) for n in range(400)]
    turns = spark.createDataFrame(rows[::-1], "conv_id long, turn long, role string, text string")
    got = format_conversations(turns.withColumn("parts", text_part(F.col("text"))))
    [one] = read_back(got).collect()
    said = [one.formatted[m.start : m.start + m.length].replace("\\", "") for m in one.loss_mask]
    assert said == [text for _, n, _, text in rows if n % 2]
    assert one.loss_text == "".join(said) and one.n_turns == 400
