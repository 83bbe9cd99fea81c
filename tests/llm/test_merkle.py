import hashlib

from pyspark.sql import functions as F

from marketlake.llm.merkle import differing_branches, fingerprint, likeness, with_next


def marks(spark, *texts):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, text string")
    return [r.m for r in rows.select("k", fingerprint(F.col("text")).alias("m")).orderBy("k").collect()]


def compare(spark, left, right):
    a, b = marks(spark, left, right)
    row = spark.range(1).select(F.lit(a).alias("a"), F.lit(b).alias("b")).select(
        likeness(F.col("a"), F.col("b")).alias("near"), differing_branches(F.col("a"), F.col("b")).alias("at")
    ).first()
    return row.near, [tuple(x) for x in row["at"]]


def test_equal_roots_mean_equal_texts(spark):
    texts = ["", " ", "\n", "a", "a\n", "a\n\n", "a\n\n\n", "a b", "a  b", "A b", " a", None]
    got = marks(spark, *texts)
    assert got[0] == got[-1]
    roots = [m[:64] for m in got[:-1]]
    # line ends beyond a blank line are the one thing that a separator holds
    assert len(set(roots)) >= len(roots) - 1


def test_blank_lines_change_the_root(spark):
    texts = ["", "\n", "\n\n", "\n\n\n", "a", "a\n", "a\n\n", "a\n\n\n", "a\nb", "a\n\nb", "a\n\n\nb", "a\n\n\n\nb", "ab",
             "\na", "\n\na", "\n\n\na", "a\n\nb\n", "a\n\nb\n\n", "a\n\n\nb\n\n", "a\n \nb", "a\n\n b", "a \n\nb"]
    assert len({m[:64] for m in marks(spark, *texts)}) == len(texts)
    near, at = compare(spark, "s p\na\n\nb c d", "s p\na\n\n\nb c d")
    assert at == [(0, 1)] and 0 < near < 1
    assert compare(spark, "a b\n\n", "a b\n\n\n")[1] == [(0, 0)]
    # a paragraph put after a blank line is in the second section
    assert compare(spark, "a b\n\nc d", "a b\n\nc e")[1] == [(1, 0)]


def test_branches_locate_an_edit(spark):
    words = "one two three four five six seven eight nine ten. "
    text = "\n\n".join("\n".join(f"s{s} p{p} " + words for p in range(3)) for s in range(4))
    assert compare(spark, text, text) == (1.0, [])
    near, at = compare(spark, text, text.replace("s2 p1 one", "s2 p1 other"))
    assert at == [(2, 1)] and 0.9 < near < 1
    assert compare(spark, text, "quite another text")[0] == 0.0


def test_next_document_goes_round(spark, odd, none):
    rows = [(k * 7 % 101, f"text {k}") for k in range(101)]
    got = with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    assert len(got) == 101
    for r in got:
        assert r.next_text == texts[r.doc_id - 1 if r.doc_id else 100]
        assert r.mark[:64] == marks(spark, r.text)[0][:64] if r.doc_id < 2 else True
    assert with_next(none).count() == 0
    odd_rows = with_next(odd).collect()
    assert len(odd_rows) == odd.count() and all(r.next_text is not None for r in odd_rows)
    alone = with_next(spark.createDataFrame([(4, "x")], "doc_id long, text string")).first()
    assert alone.next_text == "x"


def test_query_edits_every_text(spark):
    from marketlake.llm.queries import op3_merkle, table

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    order = sorted(docs, reverse=True)
    got = {r.doc_id: r for r in op3_merkle(spark, sf).collect()}
    assert set(got) == set(docs)
    for k, i in enumerate(order):
        text, following = docs[i], docs[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].n_chars == len(text)
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
    assert len({r.fingerprint for r in got.values()}) == len(set(docs.values()))
