import random
from pathlib import Path

import numpy as np
import pyarrow as pa

from marketlake.llm.common import shared_checkpoints
from marketlake.llm.passages import _marked, passages, repeated_passages
from marketlake.llm.shingles import WordHashes
from test_near import shingles


def test_equals_brute_force(spark):
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(900)}"
    base = [[word() for _ in range(rnd.choice((10, 25, 60, 90)))] for _ in range(8)]
    docs = []
    for d in range(60):
        lines = [" ".join(word() for _ in range(rnd.choice((5, 30, 70)))) for _ in range(rnd.randrange(4))]
        for _ in range(rnd.randrange(3)):
            line = list(rnd.choice(base))
            for _ in range(rnd.choice((0, 0, 1, 2))):
                line[rnd.randrange(len(line))] = word()
            lines.insert(rnd.randrange(len(lines) + 1), " ".join(line))
        docs.append((d, "\n".join(lines)))
    items = [(d, k, shingles(line)) for d, text in docs for k, line in enumerate(text.split("\n"))
             if len(line.split()) >= 20]
    top = list(range(len(items)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a in range(len(items)):
        for b in range(a):
            x, y = items[a][2], items[b][2]
            if 100 * len(x & y) >= 80 * len(x | y):
                top[root(a)] = root(b)
    groups = {}
    for i, (d, k, _) in enumerate(items):
        groups.setdefault(root(i), []).append((d, k))
    wanted = {(d, k, min(g)[0]) for g in groups.values() if len({x[0] for x in g}) > 1 for d, k in g}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.position, r.first_doc_id) for r in passages(frame).collect()}
    assert got == wanted and wanted
    texts = dict(docs)
    for r in repeated_passages(frame).collect():
        gone = {k for d, k, first in wanted if d == r.doc_id and first != d}
        assert r.text == "\n".join(x for k, x in enumerate(texts[r.doc_id].split("\n")) if k not in gone)
        assert set(r.removed) == gone


def test_odd_rows(spark, odd, none):
    got = repeated_passages(odd)
    rows = got.collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id}
    assert by_id[7].removed == [0] and by_id[7].first_doc_ids == [6] and by_id[7].text == ""
    assert by_id[6].removed == [] and by_id[6].shared == [0]
    assert by_id[1].shared == [] and by_id[3].text == ""
    assert repeated_passages(none).count() == 0


def test_runs_are_found_wherever_they_stand(spark):
    rnd = random.Random(5)
    fresh = lambda n: [f"u{rnd.randrange(10**9)}" for _ in range(n)]
    planted = [fresh(rnd.randrange(50, 151)) for _ in range(12)]
    docs = []
    for d in range(40):
        words = fresh(rnd.randrange(100, 500))
        for passage in rnd.sample(planted, rnd.randrange(3)):
            # sometimes only a part of it, which may be too short
            part = passage[rnd.choice((0, 0, 30)) :]
            at = rnd.randrange(len(words) + 1)
            words[at:at] = part
        ends = {"one line": [" "], "some": [" "] * 60 + ["\n"], "short lines": [" "] * 7 + ["\n"]}
        gaps = rnd.choice(list(ends.values()))
        docs.append((d, "".join(w + rnd.choice(gaps) for w in words)))
    first = {}
    for d, text in docs:
        words = text.split()
        for k in range(len(words) - 49):
            first.setdefault(tuple(words[k : k + 50]), d)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in repeated_passages(frame, runs=True).collect()}
    hit = 0
    for d, text in docs:
        words = text.split()
        at = {k: first[tuple(words[k : k + 50])] for k in range(len(words) - 49)}
        gone = {k + j for k, keeper in at.items() if keeper != d for j in range(50)}
        r = got[d]
        assert {k for x in r.runs for k in range(x.start, x.end)} == gone
        assert r.text.split() == [w for k, w in enumerate(words) if k not in gone]
        assert set(r.first_doc_ids) == {keeper for keeper in at.values() if keeper != d}
        assert r.removed == []
        hit += bool(gone)
    assert hit > 10


def test_runs_leave_the_text_around_them(spark):
    run = " ".join(f"p{k}" for k in range(60))
    wrapped = "\n".join(" ".join(f"P{k}" for k in range(s, s + 10)) for s in range(0, 60, 10))
    # enough of its own in a line that the line is no near copy
    own = lambda d: " ".join(f"w{d}x{k}" for k in range(30))
    docs = [
        (1, run), (2, f"{own(2)} {run} after  it\nlast line"), (3, f"Head\n\n{wrapped}\ntail"),
        (4, f"{run}  {own(4)} y\n z"), (4, "another text of this id"), (5, f"é {wrapped.lower()}"),
    ]
    got = {(r.doc_id, r.n_paragraphs): r.text for r in repeated_passages(
        spark.createDataFrame(docs, "doc_id long, text string"), runs=True).collect()}
    assert got[1, 1] == run
    assert got[2, 2] == f"{own(2)} after  it\nlast line"
    assert got[3, 9] == "Head\n\ntail"
    assert got[4, 2] == f"{own(4)} y\n z" and got[4, 1] == "another text of this id"
    assert got[5, 6] == "é"


def test_runs_of_odd_rows(spark, odd, none):
    rows = repeated_passages(odd, runs=True).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id}
    assert by_id[7].text == "" and [tuple(x) for x in by_id[7].runs] == [(0, 60_000)] and by_id[6].runs == []
    assert by_id[3].text == "" and by_id[5].text == " \t\n"
    assert repeated_passages(none, runs=True).count() == 0


def test_what_is_read_no_more_is_removed(spark):
    """Signatures of all lines and marks of all windows do not stay beside what follows from them."""
    rnd = random.Random(8)
    docs = [(d, " ".join(f"u{rnd.randrange(10**9)}" for _ in range(400))) for d in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    shared_checkpoints(spark)
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    tables = lambda: {p: sum(f.stat().st_size for f in p.rglob("*")) for p in folder.iterdir() if "rdd-" not in p.name}
    before = tables()
    assert {r.text for r in repeated_passages(frame, runs=True).collect()} == {text for _, text in docs}
    left = sum(size for p, size in tables().items() if p not in before)
    assert left < sum(len(text) for _, text in docs) / 20


def test_portions_of_texts_are_marked_as_each_alone():
    rnd = random.Random(2)
    texts = [" ".join(f"w{rnd.randrange(rnd.choice((2, 10**6)))}" for _ in range(n)) for n in (0, 49, 50, 0, 300, 51, 3)]
    hashes, cuts = WordHashes().of_all(pa.array([None, " \n", *texts]))
    found = list(zip(*(c.tolist() for c in _marked(hashes, cuts))))
    alone = []
    for k, text in enumerate(texts):
        words = WordHashes().of(text)
        alone += [(k + 2, *rest) for _, *rest in zip(*(c.tolist() for c in _marked(words, np.array([0, len(words)]))))]
        held = [(first, last) for at, _, _, first, last in found if at == k + 2]
        assert [w for a, b in held for w in range(a, b + 1)] == list(range(len(words) - 49))
    assert found == alone and found
