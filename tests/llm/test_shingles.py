import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from marketlake.llm import near, shingles
from marketlake.llm.shingles import WordHashes, shingle_set, shingle_sets

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def varied(seed, texts=60):
    rnd = random.Random(seed)
    signs = "aAbzZ09_\x00\x1c\x1f\x7f\x85\xa0é İ漢😀"
    word = lambda: "".join(rnd.choice(signs) for _ in range(rnd.choice((1, 2, 7, 8, 9, 15, 16, 17, 40))))
    some = [word() for _ in range(300)] + ["q" * n for n in (1, 8, 16, 248, 255, 256, 257, 264, 600)]
    some += ["q" * 599 + "r", "r" + "q" * 599, "\x00", "\x00" * 8, "\x00" * 9]
    blanks = [" ", "  ", "\t", "\n", "\x0b", "\x0c", "\r"]
    return [None, "", " \n", *[
        rnd.choice(["", *blanks]) + "".join(rnd.choice(some) + rnd.choice(blanks) for _ in range(rnd.randrange(40)))
        + rnd.choice(["", "end"]) for _ in range(texts)
    ]]


def test_hashes_tell_words_apart():
    texts = varied(1)
    hashes, cuts = WordHashes().of_all(pa.array([*texts, *["ab"] * 3]).slice(0, len(texts)))
    words = [WORD.findall((t or "").encode().lower()) for t in texts]
    assert np.diff(cuts).tolist() == [len(w) for w in words]
    flat = [w for found in words for w in found]
    pairs = set(zip(flat, hashes.tolist()))
    assert len(pairs) == len(set(flat)) == len(set(hashes.tolist())) > 200
    for text, first, end in zip(texts, cuts, cuts[1:]):
        assert WordHashes().of(text).tolist() == hashes[first:end].tolist()
    assert WordHashes().of_all(pa.array([], pa.string()))[1].tolist() == [0]


def test_words_are_hashed_together(monkeypatch):
    """One call for each word of a text is what most of the time of marking and signing went to."""
    calls = []
    one = xxhash.xxh64_intdigest
    monkeypatch.setattr(shingles.xxhash, "xxh64_intdigest", lambda word: calls.append(word) or one(word))
    WordHashes().of_all(pa.array([" ".join(f"w{k}" for k in range(5000)), "x" * 300]))
    assert calls == [b"x" * 300]


def test_sets_of_many_texts_are_those_of_each():
    found = [WordHashes().of(t) for t in varied(2)]
    hashes, owner = shingle_sets(found)
    for k, words in enumerate(found):
        assert hashes[owner == k].tolist() == shingle_set(words).tolist()


def test_minima_of_many_texts_are_those_of_each(monkeypatch):
    monkeypatch.setattr(near, "_AT_ONCE", 100)  # texts that go on in the next part
    hashes, owner = shingle_sets([WordHashes().of(t) for t in varied(3)])
    texts = int(owner.max()) + 2
    got = near.minima_of(hashes, owner, texts, near.DOCUMENTS)
    for k in range(texts):
        mine = hashes[owner == k]
        wanted = near.minima(mine, near.DOCUMENTS) if len(mine) else np.zeros(near.DOCUMENTS.minima, np.uint64)
        assert (got[k] == wanted).all()
