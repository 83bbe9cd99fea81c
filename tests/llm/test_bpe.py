import hashlib
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketlake.llm.bpe import Runs, WordBpe, encode_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


@pytest.fixture(scope="module")
def own():
    return WordBpe(open(PATH, encoding="utf-8").read())


def same(library, own, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "", " \n", "Hello  World's don't I'LL", "ΑΣ ΑΣ. Σ", "a<|endoftext|>b <|startoftext|>", "12 ½ Ⅳ 你好 힣",
    "é é ẛ̣", "a\x1cb\x85c\xa0d e​f", "''s '' 'ſ İstanbul", "z" * 9000, "👩‍👩‍👧",
])
def test_equals_the_library(library, own, text):
    same(library, own, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcXYZ 'stredmlv129é́ñßΣİ<|>.!?\n\t　你👍"), max_size=60))
def test_equals_the_library_on_any_text(library, own, text):
    same(library, own, text)


def test_documents(spark, odd, none, library):
    got = encode_documents(odd, PATH).collect()
    texts = [r.text or "" for r in odd.select("text").collect()]
    assert len(got) == len(texts)
    wanted = []
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        wanted.append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(decoded.encode()).hexdigest(), ids))
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in got) == sorted(wanted)
    assert encode_documents(none, PATH, ids=False).count() == 0


def test_memory_of_many_distinct_runs(library, own):
    """A worker has little memory beside the JVM, and keeps its encoder for the stages that follow."""
    runs = Runs(own)
    tracemalloc.start()
    for at in range(10**7, 10**7 + 500_000, 5000):
        text = " ".join(map(str, range(at, at + 5000)))
        ids, cuts, decoded = runs.portion(pa.array([text, None]))
        assert cuts.tolist() == [0, 40_000, 40_000]
    peak = tracemalloc.get_traced_memory()[1]
    runs.release()
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert peak < 64 << 20 and held < 8 << 20
    wanted = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == wanted
    assert decoded.to_pylist() == [library.decode(wanted, skip_special_tokens=False).encode(), b""]
