"""Byte-pair encoding of whole texts with a public vocabulary, and its decoding.

Each pre-token is a doubly linked list of symbols; a priority queue holds the ranks of the merges that
its neighbours allow, and entries whose symbols have changed meanwhile are skipped. Decoding joins the
vocabulary strings of the ids, as the library does for a vocabulary without a decoder.

No token reaches past an ASCII blank, so a portion of rows is cut into runs without blanks, each distinct run
is encoded and decoded once, and the rows' ids are put together from those of their runs by offsets.

Defined results: null and empty texts have no tokens and decode to an empty text; a text of any length
is encoded whole; repeated rows, and rows of one id, repeat; an empty table gives none; columns other than the
id and the text are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: pieces held in each of two generations: the older is dropped when the younger is full
_CACHE_PIECES = 1 << 17
#: runs that a worker holds before it begins anew: few, since their pieces are held too
_CACHE_RUNS = 1 << 16
_POSITION = (1 << 40) - 1
#: a portion ends with the row that passes either
_ROWS, _BYTES = 1024, 1 << 20


class Recent:
    """The results met lately, at most two generations of ``_CACHE_PIECES``."""

    def __init__(self):
        self.younger: dict = {}
        self.older: dict = {}

    def get(self, key):
        found = self.younger.get(key)
        if found is None and (found := self.older.get(key)) is not None:
            self.add(key, found)
        return found

    def add(self, key, value):
        if len(self.younger) >= _CACHE_PIECES:
            self.younger, self.older = {}, self.younger
        self.younger[key] = value


# fixed values: the split pattern of the vocabulary file; its \s is Unicode's White_Space
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PIECE = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+"
)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    stands for itself, the others take the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for a vocabulary file in the tokenizers format with word ends."""

    def __init__(self, definition: str):
        parsed = json.loads(definition)
        model = parsed["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        strings = [b""] * size
        for text, number in [*self.ids.items(), *self.special.items()]:
            strings[number] = text.encode("utf-8")
        self.strings = pa.array(strings, pa.large_binary())
        #: pair of ids -> rank above the bits of a position; the symbol that a rank makes
        self.merges: dict[int, int] = {}
        self.made: list[int] = [0]
        for rank, (left, right) in enumerate(model["merges"], 1):
            joined = left.removesuffix(self.end) if self.end and left.endswith(self.end) else left
            self.merges[self.ids[left] << 20 | self.ids[right]] = rank << 40
            self.made.append(self.ids[joined + right])
        letters = byte_letters()
        self.first = [self.ids[x] for x in letters]
        self.closing = [self.ids[x + self.end] for x in letters]
        #: ranks of the merges of two bytes, inside a piece and at its end
        self.inside, self.at_end = (
            [[self.merges.get(a << 20 | b, 0) for b in second] for a in self.first]
            for second in (self.first, self.closing)
        )
        self.marks = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.mark_bytes = b"".join(m.encode("utf-8")[:1] for m in self.special)
        self.pieces = Recent()

    def piece(self, text: str) -> list[int]:
        """Ids of one pre-token."""
        raw = text.encode("utf-8")
        last = len(raw) - 1
        first, inside = self.first, self.inside
        symbols = [first[b] for b in raw]
        symbols[-1] = self.closing[raw[-1]]
        if not last:
            return symbols
        # an entry is rank and left position in one integer, so the queue orders by both; the one that
        # holds for a position now is kept beside, 0 if there is none
        holds = [inside[a][b] for a, b in zip(raw, raw[1:])]
        holds[-1] = self.at_end[raw[-2]][raw[-1]]
        holds = [rank | at if rank else 0 for at, rank in enumerate(holds)]
        queue = [entry for entry in holds if entry]
        if not queue:
            return symbols
        holds.append(0)
        heapq.heapify(queue)
        pop, push, rank_of, made = heapq.heappop, heapq.heappush, self.merges.get, self.made
        before, after = list(range(-1, last)), list(range(1, last + 2))
        while queue:
            entry = pop(queue)
            left = entry & _POSITION
            if holds[left] != entry:
                continue  # stale: merged away, or a neighbour has merged since
            right = after[left]
            symbol = symbols[left] = made[entry >> 40]
            symbols[right], holds[right] = -1, 0
            far = after[left] = after[right]
            entry = 0
            if far <= last:
                before[far] = left
                if rank := rank_of(symbol << 20 | symbols[far]):
                    entry = rank | left
                    push(queue, entry)
            holds[left] = entry
            near = before[left]
            if near >= 0:
                entry = 0
                if rank := rank_of(symbols[near] << 20 | symbol):
                    entry = rank | near
                    push(queue, entry)
                holds[near] = entry
        return [s for s in symbols if s >= 0]

    def _known(self, found: str) -> tuple[int, ...]:
        ids = self.pieces.get(found)
        if ids is None:
            # a tuple of numbers is nothing that the collector must follow
            ids = tuple(self.piece(found))
            if len(found) <= 64:
                self.pieces.add(found, ids)
        return ids

    def _plain(self, text: str) -> Sequence[int]:
        # one code point at a time, as the library lower-cases: no rule for a final sigma
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if text.isalpha():
            return self._known(text)
        out: list[int] = []
        for found in _PIECE.findall(text):
            out += self._known(found)
        return out

    def run(self, raw: bytes) -> Sequence[int]:
        """Ids of a run without ASCII blanks; no pre-token and no special token reaches past one."""
        text = raw.decode("utf-8")
        if raw.translate(None, self.mark_bytes) == raw:
            return self._plain(text)
        out, at = [], 0
        for mark in self.marks.finditer(text):
            out += self._plain(text[at : mark.start()])
            out.append(self.special[mark.group()])
            at = mark.end()
        out += self._plain(text[at:])
        return out

    def encode(self, text: str | None) -> list[int]:
        return [i for raw in (text or "").encode("utf-8").split() for i in self.run(raw)]

    def decode(self, ids: list[int]) -> str:
        return self.decoded(np.array(ids, np.uint32), np.array([0, len(ids)]))[0].as_py().decode("utf-8")

    def decoded(self, ids: np.ndarray, cuts: np.ndarray) -> pa.Array:
        """The texts of ``ids``, cut at ``cuts``."""
        strings = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), self.strings.take(pa.array(ids)))
        return pc.binary_join(strings, pa.scalar(b" ", pa.large_binary()))


class Runs(dict):
    """Number of each run met, with its ids; begins anew when it has grown past a fixed size."""

    def __init__(self, bpe: WordBpe):
        super().__init__()
        self.bpe = bpe
        self._begin()

    def release(self) -> None:
        """Hold no results between tasks: the worker's next may be of a stage that needs the memory."""
        self._begin()
        self.bpe.pieces = Recent()
        pa.default_memory_pool().release_unused()

    def _begin(self) -> None:
        self.clear()
        self.ids, self.ends = array("I"), array("q", [0])

    def __missing__(self, raw: bytes) -> int:
        number = self[raw] = len(self.ends) - 1
        self.ids.extend(self.bpe.run(raw))
        self.ends.append(len(self.ids))
        return number

    def portion(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(ids of all texts, where each text's begin and the last's end, decoded texts)."""
        if len(self) > _CACHE_RUNS:
            self._begin()
        runs = pc.ascii_split_whitespace(texts.fill_null(""))
        rows = np.repeat(np.arange(len(runs)), pc.list_value_length(runs).to_numpy())
        coded = runs.flatten().cast(pa.binary()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))
        ends = np.array(self.ends)
        held = numbers[coded.indices.to_numpy()]
        sizes = ends[held + 1] - ends[held]
        some = sizes > 0  # blanks at the ends of a text part off empty runs
        held, sizes, rows = held[some], sizes[some], rows[some]
        upto = np.cumsum(sizes)
        at = np.arange(upto[-1] if len(upto) else 0) + np.repeat(ends[held] - upto + sizes, sizes)
        cuts = np.concatenate([[0], upto])[np.searchsorted(rows, np.arange(len(runs) + 1))]
        ids = np.array(self.ids, np.uint32)[at]
        return ids, cuts, self.bpe.decoded(ids, cuts)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy())
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0
            end = min(at + _ROWS, batch.num_rows, int(np.searchsorted(sizes, done + _BYTES)) + 1)
            yield batch.slice(at, end - at)
            at = end


@functools.lru_cache(maxsize=2)
def runs_of(definition: str) -> Runs:
    """One encoder for each Python worker, kept from task to task without what it met."""
    return Runs(WordBpe(definition))


def encode_documents(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) for each row; ``vocabulary`` is the path of
    the vocabulary file on the driver, whose text (under 2 MB, fixed) is broadcast.

    ``ids`` keeps the token ids as an array; digests are of the ids as little-endian 32-bit words and
    of the decoded text in UTF-8.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = runs_of(shared.value)
        try:
            for batch in _portions(batches):
                numbers, cuts, decoded = runs.portion(batch["text"])
                packed, sha = memoryview(numbers.astype("<u4")).cast("B"), hashlib.sha256
                columns = [
                    batch["doc_id"], pa.array(np.diff(cuts), pa.int64()),
                    pa.array([sha(packed[4 * a : 4 * b]).hexdigest() for a, b in zip(cuts, cuts[1:])], pa.string()),
                    pa.array([sha(text.as_buffer()).hexdigest() for text in decoded], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(numbers.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
        finally:
            runs.release()

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    made = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return narrow.mapInArrow(encode, made + (", ids array<int>" if ids else ""))
