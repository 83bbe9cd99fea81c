"""Word shingles of whole texts as sets of 64-bit hashes, made with numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS_PER_SHINGLE = 5
#: words of more bytes are hashed one by one
_LONG_WORD = 256
_IS_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: a portion of texts ends with the one that passes these bytes
_PORTION = 1 << 19
_SHORT = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


class WordHashes:
    """Hashes of the words of texts. Words are runs of non-blank characters with A-Z lower-cased; other
    scripts stay as they are. All words of many texts are hashed at once, eight bytes at a time; nothing
    is kept from text to text."""

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the words of a text in order."""
        return self._hashed([(text or "").encode("utf-8", "surrogatepass")])[0]

    def of_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``of`` each text, laid end to end, and where each begins and the last ends."""
        return self._hashed(pc.fill_null(texts.cast(pa.binary()), b"").to_pylist())

    @staticmethod
    def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raw = b"".join(texts).lower()  # bytes know ASCII only
        size, ends_at = len(raw), np.cumsum([0, *map(len, texts)])
        padded = np.frombuffer(raw + bytes(16 - size % 8), np.uint8)
        blank = _IS_BLANK[padded[:size]]
        before, after = np.append(True, blank), np.append(blank, True)
        before[ends_at] = after[ends_at] = True  # no word goes on in the next text
        starts = np.flatnonzero(before[:-1] & ~blank)
        lengths = np.flatnonzero(after[1:] & ~blank) + 1 - starts
        eights = padded.view("<u8")

        def eight(at: np.ndarray, length: np.ndarray) -> np.ndarray:
            """Up to eight bytes from each place, zeros behind the word."""
            whole, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
            found = eights[whole] >> shift
            found |= eights[whole + 1] << np.uint64(1) << (np.uint64(63) - shift)
            found &= _FIRST_BYTES[np.minimum(length, 8)]
            return found

        hashes = eight(starts, lengths)
        more = np.flatnonzero(lengths > 8)
        for done in range(8, _LONG_WORD, 8):
            if not len(more):
                break
            hashes[more] = mixed(hashes[more]) + eight(starts[more] + done, lengths[more] - done)
            more = more[lengths[more] > done + 8]
        hashes = mixed(mixed(hashes) + lengths.astype(np.uint64))
        for k in more.tolist():
            hashes[k] = xxhash.xxh64_intdigest(raw[starts[k] : starts[k] + lengths[k]])
        return hashes, np.searchsorted(starts, ends_at)


def portions(texts: pa.Array, size: int = _PORTION) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of texts with about ``size`` bytes."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
    at = 0
    while at < len(upto):
        done = upto[at - 1] if at else 0
        end = min(len(upto), int(np.searchsorted(upto, done + size)) + 1)
        yield at, end - at
        at = end


def mixed(values: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    half = np.uint64(32)
    out = values >> half
    out ^= values
    out *= _STEP
    out ^= out >> half
    out *= _STEP
    out ^= out >> half
    return out


def shingle_set(words: np.ndarray, width: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words. A text of fewer words is one shingle,
    a text of none has the empty set."""
    if not len(words):
        return words
    if len(words) < width:
        whole = np.array([_SHORT], np.uint64)
        for k in range(len(words)):
            whole = mixed(whole * _STEP + words[k : k + 1])
        return whole
    runs = words[: len(words) - width + 1].copy()
    for k in range(1, width):
        runs = mixed(runs) + words[k : len(words) - width + 1 + k]
    return np.unique(mixed(runs))


def shingle_sets(texts: list[np.ndarray], width: int = WORDS_PER_SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_set`` of each text, laid end to end, and the number of the text that each hash is of."""
    sizes = np.array([len(t) for t in texts])
    words, owner = np.concatenate(texts), np.repeat(np.arange(len(texts)), sizes)
    count = max(0, len(words) - width + 1)
    runs = words[:count]
    for k in range(1, width):
        runs = mixed(runs) + words[k : k + count]
    inside = owner[:count] == owner[len(words) - count :]  # not across the end of a text
    hashes, owner = mixed(runs)[inside], owner[:count][inside]
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(short):
        hashes = np.concatenate([hashes, *[shingle_set(texts[k], width) for k in short]])
        owner = np.concatenate([owner, short])
    order = np.argsort(hashes)
    order = order[np.argsort(owner[order].astype(np.min_scalar_type(len(texts))), kind="stable")]
    hashes, owner = hashes[order], owner[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))[: len(hashes)]
    return hashes[new], owner[new]


def common(left: np.ndarray, right: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if not len(left) or not len(right):
        return 0
    at = np.searchsorted(left, right)
    at[at == len(left)] = 0
    return int(np.count_nonzero(left[at] == right))
