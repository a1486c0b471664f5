"""Word shingles of texts as 64-bit numbers, computed for many texts at once with numpy.

A word is a maximal run of bytes that are neither space nor one of 0x09 to 0x0D; A to Z count as a to z.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: Bytes of text that are hashed at once.
CHUNK_BYTES = 1 << 19


def mixed(values: np.ndarray) -> np.ndarray:
    """Each number scattered over all 64 bits."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def _powers(count: int, known: list[np.ndarray] = [np.ones(1, np.uint64)]) -> np.ndarray:  # noqa: B006
    while len(known[0]) < count:
        known[0] = np.concatenate([known[0], known[0] * _BASE ** np.uint64(len(known[0]))])
    return known[0]


def _hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the first byte's position of every word of some bytes."""
    inside = ~_SPACE[data]
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    letters = data[inside]
    first = np.flatnonzero((~before)[inside])
    lengths = np.diff(np.append(first, len(letters)))
    offset = np.arange(len(letters)) - np.repeat(first, lengths)
    sums = np.add.reduceat(_BYTE[letters] * _powers(int(lengths.max()))[offset], first)
    return mixed(sums + lengths.astype(np.uint64)), starts


def _long_text_words(text: bytes) -> np.ndarray:
    """Word hashes of one text, in pieces that end where a word ends."""
    found, at = [], 0
    while at < len(text):
        end = min(at + CHUNK_BYTES, len(text))
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        found.append(_hash_words(np.frombuffer(text, np.uint8, end - at, at))[0])
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def word_hashes(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """The word hashes of each text in order."""
    group: list[bytes] = []
    held = 0

    def flush() -> Iterator[np.ndarray]:
        ends = np.cumsum([len(t) + 1 for t in group])
        hashes, starts = _hash_words(np.frombuffer(b" ".join(group), np.uint8))
        yield from np.split(hashes, np.searchsorted(starts, ends[:-1]))

    for text in texts:
        text = text or b""
        if len(text) > CHUNK_BYTES:
            if group:
                yield from flush()
                group, held = [], 0
            yield _long_text_words(text)
            continue
        group.append(text)
        held += len(text)
        if held > CHUNK_BYTES:
            yield from flush()
            group, held = [], 0
    if group:
        yield from flush()


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct shingles of ``size`` words, sorted; of fewer words, the whole sequence as one."""
    if not len(words):
        return words
    width = min(size, len(words))
    count = len(words) - width + 1
    rolled = np.full(count, np.uint64(width))
    for k in range(width):
        rolled = mixed(rolled * _BASE + words[k : k + count])
    return np.unique(rolled)
