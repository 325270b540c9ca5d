"""Sets of word 5-grams as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from tidemark.llm.common import mix64, seeded, word_hashes

WORDS = 5
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_PLACE = seeded("shingle place", WORDS)
_SHORT = seeded("short text", WORDS)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct shingles of each text, rising.

    A-Z are lower-cased; words are what spaces and U+0009-U+000D part. A text of
    one to four words has one shingle, all its words; one without words has none.
    """
    data = [(t or "").encode().translate(_LOWER) + b"\n" for t in texts]
    letters = np.frombuffer(b"\n" + b"".join(data), dtype=np.uint8)
    space = _IS_SPACE[letters]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    words = word_hashes(letters, starts, ends)
    offsets = 1 + np.cumsum([0, *map(len, data)])
    bounds = np.searchsorted(starts, offsets)
    n = max(0, len(words) - WORDS + 1)
    joined = np.zeros(n, dtype=np.uint64)
    for k in range(WORDS):
        joined += words[k : k + n] * (_PLACE[k] | np.uint64(1))
    joined = mix64(joined)
    out = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        count = high - low
        if count >= WORDS:
            own = np.sort(joined[low : high - WORDS + 1])
            out.append(own[np.r_[True, own[1:] != own[:-1]]])
        elif count:
            own = words[low:high] * (_PLACE[:count] | np.uint64(1))
            own = own.sum(dtype=np.uint64, keepdims=True) + _SHORT[count : count + 1]
            out.append(mix64(own))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart: a sum and an xor of differently mixed members."""
    a = np.add.reduce(mix64(hashes), dtype=np.uint64)
    b = np.bitwise_xor.reduce(mix64(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return int(a.view(np.int64)), int(b.view(np.int64))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many members two sets have in common."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def linked(a: np.ndarray, b: np.ndarray, percent: int = 80) -> bool:
    """Whether 100 * intersection >= percent * union, for sets that are not empty."""
    both = shared(a, b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)
