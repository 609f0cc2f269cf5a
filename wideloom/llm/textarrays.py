"""Array views of many texts at once: byte classes, words and word hashes in a few numpy passes.

Texts are joined in groups of about ``GROUP`` bytes; a longer text is cut into blocks at white space
(inside a word only if a word is longer than a block), so memory is bounded for texts of any length
and every byte is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

GROUP = 1 << 20
_SPACES = b" \t\n\x0b\x0c\r"
_BASE = np.uint64(0x9E3779B97F4A7C15)          # odd, so that powers can be inverted

SPACE = np.zeros(256, bool)
SPACE[list(_SPACES)] = True


def blocks(text: bytes, size: int = GROUP) -> Iterator[bytes]:
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(s, at, at + size) for s in (b" ", b"\n", b"\t"))
        cut = cut + 1 if cut > at else at + size
        yield text[at:cut]
        at = cut
    yield text[at:]


def groups(texts: list[bytes], size: int = GROUP) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, block starts, text index of each block); blocks are parted by a line feed."""
    held, owner, total = [], [], 0
    for i, t in enumerate(texts):
        for b in blocks(t, size):
            held.append(b)
            owner.append(i)
            total += len(b) + 1
            if total >= size:
                yield _joined(held, owner)
                held, owner, total = [], [], 0
    if held:
        yield _joined(held, owner)


def _joined(held, owner):
    data = np.frombuffer(b"\n".join(held) + b"\n", np.uint8)
    starts = np.concatenate(([0], np.cumsum([len(b) + 1 for b in held])[:-1])).astype(np.int64)
    return data, starts, np.array(owner, np.int64)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def words(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs where ``mask`` is true."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def hashes(data: np.ndarray, start: np.ndarray, ends: list[np.ndarray]) -> list[np.ndarray]:
    """64-bit polynomial hashes of data[start:end] for each array of ends."""
    size = 1 << max(16, int(len(data)).bit_length())
    up, down = _powers(size)
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)])))
        out = []
        for end in ends:
            h = (total[end] - total[start]) * down[start]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            out.append(h ^ (h >> np.uint64(32)))
    return out
