"""Vectorised hashes of bytes, words and shingles, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Texts are hashed together up to so many bytes; a longer one is hashed alone.
PIECE = 1 << 20
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
IS_SPACE = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


#: A value for each byte, so that sums of powers tell strings apart.
BYTE_VALUE = scramble(np.arange(1, 257, dtype=U))


class Powers:
    """BASE**i and its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, U), np.ones(1, U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([np.ones(1, U), np.full(size - 1, BASE, U)]))
                self.down = np.cumprod(np.concatenate([np.ones(1, U), np.full(size - 1, INVERSE, U)]))
        return self.up, self.down


POWERS = Powers()


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """s with hash(data[i:j]) = (s[j] - s[i]) * down[i]: equal bytes, equal value."""
    up, _ = POWERS.get(len(data) + 1)
    out = np.zeros(len(data) + 1, U)
    np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=out[1:])
    return out


def pieces(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, UTF-8 of some texts in turn), of about PIECE bytes."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        if held and size + len(raw) > PIECE:
            yield first, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def shingle_sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its k-word shingles. Words are
    lower-cased in A-Z; fewer than k words make one shingle, no words none."""
    with np.errstate(over="ignore"):
        for _, raws in pieces(texts):
            data = np.frombuffer(b" ".join(raws).translate(LOWER_BYTES) + b" ", np.uint8)
            space = IS_SPACE[data]
            edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
            starts, ends = edge[0::2], edge[1::2]
            sums, (_, down) = prefix_sums(data), POWERS.get(len(data) + 1)
            words = scramble((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))
            begins = np.cumsum([0, *(len(r) + 1 for r in raws)])
            at = np.searchsorted(starts, begins)
            folded = np.zeros(max(0, len(words) - k + 1), U)
            for j in range(k):
                folded = folded * U(BASE) + words[j : j + len(folded)]
            folded = scramble(folded)
            for a, b in zip(at[:-1], at[1:], strict=True):
                if b - a >= k:
                    yield np.unique(folded[a : b - k + 1])
                elif b > a:
                    h = np.full(1, b - a, U)
                    for w in words[a:b]:
                        h = h * U(BASE) + w
                    yield scramble(h)
                else:
                    yield np.empty(0, U)
