"""numpy kernels over concatenated UTF-8 texts: rolling hashes, words and their hashes."""

from __future__ import annotations

import functools

import numpy as np

U64 = np.uint64
#: ASCII blanks of the word rule [^\x20\x09-\x0D]+.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: For "letters only" words: ASCII letters, digits and every byte of a non-ASCII character.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x9E3779B97F4A7C15)
    x = x ^ (x >> U64(29))
    x = x * U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> U64(32))


@functools.lru_cache(maxsize=4)
def _base(seed: int) -> tuple[np.ndarray, int, int]:
    rng = np.random.default_rng(seed)
    base = int(rng.integers(1 << 62, dtype=np.uint64)) * 2 + 1 | 1
    table = rng.integers(0, 1 << 63, size=256, dtype=np.uint64) * U64(2) + U64(1)
    return table, base & (2**64 - 1), pow(base, -1, 1 << 64)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Longer tables of powers are made anew instead of kept (16 bytes an entry and seed).
KEPT_POWERS = 1 << 20


def powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below at least ``n``."""
    have = _powers.get(seed)
    if have is None or len(have[0]) < n:
        _, base, inv = _base(seed)
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out = []
        for b in (base, inv):
            p = np.empty(size, U64)
            p[0] = 1
            done, step = 1, b
            while done < size:  # doubling: p[done:2*done] = p[:done] * b**done
                m = min(done, size - done)
                p[done : done + m] = p[:m] * U64(step)
                done, step = done + m, step * step % (1 << 64)
            out.append(p)
        have = tuple(out)
        if size <= KEPT_POWERS:
            _powers[seed] = have
    return have


def forget() -> None:
    """Free the tables of powers."""
    _powers.clear()


class Prefix:
    """Polynomial hash of any byte range of ``data`` (uint8) from one prefix sum, all arithmetic modulo 2**64."""

    def __init__(self, data: np.ndarray, seed: int = 7):
        self.pow, self.inv = powers(seed, len(data) + 1)
        self.sum = np.zeros(len(data) + 1, U64)
        np.cumsum(_base(seed)[0][data] * self.pow[: len(data)], out=self.sum[1:])

    def range(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sum[end] - self.sum[start]) * self.inv[start]

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k bytes from every position."""
        n = len(self.sum) - k
        return (self.sum[k:] - self.sum[:n]) * self.inv[:n] if n > 0 else np.zeros(0, U64)


def spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of concatenated texts: (start, end, index of the text). ``offsets`` start at 0; words never cross texts."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    sep = separator[data]
    first = ~sep
    first[1:] &= sep[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] |= ~sep[cuts]
    start = np.flatnonzero(first)
    last = ~sep
    last[:-1] &= sep[1:]
    last[cuts - 1] |= ~sep[cuts - 1]
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out
