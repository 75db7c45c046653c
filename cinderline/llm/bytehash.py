"""Rolling hashes over byte buffers, in numpy: every word or every fixed-length string of a batch of texts at once.

A buffer of bytes b has the prefix sums H[i] = sum over j < i of V[b[j]] * B**j modulo 2**64, V a table of mixed
values, B odd. (H[e] - H[s]) * B**-s then depends on the bytes s to e alone, wherever they stand.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_held: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i for i up to n; kept for the next batch."""
    if len(_held.get("up", ())) <= n:
        for name, base in (("up", BASE), ("down", UNBASE)):
            x = np.full(n + n // 4 + 2, base, dtype=np.uint64)
            x[0] = 1
            _held[name] = np.cumprod(x, dtype=np.uint64)
    return _held["up"], _held["down"]


def prefix(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(VALUES[data] * _powers(len(data))[0][: len(data)], out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the bytes start to end, for arrays of spans."""
    return mix((sums[end] - sums[start]) * _powers(len(sums))[1][start] + (end - start).astype(np.uint64))


def grams(data: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k bytes from every position on."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    sums = prefix(data)
    return mix((sums[k:] - sums[:n]) * _powers(len(sums))[1][:n])


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts, each followed by a line feed, and where each text starts (one more entry for the end)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return data, starts


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of the first word of each text and of the end).

    Words are runs of bytes other than 0x20 and 0x09 to 0x0D; A to Z count as a to z. Such bytes never are part of a
    longer UTF-8 character, so these are the words of the text.
    """
    data, starts = join(texts)
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    low = LOWER[data]
    gap = np.ones(len(low) + 2, dtype=bool)
    gap[1:-1] = SPACES[low]
    begin = np.flatnonzero(gap[:-2] & ~gap[1:-1])
    end = np.flatnonzero(~gap[1:-1] & gap[2:]) + 1
    return spans(prefix(low), begin, end), np.searchsorted(begin, starts)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of k words in a row, from every word that k words start at; with fewer words, none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(BASE) + hashes[i : i + n]
    return mix(out)
