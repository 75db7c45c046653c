"""Sorted runs of byte strings: front coding, and a merge by a loser tree that knows common prefixes.

A run is a sorted list of strings. Its front code holds, for each string, how many bytes it shares with the one
before and the bytes that follow. A merge of runs needs the strings' order only, and most of it is known already:
two strings that share different numbers of bytes with the last winner are ordered by these numbers, and two that
share the same number are compared from that byte on. No byte of a known common prefix is looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix of a and b, which share `start` bytes."""
    n = min(len(a), len(b))
    while start < n:
        step = min(n - start, 64)
        x = int.from_bytes(a[start : start + step]) ^ int.from_bytes(b[start : start + step])
        if x:
            return start + (8 * step - x.bit_length()) // 8
        start += step
    return n


def encode(strings: list[bytes], shared: list[int], numbers: np.ndarray) -> bytes:
    """A front-coded block of a sorted run with a row of numbers for each string.

    shared: bytes that each string shares with the one before it in the run; for the first string they count as 0.
    """
    shared = [0, *shared[1:]]
    head = np.array([[h, len(s) - h] for s, h in zip(strings, shared, strict=True)], dtype=np.int32)
    rest = b"".join([s[h:] for s, h in zip(strings, shared, strict=True)])
    sizes = np.array([len(strings), numbers.shape[1]], dtype=np.int64)
    # numbers column by column, as differences: they compress better
    columns = np.diff(numbers.T, axis=1, prepend=0).astype(np.int64)
    return zstandard.ZstdCompressor(level=3).compress(b"".join([sizes.tobytes(), head.T.tobytes(), columns.tobytes(), rest]))


def decode(block: bytes) -> Iterator[tuple[int, bytes, tuple[int, ...]]]:
    """(bytes shared with the string before, string, its numbers), in the order of the run."""
    data = zstandard.ZstdDecompressor().decompress(block)
    n, width = (int(x) for x in np.frombuffer(data, dtype=np.int64, count=2))
    at = 16
    shared, more = np.frombuffer(data, dtype=np.int32, count=2 * n, offset=at).reshape(2, n).tolist()
    at += 8 * n
    numbers = np.frombuffer(data, dtype=np.int64, count=n * width, offset=at).reshape(width, n).cumsum(axis=1).T.tolist()
    at += 8 * n * width
    last = b""
    for h, m, own in zip(shared, more, numbers, strict=True):
        last = last[:h] + data[at : at + m]
        at += m
        yield h, last, tuple(own)


def merge(blocks: list[bytes]) -> Iterator[tuple[int, bytes, tuple[int, ...]]]:
    """All strings of the runs in order, as decode() gives them: the first number is shared with the winner before.

    Strings that are equal come in no fixed order. The tree holds the losers; each keeps the length of the prefix it
    shares with the last winner that it met, which is the one that went up past it.
    """
    runs = [decode(b) for b in blocks]
    k = 1
    while k < len(runs):
        k *= 2
    ended = (-1, b"", ())
    heads = [next(r, ended) for r in runs] + [ended] * (k - len(runs))
    known = [h[0] for h in heads]  # shared with the last winner; -1: the run is over
    if k == 1:
        while known[0] >= 0:
            yield known[0], heads[0][1], heads[0][2]
            heads[0] = next(runs[0], ended)
            known[0] = heads[0][0]
        return

    losers = [0] * k

    def play(i: int, j: int) -> tuple[int, int]:
        """(winner, loser) of two runs; the loser's known prefix becomes the one it shares with the winner."""
        p, q = known[i], known[j]
        if p > q:
            return i, j
        if q > p:
            return j, i
        if p < 0:
            return i, j
        a, b = heads[i][1], heads[j][1]
        h = common(a, b, p)
        if h == len(b) or (h < len(a) and a[h] > b[h]):
            if h == len(a) == len(b):
                known[j] = h
                return i, j
            known[i] = h
            return j, i
        known[j] = h
        return i, j

    def build(node: int) -> int:
        if node >= k:
            return node - k
        first, second = play(build(2 * node), build(2 * node + 1))
        losers[node] = second
        return first

    best = build(1)
    while known[best] >= 0:
        yield known[best], heads[best][1], heads[best][2]
        heads[best] = next(runs[best], ended) if best < len(runs) else ended
        p = known[best] = heads[best][0]
        node = (best + k) // 2
        while node:
            other = losers[node]
            q = known[other]
            if q > p:
                losers[node], best, p = best, other, q
            elif q == p >= 0:
                best, losers[node] = play(best, other)
                p = known[best]
            node //= 2
