"""Elias-Fano sequences as arrays that can be memory-mapped.

A sequence of n non-decreasing values below u keeps the low ``log2(u/n)`` bits of each value packed, and the high parts in unary: bit ``high + index`` is
set for each value. A directory counts the ones before each 64-bit word: with it ``access`` finds the i-th one. Another says how many values stand before each
high part, in full for every 64th and as a byte more for the others (two or four where runs are long): with it ``successor`` jumps to the
values of a high part and halves them by their low bits. All work on arrays of queries.
"""

from __future__ import annotations

import numpy as np

from .shared import get_array, put_array

_PARTS = ("head", "low", "high", "ones", "base", "more")


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    n = len(values)
    bits = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
    values = values.astype(np.uint64)
    low = np.zeros(0, np.uint8)
    if n and bits:
        planes = [np.packbits(((values[a : a + (1 << 16)][:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).reshape(-1), bitorder="little") for a in range(0, n, 1 << 16)]
        low = np.concatenate(planes)  # 2**16 values fill whole bytes
    top = (values >> np.uint64(bits)).astype(np.int64)
    size = n + (int(universe) >> bits) + 2
    flags = np.zeros(-(-size // 64) * 64, dtype=bool)
    flags[top + np.arange(n)] = True
    high = np.packbits(flags, bitorder="little").view("<u8")
    ones = np.zeros(len(high) + 1, np.uint32)
    np.cumsum(np.bitwise_count(high), out=ones[1:])
    buckets = np.zeros(-(-((int(universe) >> bits) + 3) // 64) * 64, np.uint32)
    np.cumsum(np.bincount(top, minlength=len(buckets) - 1)[: len(buckets) - 1], out=buckets[1:])
    base = buckets[::64].copy()
    more = buckets - np.repeat(base, 64)
    most = int(more.max(initial=0))
    more = more.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)
    whole = np.zeros(-(-len(low) // 8) * 8 + 16, np.uint8)
    whole[: len(low)] = low
    return {"head": np.array([n, bits, universe], np.int64), "low": whole.view("<u8"), "high": high, "ones": ones, "base": base, "more": more}


def _select(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit of that rank in each word."""
    word, rank, at = word.copy(), rank.astype(np.int64), np.zeros(len(word), np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        c = np.bitwise_count(word & np.uint64((1 << step) - 1)).astype(np.int64)
        go = rank >= c
        rank -= c * go
        shift = go * step
        word >>= shift.astype(np.uint64)
        at += shift
    return at


class Sequence:
    """Queries on an encoded sequence."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.n, self.bits, self.universe = (int(x) for x in parts["head"])
        self.low, self.high, self.ones = parts["low"], parts["high"], parts["ones"]
        self.mask = np.uint64((1 << self.bits) - 1)
        self.base, self.more = parts["base"], parts["more"]
        #: Eight bytes of the low parts from each byte on.
        self.bytes = np.ndarray((max(self.low.nbytes - 7, 0),), "<u8", self.low, strides=(1,))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.bits
        if self.bits <= 57:  # a value lies within the eight bytes from its first one on
            out = self.bytes[at >> 3]
            at &= 7
            out >>= at.view(np.uint64)
            out &= self.mask
            return out
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        # a value may reach into the next word; a shift by 64 is made of two
        out = self.low[word] >> shift
        shift ^= np.uint64(63)
        out |= (self.low[word + 1] << np.uint64(1)) << shift
        out &= self.mask
        return out

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at these indices."""
        word = np.searchsorted(self.ones, i.astype(np.uint32), "right") - 1
        at = word * 64 + _select(self.high[word], i - self.ones[word])
        return ((at - i).astype(np.uint64) << np.uint64(self.bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first value that is x or more (n if none), and whether it is x."""
        top = (x >> np.uint64(self.bits)).astype(np.int64)
        want = x & self.mask
        i, end = self._before(top), self._before(top + 1)
        left = end - i
        # values of one high part lie close where a word has many successors, so runs are long: each is halved, and those that are done leave
        own = np.flatnonzero(left)
        at, left, goal = i[own], left[own], want[own]
        while len(own):
            half = left >> 1
            less = (self._low(at + half) < goal) & (left > 0)
            at += (half + 1) * less
            left = np.where(less, left - half - 1, half)
            go = np.flatnonzero(left)
            if len(go) < 0.8 * len(left):
                i[own] = at
                own, at, left, goal = own[go], at[go], left[go], goal[go]
        hit = i < end
        inside = np.flatnonzero(hit)
        hit[inside] = self._low(i[inside]) == want[inside]
        return i, hit

    def _before(self, top: np.ndarray) -> np.ndarray:
        """Values of lesser high parts."""
        return self.base[top >> 6].astype(np.int64) + self.more[top]


def save(uri: str, values: np.ndarray, universe: int) -> None:
    for name, array in encode(values, universe).items():
        put_array(f"{uri}.{name}.npy", array)


def load(uri: str) -> Sequence:
    return Sequence({name: get_array(f"{uri}.{name}.npy") for name in _PARTS})
