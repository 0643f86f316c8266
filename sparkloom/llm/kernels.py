"""Vectorised kernels on UTF-8 bytes, shared by the operators that run in Arrow batches.

Everything here works on whole texts. Batches are cut into slices of bounded size, so memory
follows the slice (or one very long text), never the partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

#: ASCII A-Z to a-z; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: True where a byte belongs to a word of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = False

#: True where a byte belongs to a word of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = np.uint64(0x9E3779B97F4A7C15)
_TAIL = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit; works in place."""
    x ^= x >> np.uint64(30)
    x *= _A
    x ^= x >> np.uint64(27)
    x *= _B
    x ^= x >> np.uint64(31)
    return x


def lookup(table: np.ndarray, data: np.ndarray) -> np.ndarray:
    """``table[data]`` for a table of 256 bytes or booleans."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), dtype=table.dtype)


def give_back() -> None:
    """Returns freed memory to the system: workers are kept between tasks, and so would be what they once needed."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with at most ``limit`` bytes of text each, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to
    give_back()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes in a row, followed by eight zero bytes, and the offsets of the texts; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(8, np.uint8), np.zeros(1, np.int64)
    data = np.zeros(offsets[-1] - offsets[0] + 8, dtype=np.uint8)
    if len(data) > 8:
        data[:-8] = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray, classes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of maximal runs where ``inside`` holds, and the number of runs of each text.

    No run crosses the end of a text, nor a change of ``classes`` where they are given.
    """
    n = int(offsets[-1])
    inside = inside[:n]
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    cut = first[1:]  # a text ends after this byte
    if classes is not None:
        cut = cut.copy()
        cut[:-1] |= classes[1:n] != classes[: n - 1]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | cut[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | cut[:-1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1 - starts, np.diff(np.searchsorted(starts, offsets))


def hash_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans; spans of up to eight bytes and one length never collide.

    ``data`` must run at least eight bytes beyond the last span.
    """
    view = np.ndarray((max(len(data) - 7, 0),), dtype="<u8", buffer=data.data, strides=(1,))
    h = mix(lengths.astype(np.uint64) * _P + np.uint64(seed))
    at, left, idx = starts, lengths, None
    while len(at):
        part = view[at]
        part &= _TAIL[np.minimum(left, 8)]
        if idx is None:
            h = mix(h ^ part)
        else:
            h[idx] = mix(h[idx] ^ part)
        more = np.flatnonzero(left > 8)
        idx = more if idx is None else idx[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def word_hashes(column: pa.Array, inside: np.ndarray = NOT_SPACE, lower: bool = True, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text in order, and the number of words of each text."""
    data, offsets = text_bytes(column)
    if lower:
        data = lookup(LOWER, data)
    starts, lengths, counts = spans(lookup(inside, data), offsets)
    return hash_spans(data, starts, lengths, seed), counts


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order of appearance, and for each value the place of its own."""
    coded = pa.array(values).dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy(zero_copy_only=False)


def in_order(values: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Values below ``bound`` in ascending order, and their places before. Value and place are sorted as one number where they fit."""
    bits = max(len(values) - 1, 0).bit_length()
    if (bound - 1).bit_length() + bits > 64:
        order = np.argsort(values, kind="stable")
        return values[order], order
    both = values.astype(np.uint64) << np.uint64(bits) | np.arange(len(values), dtype=np.uint64)
    both.sort()
    return both >> np.uint64(bits), (both & np.uint64((1 << bits) - 1)).astype(np.int64)


def distinct_in_order(values: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values below ``bound``, ascending, and for each value the place of its own."""
    ordered, order = in_order(values, bound)
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    index = np.empty(len(ordered), np.int64)
    index[order] = np.cumsum(new) - 1
    return ordered[new], index


def row_starts(counts: np.ndarray) -> np.ndarray:
    """Offsets of rows that hold ``counts`` entries each."""
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + c)``."""
    total = row_starts(counts)
    return np.arange(total[-1], dtype=np.int64) + np.repeat(starts - total[:-1], counts)


def shingle_sets(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct n-word shingles, ascending, and their numbers.

    A text of fewer words, but not none, has its whole sequence as the one shingle.
    """
    first = row_starts(counts)
    full = np.maximum(counts - n + 1, 0)
    at = ranges(first[:-1], full)
    code = words[at] if len(at) else np.zeros(0, np.uint64)
    for k in range(1, n):
        code = code * _P + words[at + k]
    code = mix(code)
    rows = np.repeat(np.arange(len(counts)), full)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        # one hash of a sequence that no full shingle shares: its length goes in as well
        tail = np.array([_fold(words[first[d] : first[d + 1]]) for d in short], dtype=np.uint64)
        code, rows = np.concatenate([code, tail]), np.concatenate([rows, short])
    if len(short):
        order = np.argsort(rows, kind="stable")
        code, rows = code[order], rows[order]
    ends = np.searchsorted(rows, np.arange(len(counts) + 1)).tolist()
    for a, b in zip(ends, ends[1:]):  # sorting many short pieces is quicker than one sort by two keys
        code[a:b].sort()
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = (code[1:] != code[:-1]) | (rows[1:] != rows[:-1])
    return code[keep], np.bincount(rows[keep], minlength=len(counts))


def _fold(words: np.ndarray) -> int:
    code = len(words) + 1
    for w in words.tolist():
        code = (code * 0xD6E8FEB86659FD93 + w + 1) & 0xFFFFFFFFFFFFFFFF
    return code


def crc32_of_id(name: str = "doc_id"):
    """crc32 of an id as decimal text, as a Column."""
    from pyspark.sql import functions as F

    return F.crc32(F.col(name).cast("string").cast("binary"))
