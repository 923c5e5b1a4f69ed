"""Numpy views of Arrow string columns: bytes, words and their hashes.

Helpers for the inside of a task. They get one Arrow batch at a time and work on pieces
of it of about ``PIECE`` bytes, so memory is bounded by a piece or by the longest text.
Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
#: An odd multiplier, and the seeds of two independent hashes.
FACTOR = 0x9E3779B97F4A7C15
SEED, SEED2 = 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D
MASK = (1 << 64) - 1
#: Longest string that is hashed eight bytes at a time.
LONG = 64
#: TAIL[n] keeps the first n bytes of eight.
TAIL = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column, offsets starting at 0, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    bufs = column.buffers()
    offsets = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def pieces(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of rows with about ``size`` bytes each; a longer row stands alone."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b
        a = b


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i] .. starts[i] + lengths[i] of all i, one after the other."""
    total = int(lengths.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that near values spread over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one number, zeros behind the end; a view."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 8,), np.uint64, padded, strides=(1,))


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Hashes of the byte strings data[start:end]: equal strings have equal hashes wherever they stand.

    Strings are taken in eight bytes at a time, each step a bijection of what it takes in, so
    strings of up to eight bytes and one length never share a hash. Those of more than LONG bytes
    are hashed by BLAKE2. Hashes with different seeds are independent.
    """
    length = end - start
    h = mix(length.astype(np.uint64) * np.uint64(FACTOR) + np.uint64(seed))
    if not len(h):
        return h
    eight = eight_bytes(data)
    long = np.flatnonzero(length > LONG)
    key = seed.to_bytes(8, "little")
    for i, a, b in zip(long.tolist(), start[long].tolist(), end[long].tolist(), strict=True):
        h[i] = int.from_bytes(blake2b(data[a:b].tobytes(), digest_size=8, key=key).digest(), "little")
    left = np.flatnonzero(length <= LONG) if len(long) else np.arange(len(h))
    at, rest = start[left], length[left]
    while len(left):
        chunk = eight[at] & TAIL[np.minimum(rest, 8)]
        h[left] = mix((h[left] ^ chunk) * np.uint64(FACTOR) + np.uint64(seed))
        more = rest > 8
        left, at, rest = left[more], at[more] + 8, rest[more] - 8
    return h


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BLAKE2 digests of 128 bits of the byte strings data[start:end], as two columns of numbers."""
    raw = data.tobytes()
    out = b"".join([blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)])
    both = np.frombuffer(out, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes for which inside[byte], within each row."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    m = np.zeros(n + 2, bool)
    m[1:-1] = inside[data]
    start, end = m[1:-1] & ~m[:-2], m[1:-1] & ~m[2:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    start[edge] = m[edge + 1]
    end[edge - 1] = m[edge]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row that each start (ascending) lies in."""
    return np.searchsorted(offsets, starts, side="right") - 1


def counts_by_row(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    at = np.searchsorted(starts, offsets)
    return np.diff(at)


class HashIndex:
    """Look-up of evenly spread 64-bit hashes: their first bits lead next to the place in sorted order."""

    def __init__(self, hashes: np.ndarray):
        """hashes: sorted, without repeats."""
        bits = min(20, max(4, int(len(hashes)).bit_length() + 1))
        self.shift = np.uint64(64 - bits)
        self.sorted = np.append(hashes, np.uint64(MASK))
        self.first = np.append(0, np.cumsum(np.bincount((hashes >> self.shift).astype(np.int64), minlength=1 << bits)))[:-1]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Positions in sorted order, len(hashes of the index) at most; check ``sorted[at] == hash``."""
        at = self.first[(hashes >> self.shift).astype(np.int64)]
        behind = np.flatnonzero(self.sorted[at] < hashes)
        while len(behind):
            at[behind] += 1
            behind = behind[self.sorted[at[behind]] < hashes[behind]]
        return at
