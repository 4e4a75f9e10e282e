"""Vectorised word tools shared by the operators on words: whole texts of an Arrow column are cut
into words ``[^\\x20\\x09-\\x0D]+`` and hashed with numpy, without a Python loop over words.

Texts are taken in blocks of about ``BLOCK_BYTES``, so a task's memory follows the block (or one
document, if that is longer), never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard

BLOCK_BYTES = 1 << 20
#: Bytes up to which a word is hashed by a sum.
LONG_WORD = 64

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C55)
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (the splitmix64 steps); a bijection."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-dependent 64-bit hash of two 64-bit values."""
    return mix(mix(a + _BASE) * np.uint64(3) + b)


class Words:
    """Words of a block of texts.

    ``start``/``end`` are byte offsets into ``data``; document i owns words
    ``first[i]:first[i + 1]``; ``hash`` is a 64-bit value of each word's bytes.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        n = len(data)
        space = _SPACE[data]
        opens = np.empty(n + 1, dtype=bool)
        opens[0] = True
        opens[1:] = True
        if n:
            opens[1:n] = space[:-1]
            opens[bounds[bounds < n]] = True
        self.start = np.flatnonzero(~space & opens[:n])
        closes = np.empty(n, dtype=bool)
        if n:
            closes[:-1] = space[1:]
            closes[-1] = True
            inner = bounds[(bounds > 0) & (bounds < n)]
            closes[inner - 1] = True
        self.end = np.flatnonzero(~space & closes) + 1
        self.first = np.searchsorted(self.start, bounds)
        self.count = np.diff(self.first)
        self.hash = self._hashes(space)

    def _hashes(self, space: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        length = self.end - self.start
        lo, hi = self.start[0], self.end[-1]
        seg = np.diff(np.append(self.start, hi))
        offset = np.arange(lo, hi) - np.repeat(self.start, seg)
        power = np.ones(int(seg.max()) + 1, dtype=np.uint64)
        power[1:] = _BASE
        power = np.multiply.accumulate(power)
        value = self.data[lo:hi].astype(np.uint64) + np.uint64(1)
        value[space[lo:hi]] = 0
        value *= power[offset]
        total = np.add.reduceat(value, self.start - lo)
        out = mix(total + length.astype(np.uint64) * _C2)
        # sums of powers tell short words apart, but not every pair of long ones
        for k in np.flatnonzero(length > LONG_WORD):
            out[k] = int.from_bytes(blake2b(self.data[self.start[k]:self.end[k]].tobytes(), digest_size=8).digest(), "little")
        return out


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``block_bytes``: yields (first row, end row,
    bytes, document bounds).  A null text is an empty one."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    at = np.frombuffer(buffers[1], dtype=kind)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + block_bytes, side="right")) - 1)
        j = min(j, n)
        yield i, j, data[at[i]:at[j]], at[i:j + 1] - at[i]
        i = j


def segment_hash(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte segments that start at ``start`` and reach to the next one or the end."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    length = np.diff(np.append(start, len(data)))
    lo = start[0]
    offset = np.arange(lo, len(data)) - np.repeat(start, length)
    power = np.ones(int(length.max()) + 1, dtype=np.uint64)
    power[1:] = _BASE
    power = np.multiply.accumulate(power)
    value = (data[lo:].astype(np.uint64) + np.uint64(1)) * power[offset]
    return mix(np.add.reduceat(value, start - lo) + length.astype(np.uint64) * _C2)


def ragged(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices first[k], first[k] + 1, ... (length[k] of them) for each k in turn."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(length)
    return np.arange(total) - np.repeat(ends - length, length) + np.repeat(first, length)


def joined(words: Words, keep: np.ndarray) -> list[bytes]:
    """For each document its words with ``keep`` (a flag per word), joined by one space."""
    start, size = words.start[keep], (words.end - words.start)[keep] + 1
    padded = np.append(words.data, np.uint8(0x20))
    flat = padded[ragged(start, size)]
    ends = np.cumsum(size)
    flat[ends - 1] = 0x20
    raw = flat.tobytes()
    at = np.append(0, ends)[np.append(0, np.cumsum(keep))[words.first]]
    return [raw[a:b - 1] if b > a else b"" for a, b in zip(at, at[1:])]


def compress(column: pa.Array) -> pa.Array:
    """Texts as zstd frames (null: of no bytes), for shuffles of whole texts."""
    tool = zstandard.ZstdCompressor(level=3)
    return pa.array([tool.compress((t.as_buffer() or b"") if t.is_valid else b"") for t in column], pa.binary())


def compressed_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``blocks`` of a column of zstd frames; only one block is held unpacked."""
    tool = zstandard.ZstdDecompressor()
    texts, size, i = [], 0, 0
    for j, frame in enumerate(column):
        raw = frame.as_buffer()
        size += zstandard.frame_content_size(raw)
        texts.append(tool.decompress(raw))
        if size >= block_bytes or j == len(column) - 1:
            bounds = np.append(0, np.cumsum([len(t) for t in texts]))
            yield i, j + 1, np.frombuffer(b"".join(texts), np.uint8), bounds
            texts, size, i = [], 0, j + 1
