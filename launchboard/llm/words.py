"""Vectorised words of UTF-8 texts: bounds, 64-bit hashes and window hashes.

A word is a run of bytes outside 0x20 and 0x09-0x0D. These are ASCII, so byte
runs equal character runs. Texts are never cut: a block holds whole texts, and a
text larger than the block size is a block of its own. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20
HASH_WORDS = 1 << 16

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)  # odd, so powers never vanish
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


_BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * _BASE)
_powers = np.ones(1, dtype=U64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        n = max(n, 2 * len(_powers))
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([[U64(1)], np.full(n - 1, _BASE)]), dtype=U64)
    return _powers


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into row ranges of about ``max_bytes`` of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        # rows count a little too, so that empty texts do not pile up
        block = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64) + 64) // max_bytes
        cuts = np.flatnonzero(np.diff(block)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(lo, hi - lo)


class Words:
    """Word bounds of a column of texts."""

    def __init__(self, column: pa.Array, lower: bool = False):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
        offsets = offsets[column.offset:column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
        data = data[offsets[0]:offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.data = _LOWER[data] if lower else data
        self.space = self.separators(data)
        n, edges = len(data), self.offsets
        before = np.ones(n, dtype=bool)
        before[1:] = self.space[:-1]
        before[edges[:-1][edges[:-1] < n]] = True
        after = np.ones(n, dtype=bool)
        after[:-1] = self.space[1:]
        after[edges[1:][edges[1:] > 0] - 1] = True
        self.starts = np.flatnonzero(before & ~self.space)
        self.ends = np.flatnonzero(after & ~self.space) + 1
        #: words of text i are first[i]:first[i + 1]
        self.first = np.searchsorted(self.starts, edges)
        self.counts = np.diff(self.first)

    @staticmethod
    def separators(data: np.ndarray) -> np.ndarray:
        """Which bytes are no part of a word."""
        return _SPACE[data]

    def __len__(self) -> int:
        return len(self.starts)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def room(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self))

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self), dtype=U64)
        # in chunks, as every byte takes several numbers meanwhile
        for lo in range(0, len(self), HASH_WORDS):
            starts, ends = self.starts[lo:lo + HASH_WORDS], self.ends[lo:lo + HASH_WORDS]
            size = ends - starts
            first = np.cumsum(size) - size
            at = np.arange(size.sum()) - np.repeat(first, size)
            span = slice(starts[0], ends[-1])
            code = _BYTE_CODE[self.data[span][~self.space[span]]]
            code *= _power_table(int(size.max()))[at]
            out[lo:lo + HASH_WORDS] = mix(np.add.reduceat(code, first) ^ size.astype(U64))
        return out


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``size`` words from each position on, by doubling. Positions
    near the end wrap to zero words: the caller masks them with ``room()``."""
    if size == 1:
        return mix(words + U64(seed))
    half = size - size // 2
    part = window_hashes(words, half, seed)
    right = np.zeros_like(part)
    right[:len(part) - size // 2] = part[size // 2:]
    return mix(part * _BASE + right + U64(size))


def pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def unpack(value: bytes, dtype) -> np.ndarray:
    return np.frombuffer(value, dtype=dtype)
