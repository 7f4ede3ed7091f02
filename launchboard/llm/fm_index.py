"""A bidirectional FM-index over integer symbols, as arrays.

The rows of an index are the positions of a text, sorted by the ``DEPTH`` symbols from
there on; its Burrows-Wheeler transform holds the symbol before each row's position. A
pattern of at most ``DEPTH`` symbols is an interval of rows: of the text's index, and,
reversed, of the reversed text's. Symbol 0 separates and is in no pattern. Extending
patterns by one symbol on either side takes all patterns of a level in one go: the
rows of their intervals are grouped by the symbol that the transform holds, the new
interval starts where the last-to-first mapping sends the group's first row, and the
other index's interval is cut in the symbols' order. Patterns are extended some rows at a
time, and rows are 32-bit numbers, so that an index takes a few times its own bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

DEPTH = 4
#: Rows of intervals that are grouped at once, and rows looked up at once.
CHUNK_ROWS = 1 << 17


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


def sorted_order(keys: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``keys`` (64-bit, 0 to ``top``; used up) in stable order, and the keys in
    order. Key and position are sorted as one number where they fit: several times as fast."""
    place = max(len(keys) - 1, 1).bit_length()
    if max(top, 1).bit_length() + place > 63:
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    keys <<= place
    keys |= np.arange(len(keys))
    keys.sort()
    order = keys & ((1 << place) - 1)
    keys >>= place
    return order, keys


def transform(text: np.ndarray) -> np.ndarray:
    """Burrows-Wheeler transform of a text that begins and ends with 0, its rows sorted
    by ``DEPTH`` symbols: by pairs, then by pairs of pairs."""
    rank, span = text.astype(np.int32), 1
    while span < DEPTH:
        kinds = int(rank.max()) + 1
        both = rank * np.int64(kinds)
        both += np.roll(rank, -span)
        order, key = sorted_order(both, kinds * kinds)
        rank[order] = np.cumsum(np.r_[False, key[1:] != key[:-1]], dtype=np.int32)
        span *= 2
    return text[order - 1]


@dataclass
class Patterns:
    """Patterns of one length: their intervals in both indexes, one size for both, and
    a number of the caller's for each."""

    low: np.ndarray
    reverse_low: np.ndarray
    size: np.ndarray
    number: np.ndarray

    def take(self, at: np.ndarray) -> Patterns:
        return Patterns(self.low[at], self.reverse_low[at], self.size[at], self.number[at])


class FMIndex:
    def __init__(self, forward: np.ndarray, backward: np.ndarray):
        self.bwt = {"left": forward, "right": backward}
        self.first_row: dict[str, np.ndarray] = {}

    @classmethod
    def of(cls, text: np.ndarray) -> FMIndex:
        return cls(transform(text), transform(text[::-1]))

    def pack(self) -> bytes:
        both = np.concatenate([self.bwt["left"], self.bwt["right"]]).astype(np.int32)
        # the bytes of like weight together compress better
        return len(both).to_bytes(8, "little") + pa.compress(
            both.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)

    @classmethod
    def unpack(cls, body: bytes) -> FMIndex:
        n = int.from_bytes(body[:8], "little")
        lanes = np.frombuffer(pa.decompress(body[8:], 4 * n, codec="zstd", asbytes=True), np.uint8)
        both = np.ascontiguousarray(lanes.reshape(4, n).T).view(np.int32)[:, 0]
        return cls(both[:n // 2], both[n // 2:])

    def symbols(self, numbers: np.ndarray) -> Patterns:
        """The single symbols 1, 2, ... with their numbers."""
        count = np.bincount(self.bwt["left"], minlength=len(numbers) + 1)
        low = (np.cumsum(count) - count).astype(np.int32)
        return Patterns(low[1:], low[1:], count[1:].astype(np.int32), numbers)

    def _last_to_first(self, side: str) -> np.ndarray:
        if side not in self.first_row:
            bwt = self.bwt[side]
            to = np.empty(len(bwt), dtype=np.int32)
            to[sorted_order(bwt.astype(np.int64), int(bwt.max(initial=0)))[0]] = np.arange(len(to), dtype=np.int32)
            self.first_row[side] = to
        return self.first_row[side]

    def extend(self, patterns: Patterns, side: str) -> tuple[Patterns, np.ndarray]:
        """All extensions that occur by one symbol on the ``left`` or ``right``, with the
        position of the pattern each one extends."""
        self._last_to_first(side)
        kinds = int(self.bwt[side].max(initial=0)) + 1
        # whole patterns, in their order
        cuts = np.flatnonzero(np.diff(np.cumsum(patterns.size, dtype=np.int64) // CHUNK_ROWS)) + 1
        parts = [self._extend(patterns, slice(lo, hi), side, kinds)
                 for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(patterns.size)])]
        low, other, size, source = (np.concatenate(x) for x in zip(*parts))
        pair = (low, other) if side == "left" else (other, low)
        return Patterns(*pair, size, np.full(len(size), -1)), source

    def _extend(self, patterns: Patterns, part: slice, side: str, kinds: int) -> tuple[np.ndarray, ...]:
        bwt, to = self.bwt[side], self._last_to_first(side)
        low, other, sizes = patterns.low[part], patterns.reverse_low[part], patterns.size[part]
        if side == "right":
            low, other = other, low
        rows = _ranges(low, sizes)
        of = np.repeat(np.arange(len(low)), sizes)
        order, key = sorted_order(of * kinds + bwt[rows], len(low) * kinds)
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(order)])
        size = np.diff(np.r_[cut, len(order)])
        head = order[cut]
        source = of[head]
        start = np.cumsum(sizes, dtype=np.int64) - sizes
        # rows of the pattern with smaller symbols lie before the new interval in the other index
        new_other = other[source] + cut - start[source]
        real = np.flatnonzero(bwt[rows[head]])
        return (to[rows[head[real]]], *(x[real].astype(np.int32) for x in (new_other, size)),
                (source[real] + part.start).astype(np.int32))


def containing(low: np.ndarray, size: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which of the disjoint intervals each row lies in; -1 for none."""
    order = np.argsort(low)
    found = np.full(len(row), -1, dtype=np.int32)
    if not len(order):
        return found
    first = low[order]
    end = first + size[order]
    for lo in range(0, len(row), CHUNK_ROWS):
        part = row[lo:lo + CHUNK_ROWS]
        at = np.searchsorted(first, part, side="right") - 1
        found[lo:lo + CHUNK_ROWS] = np.where((at >= 0) & (part < end[at]), order[at], -1)
    return found
