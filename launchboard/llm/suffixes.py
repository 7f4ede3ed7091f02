"""Suffix-array dedup: bytes covered by a string of ``window`` bytes that starts anywhere
else as well are removed.

Suffixes are sorted to a depth of ``window`` bytes, blockwise, with the help of a
difference cover: offsets D below a period v such that any two positions i and j have a
d < v for which i + d and j + d are both at offsets of D (modulo v, counted from their
texts' starts). Nothing is sorted as a whole:

1. Cover sample. Only suffixes at offsets of D, about a tenth, are ranked first, to
   a depth of window - v + 1 bytes. Hash buckets are sorted one at a time; a sample's
   rank is its bucket and its place there. The answer to a slice of documents is whether
   the rank is its own, shared at the same offset of D only, or at others too.
2. Stretches. Samples of shared rank are compared once more at window + v bytes. Where
   such a stretch repeats, all its bytes go, so that copies cost one comparison a period
   and only their ends are left: windows that stretches do not wholly cover are open.
3. Wanted ranks. An open window reaches samples of shared rank in under v bytes, or it
   is no copy. A rank that an open window reaches anywhere is wanted.
   With it goes how many bytes before the sample such windows start.
4. Suffixes. Suffixes that reach a sample of wanted rank from as far before it, open or
   not, are compared over the whole window. All others are told apart by ranks alone.
   Equal windows both take part: of the pair's d the cover has both samples, these have
   one rank, and it is wanted if either window is open. Where a rank is shared at like
   offsets only, the first sample reached is enough.

A slice sends each distinct value once however often it holds it, and gets a byte or a
bit back; a task holds one bucket of a bounded part of the hash space. Ranks are compared
by 32 bits in their bucket, as a filter; stretches and suffixes by 64 bits of a second
hash in the bucket that the first one gives.

Defined cases: null and empty texts have no bytes; ids do not matter (rows of one id, or
of none, are texts like others); rows that repeat remove each other's bytes; texts
shorter than the window stay; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from launchboard.llm.slices import open_slice, shards_for, write_slices
from launchboard.llm.store import Scratch
from launchboard.llm.words import U64, mix

WINDOW = 200

# Perfect difference sets (every difference modulo the period occurs once)
COVERS = {
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81),
}

RANKS, STRETCHES, WANTED, SUFFIXES = 1, 2, 3, 4
#: Answers to a sample: its rank is its own, shared at its offset, or at other offsets too.
OWN, ALIGNED, SHIFTED = 0, 1, 2

REQUEST = "shard int, slice long, hashes binary, marks binary"
REPLY = "slice long, level int, shard int, body binary"

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: Places whose powers are kept; those of later ones are products of two.
_CHUNK = 1 << 16


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` below ``_CHUNK``, and those at the multiples of it up to ``n``."""
    def table(factor: int, size: int) -> np.ndarray:
        return np.cumprod(np.r_[U64(1), np.full(size - 1, factor, dtype=U64)], dtype=U64)
    return table(base, _CHUNK), table(pow(base, _CHUNK, 1 << 64), n // _CHUNK + 1)


class SubstringHashes:
    """64-bit hashes of any substrings of a byte string, from sums of its prefixes.
    The sums are all that is kept of a position; the rest is worked out in chunks."""

    def __init__(self, data: np.ndarray, base: int):
        codes = mix(np.arange(1, 257, dtype=U64) * U64(base))
        low, high = _powers(base, len(data))
        self.sums = np.zeros(len(data) + 1, dtype=U64)
        for lo in range(0, len(data), _CHUNK):
            code = codes[data[lo:lo + _CHUNK]]
            sums = np.cumsum(code * low[:len(code)], dtype=U64) * high[lo // _CHUNK]
            self.sums[lo + 1:lo + len(code) + 1] = sums + self.sums[lo]
        self.low, self.high = _powers(pow(base, -1, 1 << 64), len(data))

    def of(self, start: np.ndarray, length: int) -> np.ndarray:
        out = np.empty(len(start), dtype=U64)
        for lo in range(0, len(start), _CHUNK):
            at = start[lo:lo + _CHUNK]
            back = self.low[at % _CHUNK] * self.high[at // _CHUNK]
            out[lo:lo + len(at)] = mix((self.sums[at + length] - self.sums[at]) * back)
        return out


def cover_for(window: int) -> tuple[int, np.ndarray]:
    fits = [v for v in COVERS if 2 * v <= window]
    if not fits:
        raise ValueError(f"a window has at least {2 * min(COVERS)} bytes")
    return max(fits), np.array(COVERS[max(fits)])


class SliceSuffixes:
    """Suffixes of a slice's texts, and what is known of them so far."""

    def __init__(self, batch: pa.RecordBatch, window: int):
        column = batch.column(batch.schema.get_field_index("text"))
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        self.data, self.offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        self.window, (self.period, self.cover) = window, cover_for(window)
        self.depth, self.stretch = window - self.period + 1, window + self.period
        self.first_hash = SubstringHashes(self.data, _BASES[0])
        self._sample()
        self.ranks = Distinct((self.first_hash.of(self.samples, self.depth) & ~U64(15)) | self.offset.astype(U64))
        self.covered = np.zeros(len(self.data), dtype=bool)

    @cached_property
    def second_hash(self) -> SubstringHashes:
        return SubstringHashes(self.data, _BASES[1])

    def _sample(self) -> None:
        """Samples: their positions and offsets of D, and their texts' bounds."""
        start, end = self.offsets[:-1], self.offsets[1:]
        last = end - start - self.depth  # place of a text's last sample, at most
        periods = np.maximum(last // self.period + 1, 0)
        text = np.repeat(np.arange(len(start)), periods)
        turn = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods)
        place = (turn[:, None] * self.period + self.cover).ravel()
        text, offset = np.repeat(text, len(self.cover)), np.tile(np.arange(len(self.cover)), len(turn))
        good = place <= last[text]
        text, self.offset = text[good], offset[good]
        self.begin, self.end = start[text], end[text]
        self.samples = self.begin + place[good]

    def rank_marks(self) -> np.ndarray:
        """Offset of each distinct rank, and whether the slice has it several times there."""
        return (self.offset[self.ranks.first] * 2 + self.ranks.several).astype(np.uint8)

    def learn_ranks(self, kinds: np.ndarray) -> None:
        """``kinds``: the answer to each distinct rank."""
        self.kinds, self.kind = kinds, kinds[self.ranks.number]

    def stretches(self) -> tuple[np.ndarray, Distinct]:
        """Samples whose stretches are compared."""
        aligned = (self.kind == ALIGNED) & (self.offset == 0)
        some = (aligned | (self.kind == SHIFTED)) & (self.samples + self.stretch <= self.end)
        at = self.samples[some]
        return at, Distinct(self.first_hash.of(at, self.stretch))

    def cover_runs(self, start: np.ndarray, length: int) -> None:
        change = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.add.at(change, start, 1)
        np.add.at(change, start + length, -1)
        self.covered |= np.cumsum(change, dtype=np.int32)[:-1] > 0

    def _reaching(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last position of the suffixes that reach each sample: those in under
        a period, or, where the first sample is enough, those behind the sample before."""
        before = np.r_[-1, self.samples[:-1]]
        lo = np.where(self.kind == ALIGNED, before + 1, self.samples - self.period + 1)
        return np.maximum(lo, self.begin), np.minimum(self.samples, self.end - self.window)

    def wanted(self) -> tuple[np.ndarray, np.ndarray]:
        """For each distinct rank, the least and the greatest distance from which an open
        window of the slice reaches it; (255, 0) for none."""
        bare = np.cumsum(np.r_[np.int32(0), ~self.covered], dtype=np.int32)
        opened = np.flatnonzero(bare[self.window:] > bare[:max(len(bare) - self.window, 0)]).astype(np.int32)
        lo, hi = self._reaching()
        some = np.flatnonzero((lo <= hi) & (self.kind != OWN))
        first, last = np.searchsorted(opened, lo[some]), np.searchsorted(opened, hi[some], side="right") - 1
        some, first, last = (x[first <= last] for x in (some, first, last))
        least = np.full(len(self.ranks), 255, dtype=np.uint8)
        most = np.zeros(len(self.ranks), dtype=np.uint8)
        np.minimum.at(least, self.ranks.number[some], (self.samples[some] - opened[last]).astype(np.uint8))
        np.maximum.at(most, self.ranks.number[some], (self.samples[some] - opened[first]).astype(np.uint8))
        return least, most

    def suffixes(self, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, Distinct]:
        """Suffixes to compare, given the distances from which each distinct rank is wanted."""
        lo, hi = self._reaching()
        number = self.ranks.number
        lo = np.maximum(lo, self.samples - most[number])
        hi = np.minimum(hi, self.samples - least[number])
        some = (lo <= hi) & (self.kind != OWN)
        change = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.add.at(change, lo[some], 1)
        np.add.at(change, hi[some] + 1, -1)
        at = np.flatnonzero(np.cumsum(change, dtype=np.int32)[:-1]).astype(np.int32)
        return at, Distinct(self.first_hash.of(at, self.window))


class Distinct:
    """Distinct ones of some 64-bit values, in order. Shards are ranges of the values."""

    def __init__(self, values: np.ndarray):
        # numbers of 32 bits: a slice's values are fewer
        order = np.argsort(values, kind="stable").astype(np.int32)
        ordered = values[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]][:len(order)]
        self.values, self.first = ordered[new], order[new]
        del ordered
        #: which distinct value each value is
        self.number = np.empty(len(order), dtype=np.int32)
        self.number[order] = np.cumsum(new, dtype=np.int32) - 1
        head = np.flatnonzero(new)
        self.several = np.diff(np.r_[head, len(order)]) > 1

    def __len__(self) -> int:
        return len(self.values)

    def shards(self, shards: int, chosen: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, which distinct values) of all or of the chosen ones."""
        which = np.arange(len(self)) if chosen is None else chosen
        shard = ((self.values[which] >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)
        ids, first = np.unique(shard, return_index=True)
        for k, lo, hi in zip(ids.tolist(), first, [*first[1:], len(which)]):
            yield k, which[lo:hi]


def _state(row: dict, window: int, shards: int, level: int) -> tuple[SliceSuffixes, tuple]:
    """A slice as it is before a level, and what the level compares: ``suffixes()`` and such."""
    state = SliceSuffixes(open_slice(row["payload"]), window)
    bodies: dict[int, dict[int, bytes]] = {}
    for r in row["replies"] or []:
        bodies.setdefault(r["level"], {})[r["shard"]] = r["body"]

    def answers(at_level: int, asked: Distinct, chosen: np.ndarray | None = None) -> np.ndarray:
        out = np.zeros((len(asked), 2 if at_level == WANTED else 1), dtype=np.uint8)
        for shard, at in asked.shards(shards, chosen):
            body = np.frombuffer(bodies[at_level][shard], np.uint8)
            out[at] = (np.unpackbits(body, count=len(at)) if at_level in (STRETCHES, SUFFIXES) else body).reshape(len(at), -1)
        return out

    if level == RANKS:
        return state, ()
    state.learn_ranks(answers(RANKS, state.ranks)[:, 0])
    found = state.stretches()
    if level == STRETCHES:
        return state, found
    at, asked = found
    state.cover_runs(at[answers(STRETCHES, asked)[asked.number, 0] > 0], state.stretch)
    shared = np.flatnonzero(state.kinds != OWN)
    if level == WANTED:
        return state, (shared,)
    least, most = np.full(len(state.ranks), 255, np.uint8), np.zeros(len(state.ranks), np.uint8)
    least[shared], most[shared] = answers(WANTED, state.ranks, shared)[shared].T
    found = state.suffixes(least, most)
    if level == SUFFIXES:
        return state, found
    at, asked = found
    state.cover_runs(at[answers(SUFFIXES, asked)[asked.number, 0] > 0], state.window)
    return state, ()


def _requests(level: int, shards: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                state, found = _state(row, window, shards, level)
                if level in (RANKS, WANTED):
                    asked, chosen = state.ranks, found[0] if found else None
                    values = (asked.values >> U64(4)).astype(np.uint32)
                    marks = state.rank_marks() if level == RANKS else np.stack(state.wanted(), 1)
                else:
                    (at, asked), chosen = found, None
                    values = state.second_hash.of(at[asked.first], state.stretch if level == STRETCHES else window)
                    marks = asked.several
                out = [(shard, row["slice"], values[at].tobytes(),
                        (np.packbits(marks[at]) if marks.dtype == bool else marks[at]).tobytes())
                       for shard, at in asked.shards(shards, chosen)]
                if out:
                    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], ["shard", "slice", "hashes", "marks"])
    return run


def _bucket(level: int):
    """Sort one bucket and answer the slices that have suffixes in it."""
    kind = np.uint32 if level in (RANKS, WANTED) else np.uint64

    def run(table: pa.Table) -> pa.Table:
        values = [np.frombuffer(x, kind) for x in table["hashes"].to_pylist()]
        marks = [np.frombuffer(x, np.uint8) for x in table["marks"].to_pylist()]
        value, cuts = np.concatenate(values), np.cumsum([0, *map(len, values)])
        order = np.argsort(value, kind="stable")
        ordered = value[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]]
        head = np.flatnonzero(new)
        several = np.diff(np.r_[head, len(order)]) > 1
        if level == RANKS:
            mark = np.concatenate(marks)[order]
            found = np.where(several | (np.maximum.reduceat(mark & 1, head) > 0), ALIGNED, OWN)
            found[np.minimum.reduceat(mark >> 1, head) < np.maximum.reduceat(mark >> 1, head)] = SHIFTED
        elif level == WANTED:
            mark = np.concatenate(marks).reshape(-1, 2)[order]
            found = np.stack([np.minimum.reduceat(mark[:, 0], head), np.maximum.reduceat(mark[:, 1], head)], 1)
        else:
            mark = np.concatenate([np.unpackbits(m, count=len(v)) for m, v in zip(marks, values)])[order]
            found = several | (np.maximum.reduceat(mark, head) > 0)
        answer = np.empty((len(order), *found.shape[1:]), dtype=found.dtype)
        answer[order] = found[np.cumsum(new) - 1]
        parts = [np.packbits(answer[a:b]) if found.dtype == bool else answer[a:b].astype(np.uint8)
                 for a, b in zip(cuts, cuts[1:])]
        return pa.table({"slice": table["slice"], "level": pa.array([level] * len(parts), pa.int32()),
                         "shard": table["shard"], "body": pa.array([p.tobytes() for p in parts], pa.binary())})
    return run


def _kept(state: SliceSuffixes) -> tuple[pa.Array, pa.Array]:
    """Each text's bytes that stay, and the spans removed from it."""
    gone, n = state.covered, len(state.offsets) - 1
    inside = np.cumsum(np.r_[0, ~gone])[state.offsets]
    kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [
        None, pa.py_buffer(inside.astype(np.int64)), pa.py_buffer(state.data[~gone])]).cast(pa.binary())
    bounds = np.zeros(len(gone) + 1, dtype=bool)  # where a text starts
    bounds[state.offsets] = True
    before = np.r_[False, gone][:-1] if len(gone) else gone
    after = np.r_[gone[1:], False] if len(gone) else gone
    start = np.flatnonzero(gone & (~before | bounds[:-1]))
    end = np.flatnonzero(gone & (~after | bounds[1:])) + 1
    text = np.searchsorted(state.offsets, start, side="right") - 1
    lists = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    spans = pa.StructArray.from_arrays(
        [pa.array(x - state.offsets[text], pa.int64()) for x in (start, end)], ["start", "end"])
    return kept, pa.ListArray.from_arrays(pa.array(lists), spans)


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the column ``text`` kept as it is and a last column ``__suffixes``:
    (n_bytes, n_removed, spans of removed bytes as (start, end), kept bytes)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffixes")
    slices = write_slices(docs, scratch)
    shards = shards_for(slices)
    asked = slices.withColumn("replies", F.lit(None).cast("array<struct<level:int,shard:int,body:binary>>"))
    replies = None
    for level in (RANKS, STRETCHES, WANTED, SUFFIXES):
        questions = asked.mapInArrow(_requests(level, shards, window), REQUEST)
        written = scratch.keep(questions.repartition(shards, "shard").groupBy("shard").applyInArrow(
            _bucket(level), REPLY), f"replies-{level}")
        replies = written if replies is None else replies.unionByName(written)
        scratch.release()
        per_slice = replies.groupBy("slice").agg(
            F.collect_list(F.struct("level", "shard", "body")).alias("replies"))
        asked = slices.join(per_slice, "slice", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                rows = open_slice(row["payload"])
                state, _ = _state(row, window, shards, SUFFIXES + 1)
                kept, spans = _kept(state)
                size = np.diff(state.offsets)
                removed = size - pc.binary_length(kept).to_numpy(zero_copy_only=False)
                found = pa.StructArray.from_arrays(
                    [pa.array(size), pa.array(removed, pa.int64()), spans, kept],
                    ["n_bytes", "n_removed", "spans", "kept"])
                yield pa.RecordBatch.from_arrays([*rows.columns, found], [*rows.schema.names, "__suffixes"])

    schema = T.StructType([*docs.schema.fields]).add("__suffixes", T._parse_datatype_string(
        "struct<n_bytes:long,n_removed:long,spans:array<struct<start:long,end:long>>,kept:binary>"))
    return asked.select("payload", "replies").mapInArrow(finish, schema)
