"""Substring dedup: passages that an earlier document holds are removed.

A window is ``window`` consecutive words of one document; each word covered by a
window whose words also start in a document of smaller id goes. Level-wise
doubling finds them: the levels for 13 words are windows of 4, 7 and 13 words. At
each level only windows that occur in two documents survive, and survivors alone
are extended to the next length, about twice as long, until none are left.

At a level below the last, a window of full length is represented by its least
window of the level's length (least by hash). Two equal windows have the same
least part, so no repeated window is lost, and neighbours share their parts, so few
values travel. Per slice of documents (see ``slices``) each distinct value is sent
once to the shard of its hash; the shard answers one bit a value: whether another
document has it. At the last level the value is the whole window (96 bits of hash)
with the slice's least document, and the bit says whether some document of smaller
id has it; inside the slice this is known anyway. Hot passages thus count once a
slice, and every answer is exact.

Defined cases: null and empty texts have no words and nothing to remove; rows of a
null id neither remove nor lose words; rows of one id do not remove each other's
words, and repeated rows have equal results; an empty table gives no rows; other
columns pass through ``remove_repeats`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from launchboard.llm.slices import by_shard, open_slice, shards_for, write_slices
from launchboard.llm.store import Scratch
from launchboard.llm.words import U64, Words, mix, unpack, window_hashes

WINDOW = 13
FIRST_LEVEL = 4

REQUEST = "shard int, slice long, hashes binary, flags binary, high binary, owner binary, owners binary"
REPLY = "slice long, level int, shard int, bits binary"


def levels(window: int, first: int = FIRST_LEVEL) -> list[int]:
    """Lengths from about ``first`` on, each at most twice the one before."""
    found = [window]
    while found[0] > first:
        found.insert(0, -(-found[0] // 2))
    return found


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Least of ``size`` values from each position on; the tail repeats its last."""
    span = 1
    while span < size:
        step = min(span, size - span)
        moved = np.concatenate([values[step:], values[-step:]]) if len(values) > step else values
        values = np.minimum(values, moved)
        span += step
    return values


class SliceWindows:
    """Windows of a slice and which of them survive so far."""

    def __init__(self, batch: pa.RecordBatch, window: int):
        names = batch.schema.names
        self.window = window
        self.words = w = Words(batch.column(names.index("text")))
        ids = batch.column(names.index("doc_id")).cast(pa.int64())
        known = np.asarray(ids.is_valid())
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.hashes = w.hashes()
        text = w.text_of_word()
        self.doc = self.ids[text]
        self.alive = np.flatnonzero((w.room() >= window) & known[text])

    def level_values(self, length: int) -> np.ndarray:
        """The value of each surviving window."""
        parts = window_hashes(self.hashes, length)
        return _sliding_min(parts, self.window - length + 1)[self.alive] if len(parts) else parts

    def distinct(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct values, each window's value number, and whether two documents
        of the slice share the value."""
        values = self.level_values(length)
        found, number = np.unique(values, return_inverse=True)
        least = np.full(len(found), np.iinfo(np.int64).max)
        most = np.full(len(found), np.iinfo(np.int64).min)
        doc = self.doc[self.alive]
        np.minimum.at(least, number, doc)
        np.maximum.at(most, number, doc)
        return found, number, least < most

    def whole(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct whole windows by (low, high) hash, window numbers, least owners."""
        low = window_hashes(self.hashes, self.window)[self.alive]
        high = (window_hashes(self.hashes, self.window, 1)[self.alive] >> U64(32)).astype(np.uint32)
        # the two hashes of a window are combined for numbering inside the slice only
        _, first, number = np.unique(mix(low) + high.astype(U64), return_index=True, return_inverse=True)
        owner = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(owner, number, self.doc[self.alive])
        return low[first], high[first], number, owner

    def keep(self, found: np.ndarray, number: np.ndarray, shards: int, bits: dict[int, bytes]) -> None:
        self.alive = self.alive[self.answers(found, shards, bits)[number]] if len(found) else self.alive

    @staticmethod
    def answers(found: np.ndarray, shards: int, bits: dict[int, bytes]) -> np.ndarray:
        good = np.zeros(len(found), dtype=bool)
        for shard, at in by_shard(found, shards):
            good[at] = np.unpackbits(unpack(bits[shard], np.uint8), count=len(at)).astype(bool)
        return good


def _replayed(row_slice: pa.RecordBatch, replies: list[dict], shards: int, window: int) -> SliceWindows:
    """The slice after all levels below the last that have answers."""
    state = SliceWindows(row_slice, window)
    bits: dict[int, dict[int, bytes]] = {}
    for r in replies or []:
        bits.setdefault(r["level"], {})[r["shard"]] = r["bits"]
    state.bits = bits
    for length in levels(window)[:-1]:
        if length in bits:
            found, number, _ = state.distinct(length)
            state.keep(found, number, shards, bits[length])
    return state


def _requests(length: int, shards: int, window: int):
    done = [n for n in levels(window) if n < length]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                if done and not row["replies"]:
                    continue  # nothing of the slice survives
                state = _replayed(open_slice(row["payload"]), [
                    r for r in row["replies"] or [] if r["level"] in done], shards, window)
                if done and done[-1] not in state.bits or not len(state.alive):
                    continue
                out = []
                if length < window:
                    found, _, shared = state.distinct(length)
                    for shard, at in by_shard(found, shards):
                        out.append((shard, row["slice"], found[at].tobytes(),
                                    np.packbits(shared[at]).tobytes(), None, None, None))
                else:
                    low, high, _, owner = state.whole()
                    for shard, at in by_shard(low, shards):
                        owners, mine = np.unique(owner[at], return_inverse=True)
                        out.append((shard, row["slice"], low[at].tobytes(), None, high[at].tobytes(),
                                    mine.astype(np.uint32).tobytes(), owners.tobytes()))
                kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 5)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)],
                    ["shard", "slice", "hashes", "flags", "high", "owner", "owners"])
    return run


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one at a time: payloads are megabytes."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _shard_replies(length: int, window: int):
    """Answers of one shard to all slices, one bit a value."""
    def run(table: pa.Table) -> pa.Table:
        hashes = [unpack(x, np.uint64) for x in table["hashes"].to_pylist()]
        cuts = np.cumsum([0, *map(len, hashes)])
        low = np.concatenate(hashes)
        if length < window:
            _, number, count = np.unique(low, return_inverse=True, return_counts=True)
            good = count >= 2
            flags = np.concatenate([np.unpackbits(unpack(f, np.uint8), count=len(h))
                                    for f, h in zip(table["flags"].to_pylist(), hashes)])
            good[number[flags > 0]] = True
            good = good[number]
        else:
            high = np.concatenate([unpack(x, np.uint32) for x in table["high"].to_pylist()])
            owner = np.concatenate([unpack(ids, np.int64)[unpack(at, np.uint32)] for ids, at in zip(
                table["owners"].to_pylist(), table["owner"].to_pylist())])
            order = np.lexsort((owner, high, low))
            new = np.r_[True, (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])]
            least = owner[order][new][np.cumsum(new) - 1]
            good = np.empty(len(low), dtype=bool)
            good[order] = least < owner[order]
        shard = table["shard"][0].as_py()
        return pa.table({
            "slice": table["slice"], "level": pa.array([length] * len(hashes), pa.int32()),
            "shard": pa.array([shard] * len(hashes), pa.int32()),
            "bits": pa.array([np.packbits(good[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})
    return run


def _removed(state: SliceWindows, shards: int) -> np.ndarray:
    """Which words of the slice go."""
    gone = np.zeros(len(state.words) + 1, dtype=np.int64)
    if state.window in state.bits and len(state.alive):
        low, _, number, owner = state.whole()
        elsewhere = state.answers(low, shards, state.bits[state.window])
        repeated = state.alive[elsewhere[number] | (owner[number] < state.doc[state.alive])]
        gone[repeated] += 1
        gone[repeated + state.window] -= 1
    return np.cumsum(gone)[:-1] > 0


def join_words(words: Words, keep: np.ndarray) -> pa.Array:
    """Each text's kept words joined by one space."""
    n = len(words.counts)
    at = np.flatnonzero(keep)
    text = words.text_of_word()[at]
    size = (words.ends - words.starts)[at]
    last = np.r_[text[1:] != text[:-1], True] if len(at) else np.zeros(0, bool)
    room = size + ~last
    out = np.full(int(room.sum()), 32, dtype=np.uint8)
    ends = np.cumsum(room)
    body = np.ones(len(out), dtype=bool)
    body[ends[~last] - 1] = False
    kept_bytes = np.repeat(keep, words.ends - words.starts)
    out[body] = words.data[~words.space][kept_bytes]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(text, room, n))]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.string())


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` replaced by its kept words, and a last column
    ``__repeats`` (n_words, n_removed). Needs an integer ``doc_id``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    slices = write_slices(docs, scratch)
    shards = shards_for(slices)
    empty = T._parse_datatype_string("array<struct<level:int,shard:int,bits:binary>>")
    joined = slices.withColumn("replies", F.lit(None).cast(empty))
    replies = None
    for length in levels(window):
        asked = joined.mapInArrow(_requests(length, shards, window), REQUEST)
        answers = asked.groupBy("shard").applyInArrow(_shard_replies(length, window), REPLY)
        written = scratch.keep(answers, f"replies-{length}")
        replies = written if replies is None else replies.unionByName(written)
        scratch.release()
        per_slice = replies.groupBy("slice").agg(
            F.collect_list(F.struct("level", "shard", "bits")).alias("replies"))
        joined = slices.join(per_slice, "slice", "left")

    schema = T.StructType([*docs.schema.fields])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                rows = open_slice(row["payload"])
                state = _replayed(rows, row["replies"], shards, window)
                gone = _removed(state, shards)
                counts = state.words.counts.astype(np.int64)
                text = state.words.text_of_word()
                removed = np.bincount(text, gone, len(counts)).astype(np.int64)
                columns = list(rows.columns)
                columns[rows.schema.names.index("text")] = join_words(state.words, ~gone)
                columns.append(pa.StructArray.from_arrays(
                    [pa.array(counts), pa.array(removed)], ["n_words", "n_removed"]))
                yield pa.RecordBatch.from_arrays(columns, [*rows.schema.names, "__repeats"])

    schema.add("__repeats", T._parse_datatype_string("struct<n_words:long,n_removed:long>"))
    return joined.select("payload", "replies").mapInArrow(finish, schema)
