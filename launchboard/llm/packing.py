"""Best-fit packing of token pieces into sequences by minimum bin slack.

``pieces`` tokenizes texts, closes each with an end token and cuts only documents
longer than a sequence. ``plan_bins`` decides bin contents from the histogram of
piece lengths alone: for one bin it finds, by a subset-sum dynamic programme over
bitsets, the fullest feasible combination of the available lengths, and removes
that combination as often as the counts allow. The histogram has at most as many
rows as a sequence has tokens, whatever the input, so the plan is made on the
driver. ``pack`` then places every piece: pieces of a length are numbered across
tasks (per task counts and their running sums), and a number falls into one of
the plan's intervals, which gives the sequence and the offset. Pieces join their
starting numbers by task and length, so no length's pieces meet in one task.

Defined cases: null and empty texts are one piece that holds the end token;
repeated rows are packed each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from launchboard.llm.store import Scratch
from launchboard.llm.words import Words, blocks

SEQUENCE_TOKENS = 4096
#: Text that a task holds at a time.
BLOCK = 2 << 20
END_ID = 1

#: Entries of a worker's table of encoded units; a full table starts anew.
UNIT_CACHE = 2_000_000

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in ".,;:!?"]] = True


class Units(Words):
    """Words, cut once more where a letter is followed by a punctuation mark."""

    def __init__(self, column: pa.Array, lower: bool):
        super().__init__(column, lower=lower)
        at = np.flatnonzero(_LETTER[self.data[:-1]] & _MARK[self.data[1:]]) + 1
        for name in ("starts", "ends"):
            marked = np.zeros(len(self.data) + 1, dtype=bool)
            marked[getattr(self, name)] = True
            marked[at] = True
            setattr(self, name, np.flatnonzero(marked))
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)


def _texts(units: Words, which: np.ndarray) -> list[str]:
    data = units.data.tobytes()
    return [data[s:e].decode() for s, e in zip(units.starts[which].tolist(), units.ends[which].tolist())]


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each range in turn."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


class WordEncoder:
    """Token ids of a block of texts; lives in a worker.

    For tokenizers that drop white space, a text's ids are those of its words in a
    row, and for those that keep letters and punctuation apart, those of its units, so
    each distinct unit is encoded once and kept, by its 64-bit hash, in a bounded table.
    Texts with the markup of special tokens go to the library whole.
    """

    _by_path: dict = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self._forget()
        raw = lambda text: self._raw([text])[0]
        self.by_word = raw("a") + raw("b.") == raw(" a \n\tb.  ")
        cuts = (("ab", ",."), ("Ab", ".b"), ("x", "!"), ("a", ";'s"), ("b", "?1"), ("c", ":-"))
        self.units = Units if all(raw(a) + raw(b) == raw(a + b) for a, b in cuts) else Words
        letters = [chr(c) for c in range(65, 91)]
        self.lower = self._raw(letters) == self._raw([x.lower() for x in letters])

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def _forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)  # in order, with each one's place in ``flat``
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, dtype="<u4")

    def _raw(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        """Encode units that the table lacks; ``keys`` in order."""
        ids = self._raw(texts)
        size = np.array([len(x) for x in ids], dtype=np.int64)
        start = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), "<u4", int(size.sum()))])
        at = np.searchsorted(self.keys, keys)
        self.start, self.size = np.insert(self.start, at, start), np.insert(self.size, at, size)
        self.keys = np.insert(self.keys, at, keys)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each)."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring(texts, "<|") if self.by_word else pc.greater_equal(pc.binary_length(texts), 0)
        units = self.units(pc.if_else(whole, "", texts), self.lower)
        hashes, first, number = np.unique(units.hashes(), return_index=True, return_inverse=True)
        if len(self.keys) > UNIT_CACHE:
            self._forget()
        at = np.searchsorted(self.keys, hashes)
        new = np.ones(len(hashes), dtype=bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != hashes[inside]
        if new.any():
            self._learn(hashes[new], _texts(units, first[new]))
            at = np.searchsorted(self.keys, hashes)
        size = self.size[at][number]
        ids = self.flat[_ranges(self.start[at][number], size)]
        ends = np.r_[0, np.cumsum(size)][units.first]
        counts = np.diff(ends)
        some = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if len(some):
            raw = self._raw([texts[i].as_py() for i in some.tolist()])
            parts = np.split(ids, ends[1:-1])
            for i, found in zip(some.tolist(), raw):
                parts[i] = np.array(found, dtype="<u4")
                counts[i] = len(found)
            ids = np.concatenate(parts)
        return ids, counts


PIECE_SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
                "ids binary")


def _cut(path: str, sequence: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(path)
        for block in blocks(batches, "text", BLOCK):
            ids, counts = encoder.encode(block.column(1))
            first = np.cumsum(counts + 1) - counts - 1
            closed = np.full(len(ids) + len(counts), end_id, dtype="<u4")
            closed[_ranges(first, counts)] = ids
            # pieces of each text, and of each its number and bounds
            many = -(-(counts + 1) // sequence)
            text = np.repeat(np.arange(len(counts)), many)
            piece = _ranges(np.zeros(len(counts), np.int64), many)
            start = piece * sequence
            length = np.minimum(counts[text] + 1 - start, sequence)
            raw, at = memoryview(closed.tobytes()), 4 * (first[text] + start)
            parts = [raw[a:a + 4 * n] for a, n in zip(at.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays([
                block.column(0).take(pa.array(text)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                pa.array([zlib.crc32(x) for x in parts], pa.int64()),
                pa.array([x.tobytes() if with_ids else None for x in parts], pa.binary())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
    return run


def pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE_TOKENS,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``ids`` (little-endian 32-bit) only where asked for."""
    return (docs.select(F.col("doc_id").cast("long"), F.col("text"))
            .mapInArrow(_cut(tokenizer_path, sequence, end_id, with_ids), PIECE_SCHEMA))


@dataclass
class Plan:
    """Intervals of piece numbers per length, sorted by (length, lo): pieces lo to
    hi of a length lie in bins from ``bin`` on, ``each`` to a bin, from ``offset``."""

    length: np.ndarray
    lo: np.ndarray
    bin: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    bins: int


def fullest(available: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """The (length, copies) whose sum comes nearest to ``room`` without passing it.

    Bit s of a set says that sum s can be reached. Lengths are offered in the given
    order, each with its count split into powers of two; the sets are kept to walk
    back, and the search ends as soon as the bin can be filled.
    """
    mask = (1 << (room + 1)) - 1
    reach, history = 1, []
    for length, count in available:
        if length > room:
            continue
        count, chunk = min(count, room // length), 1
        while count:
            take = min(chunk, count)
            grown = reach | (reach << (take * length)) & mask
            if grown != reach:
                history.append((length, take, reach))
                reach = grown
            count -= take
            chunk *= 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(history):
        if not before >> at & 1:
            at -= take * length
            chosen[length] = chosen.get(length, 0) + take
    return sorted(chosen.items(), reverse=True)


def plan_bins(histogram: dict[int, int], sequence: int = SEQUENCE_TOKENS) -> Plan:
    """Fill bins one pattern at a time. The longest piece left opens the bin (it
    has to lie somewhere, and fits with the fewest others); the programme fills the
    rest. A pattern is repeated while its lengths last, which leaves every bin the
    fullest that its pieces allow at its turn."""
    left = dict(sorted(((n, c) for n, c in histogram.items() if c > 0), reverse=True))
    used = dict.fromkeys(left, 0)
    rows, bins = [], 0
    while left:
        longest = next(iter(left))
        rest = [(n, c - (n == longest)) for n, c in left.items() if c > (n == longest)]
        pattern = dict([(longest, 1)])
        for n, k in fullest(rest, sequence - longest) if longest < sequence else []:
            pattern[n] = pattern.get(n, 0) + k
        times = min(left[n] // k for n, k in pattern.items())
        offset = 0
        for n, k in pattern.items():
            rows.append((n, used[n], bins, k, offset))
            offset += n * k
            used[n] += times * k
            left[n] -= times * k
            if not left[n]:
                del left[n]
        bins += times
    rows.sort()
    columns = [np.array(c, dtype=np.int64) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 5
    return Plan(*columns, bins)


def _place(plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan_ = plan.value
        # one sorted key for (length, number): numbers stay below 2^50
        key = (plan_.length << 50) + plan_.lo
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            length = batch.column(names.index("length")).to_numpy()
            number = batch.column(names.index("__number")).to_numpy()
            at = np.searchsorted(key, (length << 50) + number, side="right") - 1
            nth = number - plan_.lo[at]
            each = plan_.each[at]
            out = batch.drop_columns(["__number"])
            yield (out.append_column("sequence_id", pa.array(plan_.bin[at] + nth // each))
                   .append_column("offset", pa.array(plan_.offset[at] + nth % each * length)))
    return run


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the pieces of each length within a task."""
    seen = np.zeros(1, dtype=np.int64)
    task = TaskContext.get().partitionId()
    for batch in batches:
        if not batch.num_rows:
            continue
        length = batch.column(batch.schema.get_field_index("length")).to_numpy()
        if len(seen) <= length.max():
            seen = np.concatenate([seen, np.zeros(int(length.max()) + 1 - len(seen), np.int64)])
        order = np.argsort(length, kind="stable")
        sorted_length = length[order]
        first = np.flatnonzero(np.r_[True, sorted_length[1:] != sorted_length[:-1]])
        run = np.diff(np.r_[first, len(order)])
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order)) - np.repeat(first, run) + seen[sorted_length]
        seen[sorted_length[first]] += run
        yield (batch.append_column("__task", pa.array(np.full(len(order), task, np.int32)))
               .append_column("__nth", pa.array(number)))


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE_TOKENS,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``. The numbered pieces are
    written once, so the numbers hold even when a task is run again."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = _cut(tokenizer_path, sequence, end_id, with_ids)

    def numbered_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # in one worker: two steps of a plan would hold two in each task
        yield from _number(cut(batches))

    rows = scratch.keep(docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(
        numbered_pieces, PIECE_SCHEMA + ", __task int, __nth long"), "pieces")
    # a row per task and length; numbers of a length start where earlier tasks ended
    counts = rows.groupBy("__task", "length").agg(F.count(F.lit(1)).alias("n"))
    firsts = scratch.keep(counts.select(
        "__task", "length", "n",
        (F.sum("n").over(Window.partitionBy("length").orderBy("__task")) - F.col("n")).alias("__first")),
        "firsts")
    histogram = {r["length"]: r["n"] for r in
                 firsts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(plan_bins(histogram, sequence))
    numbered = (rows.join(firsts.select("__task", "length", "__first"), ["__task", "length"])
                .select(*[c for c in rows.columns if not c.startswith("__")],
                        (F.col("__first") + F.col("__nth")).alias("__number")))
    return numbered.mapInArrow(_place(plan),
                               PIECE_SCHEMA + ", sequence_id long, offset long")
