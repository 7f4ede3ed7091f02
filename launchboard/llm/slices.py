"""Slices: rows of a table packed into compressed blocks of a few megabytes.

A slice is written once, so its number and its rows stay the same whatever later
plans or lost executors do. Operators send what they know of a slice to shards of
a hash space as packed arrays (one value per slice, however often the slice holds
it) and get short answers back per slice. A shard holds a bounded part of the hash
space: the number of shards follows the size of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchboard.llm.store import ARROW_BATCH_BYTES, Scratch
from launchboard.llm.words import U64, blocks

SCHEMA = "slice long, n_bytes long, payload binary"

#: Text of a slice at most: a little more than an Arrow batch, which so leaves no small rest.
SLICE_BYTES = int(ARROW_BATCH_BYTES) * 5 // 4
#: Bytes of text per shard.
SHARD_BYTES = 8 << 20

_ZSTD = pa.ipc.IpcWriteOptions(compression="zstd")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for block in blocks(batches, "text", SLICE_BYTES):
        sink = pa.BufferOutputStream()
        # take() copies, so that the file holds the block's rows alone
        block = block.take(pa.array(np.arange(block.num_rows)))
        with pa.ipc.new_stream(sink, block.schema, options=_ZSTD) as out:
            out.write_batch(block)
        size = pc.sum(pc.binary_length(block.column(block.schema.get_field_index("text")))).as_py() or 0
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([size], pa.int64()),
             pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["slice", "n_bytes", "payload"])
        number += 1


def write_slices(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The written slices of ``docs``, which has a column ``text``."""
    return scratch.keep(docs.mapInArrow(_pack, SCHEMA), "slices")


def open_slice(payload: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(payload) as source:
        return source.read_next_batch()


def shards_for(slices: DataFrame) -> int:
    size = slices.agg(F.sum("n_bytes")).first()[0] or 0
    return max(1, -(-size // SHARD_BYTES))


def by_shard(values: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions of its values) for every shard that occurs."""
    shard = (values % U64(shards)).astype(np.int64)
    # few shards sort by their digits
    order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
    ids, first = np.unique(shard[order], return_index=True)
    for k, lo, hi in zip(ids, first, [*first[1:], len(order)]):
        yield int(k), order[lo:hi]
