"""Lifetime order ranking of members, per channel and across channels.

Orders are ranked within a *slice* (LCS, TMALL, DOUYIN, or OMNI = all
channels) by first paid time, ties broken by order id. Only orders with an
effective member line take part, and the whole history is ranked (no launch
or tracking filter comes first).

Two forms:

* ``order_rank`` gives the exact row number. It never sorts all orders of a
  member in one task: the orders are range-partitioned on the full sort key,
  numbered within each partition, and shifted by the member's row count in
  earlier partitions (see the function).
* ``rank_classes`` gives what the scorecards consume: whether the order is
  the member's first (rk = 1) or a later one (rk >= 2). The first order of
  each member is a plain ``min`` aggregate (combined map-side, so a member
  holding a third of all orders costs one row per map task), joined back on
  (slice, member, order), a key without hot values.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from launchboard import config as C
from launchboard.functions.rules import is_true
from launchboard.plans.session import materialize


def rank_orders(rows: DataFrame, slices: tuple[str, ...] = C.RANK_SLICES,
                time_col: str = "order_paid_time", eligible: Column | None = None) -> DataFrame:
    """(slice, parent_order_id, member_id, order_paid_time): one row per
    order and member identity in each slice, paid time = earliest eligible
    line. ``rows`` are order lines, or the order summary (``time_col`` =
    elig_time, ``eligible`` = has_elig)."""
    if eligible is None:
        eligible = is_true("if_eff_order_tag") & is_true("is_member_order")
    e = rows.where(eligible)
    slice_exprs = [F.col("source_channel")] if any(s != C.CHANNEL_OMNI for s in slices) else []
    if C.CHANNEL_OMNI in slices:
        slice_exprs.append(F.lit(C.CHANNEL_OMNI))
    x = e.select(F.explode(F.array(*slice_exprs)).alias("slice"),
                 "parent_order_id", "member_id", F.col(time_col).alias("_t"))
    x = x.where(F.col("slice").isin(*slices))
    return x.groupBy("slice", "parent_order_id", "member_id").agg(
        F.min("_t").alias("order_paid_time"))


def rank_orders_from_summary(summary: DataFrame,
                             slices: tuple[str, ...] = C.RANK_SLICES) -> DataFrame:
    return rank_orders(summary, slices, time_col="elig_time", eligible=F.col("has_elig"))


#: Orders of a range partition, from which on there are more partitions.
ORDERS_A_PARTITION = 2_000_000


def _run_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted partition with their number in their run of (slice, member), the
    partition's number, and which rows are its first and its last."""
    pid = TaskContext.get().partitionId()
    held, last_key, count = None, None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        names = batch.schema.names
        slices, members = (batch.column(names.index(c)) for c in ("slice", "member_id"))
        key = [pc.fill_null(c.dictionary_encode().indices, -1).to_numpy() for c in (slices, members)]
        new = np.ones(n, dtype=bool)
        new[1:] = (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])
        at = np.arange(n)
        local = at - np.maximum.accumulate(np.where(new, at, 0)) + 1
        if (slices[0].as_py(), members[0].as_py()) == last_key:  # the run goes on
            first_run = np.cumsum(new) == 1
            local[first_run] += count
        if held is not None:
            yield held
        first = np.zeros(n, dtype=bool)
        first[0] = held is None
        held = pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(local, pa.int64()), pa.array([pid] * n, pa.int32()),
             pa.array(first), pa.array([False] * n)], [*names, "_local", "_pid", "_first", "_last"])
        last_key, count = (slices[n - 1].as_py(), members[n - 1].as_py()), int(local[-1])
    if held is not None:
        yield held.set_column(held.schema.names.index("_last"), "_last",
                              pa.array([False] * (held.num_rows - 1) + [True]))


def _run_offsets(edges: list[Row]) -> list[tuple]:
    """(partition, slice, member, rows of the run in earlier partitions) for each partition
    whose first run goes on from an earlier one; ``edges``: first and last rows of all."""
    found, tail, before = [], None, 0
    by_pid: dict[int, list[Row]] = {}
    for r in edges:
        by_pid.setdefault(r["_pid"], []).append(r)
    for pid in sorted(by_pid):
        first = next(r for r in by_pid[pid] if r["_first"])
        last = next(r for r in by_pid[pid] if r["_last"])
        head, end = ((r["slice"], r["member_id"]) for r in (first, last))
        carried = before if head == tail else 0
        if carried:
            found.append((pid, *head, carried))
        tail, before = end, last["_local"] + (carried if head == end else 0)
    return found


def order_rank(orders: DataFrame, partitions: int | None = None, keep=None) -> DataFrame:
    """Exact ``rk`` = ROW_NUMBER() over (slice, member) by (paid time asc
    nulls last, order id asc nulls last), without any task holding more than
    one range partition of rows, however many orders one member has.

    1. The orders are written once: their number, from which that of the range
       partitions follows, and the sampled bounds then cost no second aggregation.
    2. Range-partition on the full sort key (slice, member, time, order), the only
       exchange of the orders. The key is unique, so sampling splits even a member with a
       third of all orders across many partitions, each a contiguous key range.
    3. Each partition is sorted, and its rows are numbered within their run of (slice,
       member) as they pass by: no exchange. They are written with their numbers, as
       sampling gives other bounds when it runs again.
    4. A run that continues from earlier partitions is the first of every later partition
       it reaches. The first and last rows of the partitions (two rows each) tell how many
       rows it has before: at most one offset a partition, broadcast.

    ``keep``: the materializer (by default a fresh scratch folder under the shared
    checkpoint root).
    """
    spark = orders.sparkSession
    keep = keep or partial(materialize, run_id=uuid.uuid4().hex)
    orders = keep(orders, "orders_to_rank")
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                          -(-orders.count() // ORDERS_A_PARTITION))
    t, o = F.col("order_paid_time"), F.col("parent_order_id")
    key = [F.col("slice"), F.col("member_id").isNull(), F.col("member_id"),
           t.isNull(), t, o.isNull(), o]
    schema = T.StructType([*orders.schema.fields]).add("_local", "long").add("_pid", "integer").add(
        "_first", "boolean").add("_last", "boolean")
    ranged = keep(orders.repartitionByRange(n, *key).sortWithinPartitions(*key).mapInArrow(
        _run_numbers, schema), "ranged_orders")
    edges = ranged.where("_first OR _last").select("_pid", "slice", "member_id", "_local", "_first", "_last")
    offsets = spark.createDataFrame(
        _run_offsets(edges.collect()),
        T.StructType([T.StructField("_opid", T.IntegerType()), T.StructField("_os", orders.schema["slice"].dataType),
                      T.StructField("_om", orders.schema["member_id"].dataType), T.StructField("_offset", T.LongType())]))
    j = ranged.join(F.broadcast(offsets), (F.col("_pid") == F.col("_opid"))
                    & (F.col("slice") == F.col("_os"))
                    & F.col("member_id").eqNullSafe(F.col("_om")), "left")
    return j.select("slice", "parent_order_id", "member_id", "order_paid_time",
                    (F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0)))
                    .cast("bigint").alias("rk"))


def first_orders(orders: DataFrame) -> DataFrame:
    """(slice, member_id, first_order_id): each member's rk = 1 order."""
    t, o = F.col("order_paid_time"), F.col("parent_order_id")
    k = F.min(F.struct(t.isNull().alias("t_null"), t.alias("t"),
                       o.isNull().alias("o_null"), o.alias("o")))
    return orders.groupBy("slice", "member_id").agg(k.alias("_k")).select(
        "slice", "member_id", F.col("_k.o").alias("first_order_id"))


def rank_classes(orders: DataFrame) -> DataFrame:
    """Rank relation reduced to rk = 1 / rk >= 2:
    (slice, parent_order_id, member_id, is_first)."""
    f = first_orders(orders).select(F.col("slice").alias("_fs"), F.col("member_id").alias("_fm"),
                                    "first_order_id", F.lit(True).alias("_first"))
    j = orders.join(f, (F.col("slice") == F.col("_fs")) & F.col("member_id").eqNullSafe(F.col("_fm"))
                    & F.col("parent_order_id").eqNullSafe(F.col("first_order_id")), "left")
    return j.select("slice", "parent_order_id", "member_id",
                    F.col("_first").isNotNull().alias("is_first"))


def rank_marks(orders: DataFrame) -> DataFrame:
    """(slice, parent_order_id, _n, _first): a row with ``_n`` 1 for each rank row, and one
    with ``_first`` 1 for each member whose first order this is. Their sums tell how many of
    an order's rank rows have rk = 1 and how many do not, without a join of the two."""
    ranked = orders.select("slice", "parent_order_id", F.lit(1).alias("_n"), F.lit(0).alias("_first"))
    firsts = first_orders(orders).select("slice", F.col("first_order_id").alias("parent_order_id"),
                                         F.lit(0).alias("_n"), F.lit(1).alias("_first"))
    return ranked.unionByName(firsts)


def flag_columns(slice_label: str) -> tuple[str, str, str]:
    """Names of the per-slice columns of ``order_flags``."""
    return (f"n_rank_{slice_label}", f"any_first_{slice_label}", f"any_repeat_{slice_label}")


def order_flags(orders: DataFrame, slices: tuple[str, ...] = C.RANK_SLICES) -> DataFrame:
    """One row per order, side by side for every slice (NULL: not in it): how many rank rows
    join to its lines (``n_rank``) and whether any of them has rk = 1 / rk >= 2. The
    dashboard joins ranks to lines by order only, so an order carrying two member ids gives
    each of its lines both ranks; these three columns carry exactly that. Consumers join
    once, on parent_order_id alone, and pick the columns of their slice. ``orders`` are
    those of ``rank_orders``."""
    aggs = []
    for s in slices:
        n, first, repeat = flag_columns(s)
        rows, firsts = (F.sum(F.when(F.col("slice") == s, F.col(c))) for c in ("_n", "_first"))
        aggs += [rows.alias(n), (firsts > 0).alias(first), (rows > firsts).alias(repeat)]
    return rank_marks(orders).groupBy("parent_order_id").agg(*aggs)


def order_info(tracked: DataFrame, flags: DataFrame, pieces: DataFrame) -> DataFrame:
    """``order_flags`` and pieces of the tracked orders (parent_order_id, distinct)."""
    return tracked.join(flags, "parent_order_id", "left").join(pieces, "parent_order_id", "left")
