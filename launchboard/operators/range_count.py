"""Distinct entities per date range, for many overlapping ranges at once.

Question: for each period [start, end] of a group, how many distinct
entities have at least one occurrence day inside it? The SQL form is a
range join ``periods LEFT JOIN occurrences ON day BETWEEN start AND end``
followed by COUNT(DISTINCT entity); planned as a nested-loop join it pairs
every period with every occurrence and shuffles all pairs.

Exact rewrite, built from windows, aggregations and one equi-join:

* For each entity and counter the occurrence days are a bitmap: 62 days to a number,
  or-ed together in a map-side-combined aggregation, so an entity with any number of
  occurrences is a few numbers, and nothing is sorted. The set bits, taken out lowest
  first, so that empty days cost nothing, are its days in order; ``prev`` is the day before (NULL for the first). An entity is present in
  [s, e] exactly when some occurrence d has s <= d <= e and prev < s (its
  first occurrence in the range), and that occurrence is unique. So the
  distinct count is a plain count of occurrences with prev < s <= d <= e.
* Occurrences are reduced to a histogram H(day, prev) -> n. Its size is
  bounded by the square of the number of calendar days, whatever the data
  volume; a hot entity adds at most one row per day.
* For each distinct start s and each day d in [s, max end of s]:
  F(s, d) = sum of H(d, p) over p < s, a running sum in a window over one
  day (rows: prev days of that day plus starts covering it, both bounded).
* Count(s, e) = running sum of F(s, d) over d from s to e, a window over one
  start (rows: days of the longest period). Periods pick their value with an
  equi-join on (start, day = end).

Several counters (e.g. four member classes) share one pass: each occurrence
row carries a flag per counter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPOCH = dt.date(1970, 1, 1)
#: Days of a bitmap: a signed number of 64 bits stays positive, also with one taken off.
CHUNK_DAYS = 62


def _day_bitmaps(occurrences: DataFrame, g: list[str], entity: str, day: str, counters: list[str]) -> DataFrame:
    """One row per entity: ``_chunks``, the numbers of ``CHUNK_DAYS`` days each that have
    occurrences, with a bitmap per counter."""
    days = F.datediff(F.col(day), F.lit(EPOCH))
    bit = F.expr(f"shiftleft(1L, pmod(_n, {CHUNK_DAYS}))")
    chunks = (occurrences.withColumn("_n", days)
              .groupBy(*g, entity, F.floor(F.col("_n") / CHUNK_DAYS).cast("int").alias("_chunk"))
              .agg(*[F.coalesce(F.bit_or(F.when(F.col(c), bit)), F.lit(0)).alias(c) for c in counters]))
    return chunks.groupBy(*g, entity).agg(
        F.collect_list(F.struct("_chunk", *counters)).alias("_chunks"))


def _set_bits(bits: str) -> str:
    """SQL of the days of a chunk ``k`` with one of ``bits`` set, which are not 0: the lowest
    bit is taken off as often as there are any."""
    return (f"aggregate(sequence(1, bit_count({bits})), "
            f"named_struct('left', {bits}, 'days', cast(array() as array<int>)), "
            "(s, i) -> named_struct('left', s.left & (s.left - 1), 'days', array_append("
            f"s.days, k._chunk * {CHUNK_DAYS} + bit_count((s.left & -s.left) - 1))), s -> s.days)")


def _day_pairs(bitmaps: DataFrame, g: list[str], counters: list[str]) -> DataFrame:
    """(g, _counter, _day, _prev): each day of each entity's counters with the day before."""
    days = bitmaps.select(*g, F.expr("array_sort(_chunks)").alias("_chunks")).select(*g, *[F.expr(
        f"flatten(transform(filter(_chunks, k -> k.`{c}` != 0), k -> {_set_bits(f'k.`{c}`')}))").alias(c)
        for c in counters])

    def of_counter(c: str) -> Column:
        return F.transform(F.col(c), lambda d, i: F.struct(
            F.lit(c).alias("counter"), d.alias("day"), F.when(i > 0, F.get(F.col(c), i - 1)).alias("prev")))

    pairs = F.concat(*map(of_counter, counters))
    return days.select(*g, F.explode(pairs).alias("_p")).select(
        *g, F.col("_p.counter").alias("_counter"), *[
            F.date_add(F.lit(EPOCH), F.col(f"_p.{c}")).alias(f"_{c}") for c in ("day", "prev")])


def range_distinct_counts(occurrences: DataFrame, periods: DataFrame, group_cols: list[str],
                          entity: str, day: str, counters: list[str],
                          last_day: dt.date | None = None) -> DataFrame:
    """
    occurrences: group_cols + entity + day + one boolean column per counter
                 (the entity occurs for that counter on that day)
    last_day:    no occurrence is later than this day (None: unknown)
    periods:     group_cols + ``start`` + ``end`` (dates; duplicates allowed)
    returns:     distinct (group_cols, start, end) of ``periods`` with one
                 bigint count per counter; periods with a NULL bound or
                 start > end get 0
    """
    g = list(group_cols)
    hist = (_day_pairs(_day_bitmaps(occurrences, g, entity, day, counters), g, counters)
            .groupBy(*g, "_day", "_prev").agg(
        *[F.sum(F.when(F.col("_counter") == c, 1).otherwise(0)).cast("bigint").alias(c) for c in counters]))

    # days after the last possible occurrence change no count: a period that ends
    # later is answered by its count on that day
    def clip(end: Column) -> Column:
        return end if last_day is None else F.when(end > F.lit(last_day), F.lit(last_day)).otherwise(end)

    valid = periods.where(F.col("start").isNotNull() & F.col("end").isNotNull()
                          & (F.col("start") <= clip(F.col("end"))))
    starts = valid.groupBy(*g, "start").agg(F.max(clip(F.col("end"))).alias("_max_end"))
    start_days = starts.select(*g, "start", F.explode(
        F.sequence(F.col("start"), F.col("_max_end"))).alias("_day"))

    # stack histogram rows (key = prev) and start rows (key = start) per day
    u_hist = hist.select(*g, "_day", F.col("_prev").alias("_key"), F.lit(1).alias("_typ"),
                         F.lit(None).cast("date").alias("start"), *counters)
    u_start = start_days.select(*g, "_day", F.col("start").alias("_key"), F.lit(0).alias("_typ"),
                                "start", *[F.lit(0).cast("bigint").alias(c) for c in counters])
    u = u_hist.unionByName(u_start)
    by_day = (Window.partitionBy(*g, "_day")
              .orderBy(F.col("_key").asc_nulls_first(), F.col("_typ"))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = u.select(*g, "_day", "_typ", "start", *[F.sum(c).over(by_day).alias(c) for c in counters])
    f = u.where(F.col("_typ") == 0).drop("_typ")

    by_start = (Window.partitionBy(*g, "start").orderBy("_day")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = f.select(*g, "start", "_day", *[F.sum(c).over(by_start).alias(c) for c in counters])

    all_periods = periods.select(*g, "start", "end").distinct()
    cond = [all_periods[c].eqNullSafe(cum[c]) for c in g] + [
        all_periods.start == cum.start, clip(all_periods.end) == cum._day]
    j = all_periods.join(cum, cond, "left")
    return j.select(*[all_periods[c] for c in g], all_periods.start, all_periods.end,
                    *[F.coalesce(cum[c], F.lit(0)).cast("bigint").alias(c) for c in counters])


def range_distinct_counts_naive(occurrences: DataFrame, periods: DataFrame,
                                group_cols: list[str], entity: str, day: str,
                                counters: list[str]) -> DataFrame:
    """Direct range join + COUNT(DISTINCT) (test reference; quadratic)."""
    g = list(group_cols)
    p = periods.select(*g, "start", "end").distinct()
    cond = [p[c].eqNullSafe(occurrences[c]) for c in g] + [
        occurrences[day].between(p.start, p.end)]
    j = p.join(occurrences, cond, "left")
    return j.groupBy(*[p[c] for c in g], p.start, p.end).agg(*[
        F.countDistinct(F.when(occurrences[c], occurrences[entity])).alias(c) for c in counters])
