"""Assembly of the two dashboard tables.

``prepare`` builds the shared relations once: admitted lines, dimensions,
the order summary (one scan of the fact, reduced to order grain), and from
it the rank flags of all orders and the pieces of those with tracked lines. KPIs scan the fact a second time for
the tracked SKUs only. With ``materialize=True`` the small dimensions and
the order-level relations are written once as Parquet into the shared
checkpoint folder and read back: writing both tables then reads the fact
twice in total, and a lost executor does not replay the fact scan (lineage
is cut).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchboard import config as C
from launchboard.config import RunParams
from launchboard.operators import benchmark as B
from launchboard.operators import kpi as K
from launchboard.operators import ranks as RK
from launchboard.operators.fact import Dims, admitted_lines, build_dims, key_skew
from launchboard.operators.joins import Skew, null_share, proven_small
from launchboard.operators.orders import of_orders, order_summary, tracked_orders
from launchboard.operators.upt import order_pieces
from launchboard.plans.session import materialize as materialize_df
from launchboard.sources.tables import Inputs


class Prepared:
    """Shared relations of one run, built on first use.

    With ``materialize`` each shared relation (order summary, order info,
    tracked-SKU rows) is written once under the checkpoint root when first
    needed, so a query that needs only the summary does not pay for the rest. So are the
    KPI state and, for the scorecard, the benchmarks.
    """

    def __init__(self, params: RunParams, dims: Dims, lines: DataFrame,
                 keep: Callable[[DataFrame, str], DataFrame] | None):
        self.params, self.dims, self.lines = params, dims, lines
        self._keep = keep
        self.kpi_state: DataFrame | None = None     # set by share_kpi_state
        self._shared: dict[str, DataFrame] = {}

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        return self._keep(df, name) if self._keep else df

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A relation of this name, built on first use: each table that is refreshed from it,
        however often, reads the same rows."""
        if name not in self._shared:
            self._shared[name] = self._kept(build(), name)
        return self._shared[name]

    @cached_property
    def summary(self) -> DataFrame:
        return self._kept(order_summary(self.lines, self.dims, self.params), "order_summary")

    @cached_property
    def skew(self) -> dict[str, Skew]:
        """Hot and missing member keys, channel ids and order ids, found once, in the
        order summary."""
        no_order = null_share(self.summary, "parent_order_id")
        return key_skew(self.summary, self.params) | {"parent_order_id": Skew(no_order)}

    @cached_property
    def rank_orders(self) -> DataFrame:
        return RK.rank_orders_from_summary(self.summary)

    @cached_property
    def flags(self) -> DataFrame:
        """Rank flags of all orders: benchmarks count them all."""
        return self._kept(RK.order_flags(self.rank_orders), "order_flags")

    @cached_property
    def pieces(self) -> DataFrame:
        """Pieces of all orders."""
        return order_pieces(self.summary, self.dims, self.params, self.skew)

    @cached_property
    def tracked(self) -> DataFrame:
        return self._kept(tracked_orders(self.summary), "tracked_orders")

    @cached_property
    def info(self) -> DataFrame:
        """Flags and pieces of the orders with a tracked line, for the KPIs: the others
        are left out before the joins."""
        small = proven_small({"tracked": self.tracked}, self.params.max_broadcast_bytes)["tracked"]
        summary, flags = (of_orders(x, self.tracked, small) for x in (self.summary, self.flags))
        pieces = order_pieces(summary, self.dims, self.params, self.skew)
        return self._kept(RK.order_info(self.tracked, flags, pieces), "order_info")


def prepare(inputs: Inputs, params: RunParams = C.ANALYST_DEFAULTS,
            materialize: bool = False, run_id: str | None = None) -> Prepared:
    """``run_id`` names the scratch folder of the written relations (a fresh
    one by default; a fixed one is overwritten by the next run)."""
    run_id = run_id or uuid.uuid4().hex
    keep = (lambda df, name: materialize_df(df, name, run_id)) if materialize else None
    dims = build_dims(inputs, params, keep=keep)
    return Prepared(params, dims, admitted_lines(inputs.order_line, params), keep)


def _specs(params: RunParams, labels):
    return tuple(s for s in params.kpi_specs if labels is None or s.label in labels)


def _kpi_state(p: Prepared, labels) -> DataFrame:
    if p.kpi_state is not None and labels is None:
        return p.kpi_state
    return p.shared(f"kpi_state_{'_'.join(labels or ('all',))}", lambda: K.state(
        K.kpi_rows(p.lines, p.dims, p.info, p.params, _specs(p.params, labels), p.skew)))


def share_kpi_state(p: Prepared, run_id: str) -> Prepared:
    """Reduce the tracked SKUs' lines once, so that the window and the week grain are
    merged from the same rows (one fact scan and one exchange of lines for both tables)."""
    p.kpi_state = _kpi_state(p, None)
    if not p._keep:
        p.kpi_state = materialize_df(p.kpi_state, "kpi_state", run_id)
    return p


def kpi_launch_window(p: Prepared, labels: tuple[str, ...] | None = None) -> DataFrame:
    return K.aggregate(_kpi_state(p, labels), K.WINDOW_KEYS).select(*K.KPI_OUTPUT)


def kpi_launch_week(p: Prepared, labels: tuple[str, ...] | None = None) -> DataFrame:
    return K.aggregate(_kpi_state(p, labels), K.WEEK_KEYS).select(*K.KPI_WEEK_OUTPUT)


def benchmark_all(p: Prepared, labels: tuple[str, ...] | None = None) -> DataFrame:
    specs = tuple(s for s in p.params.benchmark_specs if labels is None or s.label in labels)
    return B.benchmarks(p.summary, p.dims, p.flags, p.params, specs, p.skew).select(*B.BENCH_OUTPUT)


def scorecard_8w(p: Prepared) -> DataFrame:
    """KPI per (channel, SKU) over the tracking window with the benchmark
    shares of the same channel and period: one left join on three keys."""
    kpi = kpi_launch_window(p)
    bench = p.shared("benchmark_all", lambda: benchmark_all(p)).where(F.col("launch_date").isNotNull()
                                   & F.col("tracking_end_date").isNotNull())
    j = kpi.join(bench, ["source_channel", "launch_date", "tracking_end_date"], "left")
    return j.select(*C.SCORECARD_8W_COLUMNS)


def scorecard_week(p: Prepared) -> DataFrame:
    return kpi_launch_week(p).select(*C.SCORECARD_WEEK_COLUMNS)
