"""launchboard: product-launch scorecards as Spark DataFrame jobs.

Layout:
  sources/    readers for the eight input tables, the test-data mapping, sinks
  functions/  column rules (launch dates, age parsing, price band, ids, ratios)
  operators/  dims, enriched fact, lifetime ranks, order pieces, KPI, benchmarks
  plans/      scorecard assembly, session settings, the query catalogue
"""

from launchboard.config import ANALYST_DEFAULTS, RunParams

__all__ = ["ANALYST_DEFAULTS", "RunParams"]
