"""panelspark: panel time-series analytics expressed as Spark DataFrame jobs.

Layout
------
functions/   column expressions (null/NaN rules, text, dates, numbers)
operators/   DataFrame -> DataFrame building blocks (windows, aggregates,
             joins, reshape, set operations, statistics)
sources/     readers and writers (wide CSV, JSON, HTML, typed tables)
plans/       composite jobs: panels, prices, text, reports, refresh
streaming/   incremental refresh driven by Structured Streaming
"""

from panelspark.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
