"""What each load has written: rows by symbol and date, beside the table itself.

The newest loaded date and the dates that hold a symbol's warm-up bars are read from here, a row
per symbol and day, and not from the bars.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.sinks.tables import replace_dates
from tickloom.sources.warehouse import Warehouse


def log_name(table: str) -> str:
    return f"{table}_loads"


def record(warehouse: Warehouse, table: str, series: Column, since: dt.date | None = None) -> None:
    """Count the rows of ``table`` from ``since`` on, by ``series`` and date, in place of earlier counts.

    Only the partitions just written are read. Run it again after a load that failed before it.
    """
    written = warehouse.read_or_none(table)
    if written is None:  # nothing to load yet
        return
    if since is not None:
        written = written.filter(F.col("trade_date") >= F.lit(since))
    counts = written.groupBy(series.alias("series"), "trade_date").agg(F.count("*").alias("n_rows"))
    counts = counts.withColumn("logged_at", F.current_timestamp())
    replace_dates(counts, warehouse.path(log_name(table)), cluster=("series",))


def logged(warehouse: Warehouse, table: str) -> DataFrame | None:
    """Rows (series, n_rows, logged_at, trade_date), or None before the first recorded load."""
    return warehouse.read_or_none(log_name(table))
