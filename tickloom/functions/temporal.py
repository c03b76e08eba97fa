"""Dates, day filters and ISO text. All in the session zone, which is UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def on_days(df: DataFrame, ts: str, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """Rows whose ``ts`` falls on first..last (inclusive; None leaves that end open).

    Written as a plain range on ``ts`` so that it reaches the Parquet scan, and repeated
    on ``trade_date`` where the table is partitioned by it.
    """
    partitioned = "trade_date" in df.columns
    if first is not None:
        df = df.filter(F.col(ts) >= F.lit(first).cast("timestamp"))
        df = df.filter(F.col("trade_date") >= F.lit(first)) if partitioned else df
    if last is not None:
        df = df.filter(F.col(ts) < F.lit(last + dt.timedelta(days=1)).cast("timestamp"))
        df = df.filter(F.col("trade_date") <= F.lit(last)) if partitioned else df
    return df


def iso_text(ts: Column) -> Column:
    """ISO-8601 text with a UTC offset; the fraction is left out when it is zero."""
    whole = F.unix_micros(ts) % 1_000_000 == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )
