"""The order of trades in time, without ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prices beyond tie with one another where their times are equal.
_MOST = 1e11


def _bounded(price: Column) -> Column:
    """A price within what the decimal holds; NaN, which is above all numbers, is the highest."""
    return F.greatest(F.least(price, F.lit(_MOST)), F.lit(-_MOST))


def trade_order(trades: DataFrame) -> Column:
    """One number that orders trades by event time, then arrival (``seq``).

    Without ``seq``, equal times are ordered by price, so that open and close don't depend on
    how rows are partitioned. A decimal of fixed width keeps aggregations hash-based.
    """
    step = F.lit(10**18).cast("decimal(19,0)")
    if "seq" in trades.columns:
        inner = F.coalesce(F.col("seq").cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    else:
        inner = F.coalesce((_bounded(F.col("price")) * 1e6).cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return (F.unix_micros("event_time").cast("decimal(18,0)") * step + inner).cast("decimal(38,0)")
