"""Authoritative daily summary, straight from raw trades."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.ordering import trade_order
from tickloom.functions.rounding import percent_change, round_half_up
from tickloom.functions.temporal import on_days


def daily_summary(
    trades: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
    order_by: str | Column | None = None,
    computed_at: Column | None = None,
) -> DataFrame:
    """One row per symbol and day of first..last; ``order_by`` as for the bars."""
    order = trade_order(trades) if order_by is None else F.col(order_by) if isinstance(order_by, str) else order_by
    stamp = computed_at if computed_at is not None else F.current_timestamp()
    return (
        on_days(trades, "event_time", first, last)
        .withColumn("trade_date", F.to_date("event_time"))
        .groupBy("symbol", "trade_date")
        .agg(
            F.min_by("price", order).alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", order).alias("close_price"),
            F.sum("volume").alias("total_volume"),
            F.count("*").alias("trade_count"),
            round_half_up(F.avg("price"), 4).alias("avg_price"),
            round_half_up(F.stddev_samp("price"), 4).alias("price_stddev"),
            F.min("event_time").alias("market_open_time"),
            F.max("event_time").alias("market_close_time"),
        )
        .withColumn("daily_return_pct", percent_change(F.col("open_price"), F.col("close_price")))
        .withColumn("computed_at", stamp)
    )
