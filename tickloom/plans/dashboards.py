"""Dashboard queries; each takes the day it looks at."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.temporal import on_days


def _symbol_day(bars: DataFrame, symbol: str, as_of: dt.date) -> DataFrame:
    return on_days(bars, "window_start", as_of, as_of).filter(F.col("symbol") == symbol)


def candles(bars: DataFrame, symbol: str, as_of: dt.date) -> DataFrame:
    return (
        _symbol_day(bars, symbol, as_of)
        .select(F.col("window_start").alias("time"), "open", "high", "low", "close", "volume")
        .orderBy("time")
    )


def volume_series(bars: DataFrame, symbol: str, as_of: dt.date) -> DataFrame:
    return _symbol_day(bars, symbol, as_of).select(F.col("window_start").alias("time"), "volume").orderBy("time")


def _detected(since: dt.date, until: dt.date) -> Column:
    """Detection day as a range on the ISO text (UTC, so it sorts like the time), which
    reaches the scan, where a parsed date would not."""
    return (F.col("detected_at") >= since.isoformat()) & (F.col("detected_at") < (until + dt.timedelta(days=1)).isoformat())


def recent_anomalies(anomalies: DataFrame, as_of: dt.date, top: int = 50) -> DataFrame:
    """The day's latest anomalies; the values settle equal detection times."""
    return (
        anomalies.filter(_detected(as_of, as_of))
        .select("symbol", "severity", "anomaly_type", "price", "price_zscore", "volume_zscore", "detected_at")
        .orderBy(F.col("detected_at").desc(), "symbol", F.col("price").desc(), F.col("volume_zscore").desc())
        .limit(top)
    )


def anomaly_counts(anomalies: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        anomalies.filter(_detected(as_of, as_of))
        .groupBy("symbol")
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), "symbol")
    )


def recent_zscores(anomalies: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """Scores of the ``days`` up to the end of ``as_of``."""
    return anomalies.filter(_detected(as_of - dt.timedelta(days=days), as_of)).select("price_zscore")


def recent_returns(daily_market: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    since = as_of - dt.timedelta(days=days)
    return (
        daily_market.filter(F.col("trade_date").between(F.lit(since), F.lit(as_of)))
        .select(F.col("trade_date").alias("time"), "symbol", F.col("daily_return_pct").alias("value"))
        .orderBy("time", "symbol")
    )


def symbols_of_day(bars: DataFrame, as_of: dt.date) -> DataFrame:
    return on_days(bars, "window_start", as_of, as_of).select("symbol").distinct().orderBy("symbol")
