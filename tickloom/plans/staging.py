"""Staging models: views over the source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.classify import trading_session
from tickloom.functions.rounding import percent_change
from tickloom.operators.anomaly import with_anomaly_date
from tickloom.operators.dedup import pick_one


def stg_trades(raw: DataFrame, tz: str | None = None) -> DataFrame:
    """The latest load of each (symbol, event_time), with date, hour and trading session.

    Sessions follow UTC hours unless a zone is given. Equal load times are settled by the
    values themselves, so reruns agree.
    """
    newest = [F.col("loaded_at").desc(), *[F.col(c).desc() for c in ("price", "volume", "exchange")]]
    local = F.col("event_time") if tz is None else F.from_utc_timestamp("event_time", tz)
    date = F.to_date(local) if tz else _date_of(raw, "event_time")
    hour = F.hour(local)
    return pick_one(raw, ["symbol", "event_time"], newest).select(
        "symbol",
        "price",
        "volume",
        F.col("event_time").alias("trade_timestamp"),
        "exchange",
        date.alias("trade_date"),
        hour.alias("trade_hour"),
        trading_session(hour).alias("trading_session"),
        "loaded_at",
    )


def stg_ohlcv_1min(bars: DataFrame) -> DataFrame:
    return bars.select(
        "symbol",
        "window_start",
        "window_end",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "trade_count",
        "vwap",
        _date_of(bars, "window_start").alias("trade_date"),
        F.hour("window_start").alias("trade_hour"),
        percent_change(F.col("open"), F.col("close")).alias("bar_return_pct"),
        (F.col("high") - F.col("low")).alias("price_range"),
        "processed_at",
    )


def _date_of(df: DataFrame, ts: str) -> Column:
    """The UTC date; a table's own partition column, where it has one, so filters prune it."""
    return F.col("trade_date") if "trade_date" in df.columns else F.to_date(ts)


def stg_anomalies(anomalies: DataFrame) -> DataFrame:
    dated = anomalies if "anomaly_date" in anomalies.columns else with_anomaly_date(anomalies)
    return dated.select(
        "symbol",
        "price",
        "volume",
        F.col("timestamp").alias("event_timestamp"),
        "price_zscore",
        "volume_zscore",
        "price_mean",
        "price_std",
        "volume_mean",
        "volume_std",
        "severity",
        "anomaly_type",
        "detected_at",
        "anomaly_date",
    )
