"""The classifications used by the models. Nulls fall through to the last class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom import schemas as S


def severity(z: Column) -> Column:
    size = F.abs(z)
    return (
        F.when(size >= S.Z_EXTREME, "EXTREME")
        .when(size >= S.Z_CRITICAL, "CRITICAL")
        .when(size >= S.Z_WARNING, "WARNING")
        .otherwise("NORMAL")
    )


def anomaly_type(price_hit: Column, volume_hit: Column) -> Column:
    return (
        F.when(price_hit & volume_hit, "PRICE_AND_VOLUME").when(price_hit, "PRICE").otherwise("VOLUME")
    )


def trading_session(hour: Column) -> Column:
    return (
        F.when(hour.between(9, 10), "market_open")
        .when(hour.between(11, 14), "midday")
        .when(hour.between(15, 16), "market_close")
        .otherwise("extended_hours")
    )


def trend_signal(close: Column, short_mean: Column, long_mean: Column) -> Column:
    return (
        F.when((close > short_mean) & (short_mean > long_mean), "bullish")
        .when((close < short_mean) & (short_mean < long_mean), "bearish")
        .otherwise("neutral")
    )


def volume_signal(volume: Column, mean: Column) -> Column:
    return (
        F.when(volume > mean * 2, "high").when(volume > mean * 1.5, "elevated").otherwise("normal")
    )


def trend_direction(return_pct: Column) -> Column:
    return (
        F.when(return_pct > 2, "strong_up")
        .when(return_pct > 0, "up")
        .when(return_pct > -2, "down")
        .otherwise("strong_down")
    )


def volatility_regime(deviation: Column, level: Column) -> Column:
    return (
        F.when(deviation > level * 0.02, "high").when(deviation > level * 0.01, "medium").otherwise("low")
    )


def volume_tier(volume: Column) -> Column:
    return (
        F.when(volume > 10_000_000, "mega_cap")
        .when(volume > 1_000_000, "large_cap")
        .when(volume > 100_000, "mid_cap")
        .otherwise("small_cap")
    )


# Accepted classes, for the quality checks.
TREND_DIRECTIONS = ["strong_up", "up", "down", "strong_down"]
TREND_SIGNALS = ["bullish", "bearish", "neutral"]
