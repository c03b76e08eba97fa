"""Intermediate models: per symbol and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rounding import percent_change, round_half_up


def int_symbol_daily_stats(bars: DataFrame) -> DataFrame:
    """Daily roll-up of staged bars from one scan.

    ``day_open`` is the lowest open and ``day_close`` the highest close of the day's last
    hour; ``day_open_first`` and ``day_close_last`` are the first open and the last close.

    Bars are summed by hour and hours by day: the last hour's close is then a plain
    ``max_by``, and every step stays a hash aggregation. A day has at most 24 hours.
    """
    hourly = bars.groupBy("symbol", "trade_date", "trade_hour").agg(
        F.min("open").alias("lowest_open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max("close").alias("highest_close"),
        F.sum("volume").alias("volume"),
        F.sum("trade_count").alias("trade_count"),
        F.sum("vwap").alias("vwap_sum"),
        F.count("vwap").alias("vwaps"),
        F.count("close").alias("closes"),
        F.avg("close").alias("close_mean"),
        F.var_pop("close").alias("close_var"),
        F.count("*").alias("bar_count"),
        F.sum("bar_return_pct").alias("return_sum"),
        F.count("bar_return_pct").alias("returns"),
        F.min_by("open", "window_start").alias("first_open"),
        F.max_by("close", "window_start").alias("last_close"),
    )
    closes = F.struct(F.col("closes").alias("n"), F.col("close_mean").alias("mean"), F.col("close_var").alias("var"))
    mean_of = lambda total, n: F.sum(total) / F.nullif(F.sum(n), F.lit(0))
    daily = hourly.groupBy("symbol", "trade_date").agg(
        F.min("lowest_open").alias("day_open"),
        F.max("high").alias("day_high"),
        F.min("low").alias("day_low"),
        F.max_by("highest_close", "trade_hour").alias("day_close"),
        F.sum("volume").alias("day_volume"),
        F.sum("trade_count").alias("day_trade_count"),
        mean_of("vwap_sum", "vwaps").alias("day_vwap"),
        _deviation(F.collect_list(F.when(F.col("closes") > 0, closes))).alias("intraday_volatility"),
        (F.max("high") - F.min("low")).alias("day_range"),
        F.sum("bar_count").alias("bar_count"),
        mean_of("return_sum", "returns").alias("avg_bar_return"),
        F.min_by("first_open", "trade_hour").alias("day_open_first"),
        F.max_by("last_close", "trade_hour").alias("day_close_last"),
    )
    base = F.nullif(F.col("day_open"), F.lit(0.0))
    return daily.withColumns(
        {
            "daily_return_pct": percent_change(F.col("day_open"), F.col("day_close")),
            "range_pct": round_half_up(F.col("day_range") / base * 100, 4),
        }
    )


def _deviation(parts: Column) -> Column:
    """Sample deviation of a whole from the count, mean and variance of its parts."""
    total = lambda value: F.aggregate(parts, F.lit(0.0), lambda acc, part: acc + value(part))
    n = total(lambda part: part["n"])
    mean = total(lambda part: part["n"] * part["mean"]) / n
    squares = total(lambda part: part["n"] * (part["var"] + (part["mean"] - mean) * (part["mean"] - mean)))
    return F.when(n > 1, F.sqrt(squares / (n - 1)))


def int_anomaly_summary(anomalies: DataFrame) -> DataFrame:
    price_z, volume_z = F.abs("price_zscore"), F.abs("volume_zscore")
    severity = lambda value: F.count_if(F.col("severity") == value)
    kind = lambda value: F.count_if(F.col("anomaly_type") == value)
    return anomalies.groupBy("symbol", "anomaly_date").agg(
        F.count("*").alias("anomaly_count"),
        severity("EXTREME").alias("extreme_count"),
        severity("CRITICAL").alias("critical_count"),
        severity("WARNING").alias("warning_count"),
        kind("PRICE").alias("price_anomalies"),
        kind("VOLUME").alias("volume_anomalies"),
        kind("PRICE_AND_VOLUME").alias("combined_anomalies"),
        round_half_up(F.avg(price_z), 2).alias("avg_price_zscore"),
        round_half_up(F.max(price_z), 2).alias("max_price_zscore"),
        round_half_up(F.avg(volume_z), 2).alias("avg_volume_zscore"),
    )
