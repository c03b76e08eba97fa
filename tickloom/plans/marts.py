"""Marts: bars with moving averages, the daily market, and the symbol dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tickloom.functions.classify import (
    trend_direction,
    trend_signal,
    volatility_regime,
    volume_signal,
    volume_tier,
)
from tickloom.functions.rounding import round_half_up
from tickloom.operators import rolling

# Moving-average lengths in bars.
SHORT_MEAN, LONG_MEAN, VOLUME_MEAN = 20, 50, 10


def fct_realtime_ohlcv(bars: DataFrame, chunk_rows: int | None = rolling.CHUNK_ROWS, ranged: bool = True) -> DataFrame:
    """Staged bars with moving averages and signals.

    Long histories are cut into chunks that carry 49 bars of warm-up, so one symbol is
    not one task. The bars are built once, when this is called, and written in the order of their
    series; with ``ranged=False``, for short inputs, they are counted per day instead, and
    nothing runs yet. ``chunk_rows=None`` keeps a single window per symbol, which saves a
    shuffle where the input is very short.
    """
    if chunk_rows is None:
        day = W.partitionBy("symbol", "trade_date").orderBy("window_start")
        return _with_signals(bars.withColumn("bar_sequence", F.row_number().over(day)), ["symbol"])
    keyed = bars.withColumn("series", series_key())
    if ranged:
        placed = rolling.place(keyed, "series", ["window_start"], within="trade_date", rank_as="bar_sequence")
        tasks = rolling.chunk_tasks(placed)
    else:
        placed = rolling.with_position(keyed, "series", F.col("trade_date"), ["window_start"], rank_as="bar_sequence")
        tasks = None
    chunks = rolling.with_chunks(placed, "series", LONG_MEAN - 1, chunk_rows, tasks)
    return _with_signals(chunks, ["series", rolling.CHUNK], warmup=rolling.WARMUP)


def series_key() -> Column:
    """A key for joins that, unlike the symbol, is never null: bars without a symbol are
    a series of their own, which the quality checks report, and must not get lost."""
    return F.coalesce(F.concat(F.lit("="), F.col("symbol")), F.lit(""))


def _with_signals(bars: DataFrame, keys: list[str], warmup: str | None = None) -> DataFrame:
    series = W.partitionBy(*keys).orderBy("window_start")
    trailing = lambda length: series.rowsBetween(1 - length, 0)
    averaged = bars.select(
        "*",
        F.avg("close").over(trailing(SHORT_MEAN)).alias("short_mean"),
        F.avg("close").over(trailing(LONG_MEAN)).alias("long_mean"),
        F.avg("volume").over(trailing(VOLUME_MEAN)).alias("volume_mean"),
        F.lag("close").over(series).alias("prev_close"),
    )
    if warmup:
        averaged = averaged.filter(~F.col(warmup))
    # signals compare the unrounded means
    return averaged.select(
        "symbol",
        "trade_date",
        "trade_hour",
        "window_start",
        "window_end",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "trade_count",
        "vwap",
        "bar_return_pct",
        "price_range",
        round_half_up(F.col("short_mean"), 4).alias("sma_20"),
        round_half_up(F.col("long_mean"), 4).alias("sma_50"),
        round_half_up(F.col("volume_mean"), 0).alias("volume_sma_10"),
        "prev_close",
        trend_signal(F.col("close"), F.col("short_mean"), F.col("long_mean")).alias("trend_signal"),
        volume_signal(F.col("volume"), F.col("volume_mean")).alias("volume_signal"),
        "bar_sequence",
    )


def fct_daily_market(daily_stats: DataFrame, anomaly_summary: DataFrame) -> DataFrame:
    """Daily statistics with anomaly counts; both sides come grouped by the join keys."""
    found = anomaly_summary.select(
        "symbol",
        F.col("anomaly_date").alias("trade_date"),
        "anomaly_count",
        "extreme_count",
        "critical_count",
        "max_price_zscore",
    )
    or_zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return daily_stats.join(found, ["symbol", "trade_date"], "left").select(
        "symbol",
        "trade_date",
        "day_open",
        "day_high",
        "day_low",
        "day_close",
        "day_volume",
        "day_trade_count",
        "day_vwap",
        "daily_return_pct",
        "intraday_volatility",
        "range_pct",
        "bar_count",
        or_zero("anomaly_count").alias("anomaly_count"),
        or_zero("extreme_count").alias("extreme_anomalies"),
        or_zero("critical_count").alias("critical_anomalies"),
        F.coalesce("max_price_zscore", F.lit(0.0)).alias("max_zscore"),
        trend_direction(F.col("daily_return_pct")).alias("trend_direction"),
        volatility_regime(F.col("intraday_volatility"), F.col("day_vwap")).alias("volatility_regime"),
    )


def dim_symbols(trades: DataFrame, anomalies: DataFrame) -> DataFrame:
    """One row per symbol from staged trades and staged anomalies."""
    return dim_symbols_of_days(symbol_days(trades), anomalies)


def symbol_days(trades: DataFrame) -> DataFrame:
    """Staged trades summed per symbol and day, up to the newest load among them."""
    return trades.groupBy("symbol", "trade_date").agg(
        F.count("volume").alias("volumes"),
        F.sum("volume").alias("volume"),
        F.count("price").alias("prices"),
        F.sum("price").alias("price_sum"),
        F.max("loaded_at").alias("loaded_until"),
    )


def dim_symbols_of_days(per_day: DataFrame, anomalies: DataFrame) -> DataFrame:
    """The dimension from daily sums: a hot symbol is one row per day.

    ``avg_daily_volume`` is the mean volume of a trade, on which the tiers are judged;
    ``true_avg_daily_volume`` is the mean of daily totals.
    """
    mean_volume = F.sum("volume") / F.nullif(F.sum("volumes"), F.lit(0))
    seen = per_day.groupBy("symbol").agg(
        F.min("trade_date").alias("first_seen"),
        F.max("trade_date").alias("last_seen"),
        F.count("trade_date").alias("active_days"),
        mean_volume.alias("mean_volume"),
        (F.sum("price_sum") / F.nullif(F.sum("prices"), F.lit(0))).alias("mean_price"),
        F.avg("volume").alias("mean_day_volume"),
    )
    found = anomalies.groupBy("symbol").agg(
        F.count("*").alias("total_anomalies"),
        F.count_if(F.col("severity") == "EXTREME").alias("extreme_count"),
    )
    return seen.join(found, "symbol", "left").select(
        "symbol",
        "first_seen",
        "last_seen",
        "active_days",
        round_half_up(F.col("mean_volume"), 0).alias("avg_daily_volume"),
        round_half_up(F.col("mean_price"), 2).alias("avg_price"),
        F.coalesce("total_anomalies", F.lit(0)).alias("total_anomalies"),
        F.coalesce("extreme_count", F.lit(0)).alias("extreme_anomaly_count"),
        volume_tier(F.col("mean_volume")).alias("volume_tier"),
        round_half_up(F.col("mean_day_volume"), 0).alias("true_avg_daily_volume"),
    )
