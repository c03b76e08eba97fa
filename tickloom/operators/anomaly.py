"""Rolling z-scores per symbol and the anomaly events drawn from them.

A trade is scored against the trades before it, itself excluded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tickloom import schemas as S
from tickloom.functions import classify
from tickloom.functions.rounding import round_half_up
from tickloom.functions.temporal import iso_text
from tickloom.operators import rolling

def time_grain(ts: str, seconds: int = 60) -> Column:
    return F.expr(f"unix_seconds({ts}) div {seconds}")


def zscore(value: Column, mean: Column, deviation: Column) -> Column:
    """0 where the deviation is 0, or so near it that only rounding error is left."""
    flat = deviation <= F.lit(1e-12) * F.abs(mean)
    return F.when(flat, 0.0).otherwise((value - mean) / deviation)


def _with_zscores(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f"{v}_zscore": zscore(F.col(v), F.col(f"{v}_mean"), F.col(f"{v}_std")) for v in ("price", "volume")}
    )


def arrival_order(trades: DataFrame, tie_break: list[str] | None) -> list[str]:
    """Event time, then the given columns; by default ``seq``, or every value of a trade."""
    if tie_break is None:
        tie_break = ["seq"] if "seq" in trades.columns else ["price", "volume"]
    return ["event_time", *tie_break]


def score(
    trades: DataFrame,
    lookback: int = S.LOOKBACK,
    chunk_rows: int = rolling.CHUNK_ROWS,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """Add mean, deviation and z-score of price and volume; one symbol spreads over many tasks.

    The trades are read once, when this is called, and written in the order of their series.
    """
    order = arrival_order(trades, tie_break)
    usable = trades.dropna(subset=["symbol", "price", "volume", "event_time"])
    placed = rolling.place(usable, "symbol", order)
    return score_placed(placed, lookback, chunk_rows, rolling.chunk_tasks(placed)).drop(rolling.POSITION)


def score_placed(
    placed: DataFrame, lookback: int = S.LOOKBACK, chunk_rows: int = rolling.CHUNK_ROWS, tasks: int | None = None
) -> DataFrame:
    """The same for trades that already carry their position within the symbol."""
    chunks = rolling.with_chunks(placed, "symbol", lookback, chunk_rows, tasks)
    return _with_zscores(rolling.prior_stats(chunks, "symbol", ["price", "volume"], lookback))


def score_by_symbol(trades: DataFrame, lookback: int = S.LOOKBACK, tie_break: list[str] | None = None) -> DataFrame:
    """The textbook form: one window per symbol. Short and exact, but one task per symbol."""
    frame = W.partitionBy("symbol").orderBy(*arrival_order(trades, tie_break)).rowsBetween(-lookback, -1)
    usable = trades.dropna(subset=["symbol", "price", "volume", "event_time"])
    counted = usable.withColumn("prior_rows", F.count("*").over(frame))
    n = F.col("prior_rows")
    stats = {}
    for v in ("price", "volume"):
        stats[f"{v}_mean"] = F.when(n > 1, F.avg(v).over(frame)).otherwise(0.0)
        stats[f"{v}_std"] = F.when(n > 2, F.stddev_samp(v).over(frame)).otherwise(0.0)
    return _with_zscores(counted.withColumns(stats).drop("prior_rows"))


def anomalies(scored: DataFrame, threshold: float = S.Z_THRESHOLD, detected_at: Column | None = None) -> DataFrame:
    """Anomaly events: trades whose price or volume z-score reaches the threshold.

    The filter and the severity use the full z-scores; the event holds rounded ones.
    """
    price_z, volume_z = F.abs("price_zscore"), F.abs("volume_zscore")
    price_hit, volume_hit = price_z >= threshold, volume_z >= threshold
    stamp = detected_at if detected_at is not None else F.current_timestamp()
    kept = [c for c in ("seq",) if c in scored.columns]
    return scored.filter(price_hit | volume_hit).select(
        *kept,
        "symbol",
        "price",
        "volume",
        iso_text(F.col("event_time")).alias("timestamp"),
        round_half_up(F.col("price_zscore"), 4).alias("price_zscore"),
        round_half_up(F.col("volume_zscore"), 4).alias("volume_zscore"),
        round_half_up(F.col("price_mean"), 4).alias("price_mean"),
        round_half_up(F.col("price_std"), 4).alias("price_std"),
        round_half_up(F.col("volume_mean"), 2).alias("volume_mean"),
        round_half_up(F.col("volume_std"), 2).alias("volume_std"),
        classify.severity(F.greatest(price_z, volume_z)).alias("severity"),
        classify.anomaly_type(price_hit, volume_hit).alias("anomaly_type"),
        iso_text(stamp).alias("detected_at"),
    )


def with_anomaly_date(anomalies: DataFrame) -> DataFrame:
    """Add the day of the trade, by which the anomaly table is partitioned."""
    return anomalies.withColumn("anomaly_date", F.to_date(F.try_to_timestamp(F.col("timestamp"))))
