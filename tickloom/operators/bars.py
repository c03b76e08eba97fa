"""Open/high/low/close/volume bars; the same code serves tables and streams."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.ordering import trade_order


def ohlcv(
    trades: DataFrame,
    duration: str,
    slide: str | None = None,
    order_by: str | Column | None = None,
    processed_at: Column | None = None,
) -> DataFrame:
    """Bars per symbol over tumbling (or, with ``slide``, sliding) event-time windows.

    ``order_by`` decides open and close: by default event time, ties broken by ``seq`` or,
    without it, by price. Any fixed-width column (a time, a message offset) keeps the
    aggregation hash-based with map-side combining, so a hot symbol shuffles one row per
    window and task; a struct would turn it into a sort.

    ``vwap`` is the plain mean price; ``vwap_weighted`` weighs it by volume.
    """
    order = trade_order(trades) if order_by is None else F.col(order_by) if isinstance(order_by, str) else order_by
    stamp = processed_at if processed_at is not None else F.current_timestamp()
    if slide and not trades.isStreaming and _covers_whole_panes(duration, slide):
        merged = _merged_panes(trades, duration, slide, order)
    else:
        merged = _windows(trades, duration, slide, order)
    return merged.select(
        "symbol",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "trade_count",
        (F.col("price_sum") / F.nullif(F.col("prices"), F.lit(0))).alias("vwap"),
        (F.col("turnover") / F.nullif(F.col("volume"), F.lit(0))).alias("vwap_weighted"),
        "window_start",
        "window_end",
        F.lit(duration).alias("window_duration"),
        stamp.alias("processed_at"),
    )


def _windows(trades: DataFrame, duration: str, slide: str | None, order: Column, *extra: Column) -> DataFrame:
    return (
        trades.groupBy("symbol", F.window("event_time", duration, slide).alias("bar"))
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("volume").alias("volume"),
            F.count("*").alias("trade_count"),
            F.sum("price").alias("price_sum"),
            F.count("price").alias("prices"),
            F.sum(F.col("price") * F.col("volume")).alias("turnover"),
            *extra,
        )
        .withColumns({"window_start": F.col("bar.start"), "window_end": F.col("bar.end")})
        .drop("bar")
    )


def _merged_panes(trades: DataFrame, duration: str, slide: str, order: Column) -> DataFrame:
    """Sliding windows put together from tumbling panes of one slide.

    Each trade is aggregated once, into its pane; only panes are copied into the windows
    that cover them.
    """
    panes = _windows(
        trades, slide, None, order, F.min(order).alias("first_order"), F.max(order).alias("last_order")
    )
    step, length = F.expr(f"interval {slide}"), F.expr(f"interval {duration}")
    pane = F.col("window_start")
    covering = F.sequence(pane - length + step, pane, step)
    return (
        panes.withColumn("covering", F.explode(covering))
        .groupBy("symbol", "covering")
        .agg(
            F.min_by("open", "first_order").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "last_order").alias("close"),
            *[F.sum(c).alias(c) for c in ("volume", "trade_count", "price_sum", "prices", "turnover")],
        )
        .withColumnRenamed("covering", "window_start")
        .withColumn("window_end", F.col("window_start") + length)
    )


def _covers_whole_panes(duration: str, slide: str) -> bool:
    lengths = [_fixed_length(text) for text in (duration, slide)]
    return None not in lengths and lengths[0] % lengths[1] == dt.timedelta(0)


def _fixed_length(text: str) -> dt.timedelta | None:
    """The length of a plain duration such as ``5 minutes``; None for any other wording."""
    found = re.fullmatch(r"(\d+) (second|minute|hour|day|week)s?", text.strip())
    return dt.timedelta(**{found[2] + "s": int(found[1])}) if found else None
