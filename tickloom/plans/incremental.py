"""Incremental loads of the two fact tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tickloom.plans import load_log
from tickloom.plans.intermediate import int_anomaly_summary, int_symbol_daily_stats
from tickloom.plans.marts import (
    LONG_MEAN,
    dim_symbols_of_days,
    fct_daily_market,
    fct_realtime_ohlcv,
    series_key,
    symbol_days,
)
from tickloom.plans.staging import stg_trades
from tickloom.sinks.tables import append_dates, replace_dates, replace_table
from tickloom.sources.warehouse import Warehouse


def last_date(table: DataFrame | None, date_col: str = "trade_date") -> dt.date | None:
    """The newest date of a table: one value per file reaches the aggregation, but every file is opened."""
    return None if table is None else table.agg(F.max(date_col)).first()[0]


def realtime_since(bars: DataFrame, since: dt.date, counts: DataFrame | None = None) -> DataFrame:
    """The bar fact for dates from ``since`` on.

    Earlier bars enter only as warm-up: the newest 49 of each symbol that still trades.
    Counts per symbol and date tell which dates hold them; only those partitions are then
    read. ``counts`` (series, trade_date, n_rows) are those of earlier loads; without them two
    columns of all earlier bars are scanned.
    """
    keyed = bars.withColumn("series", series_key())
    fresh = keyed.filter(F.col("trade_date") >= F.lit(since))
    older = keyed.filter(F.col("trade_date") < F.lit(since))
    if counts is None:
        counts = older.groupBy("series", "trade_date").agg(F.count("*").alias("n_rows"))
    else:
        counts = counts.filter(F.col("trade_date") < F.lit(since))
    needed = _warmup_dates(counts, fresh.select("series").distinct())
    dates = [row.trade_date for row in needed.select("trade_date").distinct().collect()]  # days, not bars
    newest = W.partitionBy("series").orderBy(F.col("window_start").desc())
    warmup = (
        older.filter(F.col("trade_date").isin(dates))
        .join(needed, ["series", "trade_date"], "left_semi")
        .withColumn("age", F.row_number().over(newest))
        .filter(F.col("age") < LONG_MEAN)
        .drop("age")
    )
    whole = fct_realtime_ohlcv(fresh.unionByName(warmup).drop("series"), ranged=False)
    return whole.filter(F.col("trade_date") >= F.lit(since))


def _warmup_dates(counts: DataFrame, traded: DataFrame) -> DataFrame:
    """Each series' latest dates that together hold the warm-up bars."""
    later_days = W.partitionBy("series").orderBy(F.col("trade_date").desc()).rowsBetween(W.unboundedPreceding, -1)
    return (
        counts.join(traded, "series", "left_semi")
        .withColumn("later", F.coalesce(F.sum("n_rows").over(later_days), F.lit(0)))
        .filter(F.col("later") < LONG_MEAN - 1)
        .select("series", "trade_date")
    )


def load_realtime(warehouse: Warehouse, bars: DataFrame, table: str = "fct_realtime_ohlcv") -> None:
    """Upsert: rebuild the newest loaded date and add later ones, a date at a time.

    Replacing whole dates also drops rows whose bars have gone from the source. The newest
    date and the warm-up dates come from the load log, so that a load reads its own and the
    warm-up partitions only. The log is written last: a load that fails before it is done again.
    """
    earlier = load_log.logged(warehouse, table)
    since = last_date(warehouse.read_or_none(table) if earlier is None else earlier)
    result = fct_realtime_ohlcv(bars) if since is None else realtime_since(bars, since, earlier)
    replace_dates(result, warehouse.path(table), cluster=("symbol", "window_start"))
    load_log.record(warehouse, table, series_key(), None if earlier is None else since)


def load_daily(
    warehouse: Warehouse,
    bars: DataFrame,
    anomalies: DataFrame,
    mode: str = "append_new",
    table: str = "fct_daily_market",
    through: dt.date | None = None,
) -> None:
    """Add days to the daily market.

    ``append_new`` adds days later than the newest loaded one, which stays as it is even
    if it was partial; ``through`` keeps days after it out, so that none is written before
    it is complete. ``reprocess_last`` rebuilds that day as well.
    """
    if mode not in ("append_new", "reprocess_last"):
        raise ValueError(f"unknown mode {mode}")
    since = last_date(warehouse.read_or_none(table))
    if through is not None:
        bars = bars.filter(F.col("trade_date") <= F.lit(through))
        anomalies = anomalies.filter(F.col("anomaly_date") <= F.lit(through))
    if since is not None:
        later = (lambda c: c > F.lit(since)) if mode == "append_new" else (lambda c: c >= F.lit(since))
        bars = bars.filter(later(F.col("trade_date")))
        anomalies = anomalies.filter(later(F.col("anomaly_date")))
    result = fct_daily_market(int_symbol_daily_stats(bars), int_anomaly_summary(anomalies))
    write = append_dates if mode == "append_new" else replace_dates
    write(result, warehouse.path(table))


def load_symbols(warehouse: Warehouse, raw: DataFrame, anomalies: DataFrame, table: str = "dim_symbols") -> None:
    """Rebuild the symbol dimension from a kept table of daily sums.

    Copies of a trade share its time, so each day can be summed on its own. Only days with
    trades loaded since the last run, late ones included, are read in full and replaced.
    """
    days = f"{table}_days"
    kept = warehouse.read_or_none(days)
    until = None if kept is None else kept.agg(F.max("loaded_until")).first()[0]
    if until is not None:
        raw = raw if "trade_date" in raw.columns else raw.withColumn("trade_date", F.to_date("event_time"))
        loaded = raw.filter(F.col("loaded_at") >= F.lit(until)).select("trade_date").distinct()
        dates = [row.trade_date for row in loaded.collect()]  # days, not trades
        changed = F.col("trade_date").isin([d for d in dates if d is not None])
        raw = raw.filter(changed | F.col("trade_date").isNull() if None in dates else changed)
    replace_dates(symbol_days(stg_trades(raw)), warehouse.path(days))
    replace_table(dim_symbols_of_days(warehouse.read(days), anomalies), warehouse.path(table))
