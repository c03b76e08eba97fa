"""The daily job, for a day or a range of days: summary, marts, checks, reconciliation, gate, in that order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tickloom.operators import quality, reconcile
from tickloom.operators.daily import daily_summary
from tickloom.plans.incremental import load_daily, load_realtime, load_symbols
from tickloom.plans.staging import stg_anomalies, stg_ohlcv_1min
from tickloom.schemas import RAW_TRADES
from tickloom.sinks.tables import append_log, drop_dates, replace_dates
from tickloom.sources.warehouse import Warehouse


def days_of(first: dt.date, last: dt.date) -> list[dt.date]:
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def aggregate_range(warehouse: Warehouse, first: dt.date, last: dt.date) -> list[dict]:
    """Replace the days first..last of the daily summary; returns each day and its row count.

    The trades are read once for the whole range. Rows carry the time of their run: a day that
    still holds rows of an earlier run has no trades any more, and loses them. So a range can be
    run again, also after a run that failed half-way, with the same result.
    """
    stamp = dt.datetime.now(dt.timezone.utc)
    path, mine = warehouse.path("daily_summary_batch"), F.col("computed_at") == F.lit(stamp)
    replace_dates(daily_summary(warehouse.read(RAW_TRADES), first, last, computed_at=F.lit(stamp)), path)
    table = warehouse.read_or_none("daily_summary_batch")
    counts = {}
    if table is not None:
        written = table.filter(F.col("trade_date").between(first, last)).groupBy("trade_date")
        counts = {r.trade_date: r.n for r in written.agg(F.count_if(mine).alias("n")).collect()}  # days
    drop_dates(warehouse.spark, path, [day for day, n in counts.items() if n == 0])
    return [{"date": day.isoformat(), "rows": counts.get(day, 0)} for day in days_of(first, last)]


def aggregate_day(warehouse: Warehouse, day: dt.date) -> dict:
    """Replace one day of the daily summary; returns the day and its row count.

    A day whose trades are gone loses its rows; a day without trades writes none.
    """
    return aggregate_range(warehouse, day, day)[0]


def build_marts(warehouse: Warehouse, through: dt.date | None = None) -> None:
    """Load the marts; with ``through``, days after it, which may be partial, wait."""
    bars = stg_ohlcv_1min(warehouse.read("ohlcv_1min"))
    anomalies = stg_anomalies(warehouse.read("anomalies"))
    load_realtime(warehouse, bars)
    load_daily(warehouse, bars, anomalies, through=through)
    load_symbols(warehouse, warehouse.read(RAW_TRADES), anomalies)


def check_marts(warehouse: Warehouse, since: dt.date | None = None) -> None:
    """Check the marts; with ``since``, of dated ones only the days from then on, which a run has written."""
    marts = {name: warehouse.read(name) for name in quality.MART_CHECKS}
    if since is not None:
        marts = {n: df.filter(F.col("trade_date") >= F.lit(since)) if "trade_date" in df.columns else df for n, df in marts.items()}
    quality.require(quality.check_marts(marts))


def reconcile_range(warehouse: Warehouse, first: dt.date, last: dt.date) -> None:
    """Log a report for each of the days, then raise if one holds a severe discrepancy.

    Both sides are read once. A day without trades on either side passes with no symbols.
    """
    days = days_of(first, last)
    compared = reconcile.compare(
        reconcile.batch_side(warehouse.read(RAW_TRADES), first, last),
        reconcile.stream_side(warehouse.read("ohlcv_1min"), first, last),
    )
    compared = compared.persist()  # one row per symbol and day, read for the list and for the counts
    try:
        reconcile.write_discrepancies(compared, warehouse.path("discrepancies"), days)
        every = warehouse.spark.createDataFrame([(day,) for day in days], "reconciliation_date date")
        outcome = every.join(reconcile.summary(compared), "reconciliation_date", "left").fillna({"status": "PASS"}).fillna(0)
        append_log(outcome, warehouse.path("reconciliation_log"))
        reconcile.gate(outcome)
    finally:
        compared.unpersist()


def reconcile_day(warehouse: Warehouse, day: dt.date) -> None:
    """Log the day's report, then raise if it holds a severe discrepancy."""
    reconcile_range(warehouse, day, day)


def run_range(warehouse: Warehouse, first: dt.date, last: dt.date) -> list[dict]:
    """Everything for the days first..last, a backfill: one plan per step, whatever the number of days."""
    if last < first:
        raise ValueError(f"{last} lies before {first}")
    result = aggregate_range(warehouse, first, last)
    build_marts(warehouse, through=last)
    check_marts(warehouse, since=first)
    reconcile_range(warehouse, first, last)
    return result


def run_day(warehouse: Warehouse, day: dt.date | None = None) -> dict:
    """Everything for one day, by default yesterday."""
    day = day or dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)
    return run_range(warehouse, day, day)[0]
