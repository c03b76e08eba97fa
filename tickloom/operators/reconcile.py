"""Comparison of the streaming bars with the raw trades, per symbol and day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rounding import round_half_up
from tickloom.functions.temporal import on_days
from tickloom.sinks.tables import drop_dates, replace_dates

# Relative tolerances.
TOLERANCE = 0.01
SEVERE = 0.05

# Fixed value: the text of the failure alert.
FAILURE_TEXT = (
    ":warning: *Stock Pipeline Reconciliation Failed*\nDate: %s\nDiscrepancies: %d\nHigh Severity: %d"
)

_ISSUE = "struct<issue:string,severity:string,batch_value:double,stream_value:double,diff_pct:double>"


def batch_side(trades: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    return (
        on_days(trades, "event_time", first, last)
        .withColumn("trade_date", F.to_date("event_time"))
        .groupBy("symbol", "trade_date")
        .agg(
            F.count("*").alias("trade_count"),
            round_half_up(F.avg("price"), 4).alias("avg_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.sum("volume").alias("total_volume"),
            F.min("event_time").alias("first_trade"),
            F.max("event_time").alias("last_trade"),
        )
    )


def stream_side(bars: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    return (
        on_days(bars, "window_start", first, last)
        .withColumn("trade_date", F.to_date("window_start"))
        .groupBy("symbol", "trade_date")
        .agg(
            F.sum("trade_count").alias("trade_count"),
            round_half_up(F.avg("close"), 4).alias("avg_price"),
            F.min("low").alias("min_price"),
            F.max("high").alias("max_price"),
            F.sum("volume").alias("total_volume"),
            F.min("window_start").alias("first_window"),
            F.max("window_end").alias("last_window"),
        )
    )


def _issue(name: str, severity: Column, batch: Column | None = None, stream: Column | None = None, diff: Column | None = None) -> Column:
    null = F.lit(None)
    parts = [F.lit(name), severity, *[p if p is not None else null for p in (batch, stream, diff)]]
    names = ["issue", "severity", "batch_value", "stream_value", "diff_pct"]
    return F.struct(*[p.alias(n) for p, n in zip(parts, names)]).cast(_ISSUE)


def compare(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """One row per symbol and day on either side, with the array of its issues (0 to 3).

    Null symbols and days match each other, so that messages without them are compared too.
    """
    measures = ["trade_count", "total_volume", "min_price"]
    keys = ["symbol", "trade_date"]
    b = batch.select(*keys, F.lit(True).alias("in_batch"), *[F.col(m).alias(f"b_{m}") for m in measures])
    s = stream.select(*[F.col(k).alias(f"s_{k}") for k in keys], F.lit(True).alias("in_stream"), *[F.col(m).alias(f"s_{m}") for m in measures])

    def relative(measure: str) -> Column:
        base = F.greatest(F.col(f"b_{measure}"), F.lit(1))
        return F.abs(F.col(f"b_{measure}") - F.col(f"s_{measure}")) / base

    def mismatch(name: str, measure: str, severity: Column) -> Column:
        diff = relative(measure)
        found = _issue(name, severity, F.col(f"b_{measure}"), F.col(f"s_{measure}"), round_half_up(diff * 100, 2))
        return F.when(diff > TOLERANCE, found)

    high, medium, low = F.lit("HIGH"), F.lit("MEDIUM"), F.lit("LOW")
    count_severity = F.when(relative("trade_count") > SEVERE, high).otherwise(medium)
    checks = F.filter(
        F.array(
            mismatch("TRADE_COUNT_MISMATCH", "trade_count", count_severity),
            mismatch("VOLUME_MISMATCH", "total_volume", medium),
            F.when(
                F.col("b_min_price") != F.col("s_min_price"),
                _issue("MIN_PRICE_MISMATCH", low, F.col("b_min_price"), F.col("s_min_price")),
            ),
        ),
        lambda issue: issue.isNotNull(),
    )
    issues = (
        F.when(F.col("in_batch").isNull(), F.array(_issue("MISSING_FROM_BATCH", high)))
        .when(F.col("in_stream").isNull(), F.array(_issue("MISSING_FROM_STREAM", high)))
        .otherwise(checks)
    )
    same = F.col("symbol").eqNullSafe(F.col("s_symbol")) & F.col("trade_date").eqNullSafe(F.col("s_trade_date"))
    either = [F.coalesce(key, f"s_{key}").alias(key) for key in keys]
    return b.join(s, same, "full_outer").select(*either, issues.alias("issues"))


def discrepancies(compared: DataFrame) -> DataFrame:
    return compared.select("symbol", "trade_date", F.explode("issues").alias("found")).select(
        "symbol", "trade_date", "found.*"
    )


def report(compared: DataFrame, day: dt.date | None = None) -> DataFrame:
    """One row per day, or exactly one row for ``day`` even when it has no symbols.

    ``details`` lists the day's discrepancies: at most three per symbol.
    """
    rows = compared if day is None else compared.filter(F.col("trade_date") == F.lit(day))
    grouped = rows.groupBy("trade_date") if day is None else rows.groupBy()
    tagged = F.transform(
        "issues", lambda i: F.struct(F.col("symbol"), i["issue"].alias("issue"), i["severity"].alias("severity"),
                                     i["batch_value"].alias("batch_value"), i["stream_value"].alias("stream_value"),
                                     i["diff_pct"].alias("diff_pct"))
    )
    high = F.size(F.filter("issues", lambda i: i["severity"] == "HIGH"))
    agg = grouped.agg(
        F.count("*").alias("symbols_checked"),
        F.coalesce(F.sum(F.size("issues")), F.lit(0)).alias("discrepancy_count"),
        F.coalesce(F.sum(high), F.lit(0)).alias("high_severity_count"),
        F.to_json(F.sort_array(F.flatten(F.collect_list(tagged)))).alias("details"),
    )
    date = F.col("trade_date") if day is None else F.lit(day)
    return agg.select(
        date.alias("reconciliation_date"),
        F.when(F.col("discrepancy_count") == 0, "PASS").otherwise("FAIL").alias("status"),
        "symbols_checked",
        "discrepancy_count",
        "high_severity_count",
        "details",
    )


def summary(compared: DataFrame, day: dt.date | None = None) -> DataFrame:
    """The report without its list: counts only, however many symbols differ.

    One row per day, or exactly one for ``day``. The list is ``discrepancies``, a table.
    """
    rows = compared if day is None else compared.filter(F.col("trade_date") == F.lit(day))
    grouped = rows.groupBy("trade_date") if day is None else rows.groupBy()
    high = F.size(F.filter("issues", lambda i: i["severity"] == "HIGH"))
    agg = grouped.agg(
        F.count("*").alias("symbols_checked"),
        F.coalesce(F.sum(F.size("issues")), F.lit(0)).alias("discrepancy_count"),
        F.coalesce(F.sum(high), F.lit(0)).alias("high_severity_count"),
    )
    date = F.col("trade_date") if day is None else F.lit(day)
    return agg.select(
        date.alias("reconciliation_date"),
        F.when(F.col("discrepancy_count") == 0, "PASS").otherwise("FAIL").alias("status"),
        "symbols_checked",
        "discrepancy_count",
        "high_severity_count",
    )


def write_discrepancies(compared: DataFrame, path: str, days: Iterable[dt.date]) -> None:
    """Replace the dated table's rows of ``days`` by the discrepancies of a comparison."""
    days = list(days)
    found = discrepancies(compared).filter(F.col("trade_date").isin(days))
    clean = set(days) - {r["trade_date"] for r in found.select("trade_date").distinct().collect()}
    drop_dates(compared.sparkSession, path, clean)
    replace_dates(found, path)


def failure_text(reports: DataFrame) -> DataFrame:
    """The alert text of each day's report."""
    return reports.select(
        "reconciliation_date",
        F.format_string(
            FAILURE_TEXT,
            F.col("reconciliation_date").cast("string"),
            F.col("discrepancy_count"),
            F.col("high_severity_count"),
        ).alias("text"),
    )


class ReconciliationFailed(RuntimeError):
    pass


def gate(reports: DataFrame) -> None:
    """Raise when any day has a discrepancy of high severity; reads one aggregated row."""
    high = reports.agg(F.sum("high_severity_count")).first()[0] or 0
    if high > 0:
        raise ReconciliationFailed(f"Reconciliation found {high} high-severity discrepancies")
