import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.operators import quality, reconcile

DAY = dt.date(2024, 1, 1)
SIDE = "symbol string, trade_date date, trade_count bigint, total_volume bigint, min_price double"


def compared(spark, batch, stream):
    side = lambda rows: spark.createDataFrame([(s, DAY, *rest) for s, *rest in rows], SIDE)
    return reconcile.compare(side(batch), side(stream))


@pytest.mark.parametrize(
    "streamed, expected",
    [(100, None), (99, None), (101, None), (98.5, "MEDIUM"), (95, "MEDIUM"), (94, "HIGH"), (106, "HIGH")],
)
def test_trade_count_tolerance(spark, streamed, expected):
    found = reconcile.discrepancies(compared(spark, [("A", 1000, 10, 1.0)], [("A", int(streamed * 10), 10, 1.0)])).collect()
    if expected is None:
        assert found == []
    else:
        assert [(r.issue, r.severity) for r in found] == [("TRADE_COUNT_MISMATCH", expected)]
        assert found[0].diff_pct == pytest.approx(abs(100 - streamed))


def test_volume_is_never_more_than_medium(spark):
    (row,) = reconcile.discrepancies(compared(spark, [("A", 10, 100, 1.0)], [("A", 10, 10, 1.0)])).collect()
    assert (row.issue, row.severity, row.batch_value, row.stream_value, row.diff_pct) == (
        "VOLUME_MISMATCH", "MEDIUM", 100.0, 10.0, 90.0)


def test_min_price_is_compared_exactly(spark):
    (row,) = reconcile.discrepancies(compared(spark, [("A", 10, 100, 1.0)], [("A", 10, 100, 1.01)])).collect()
    assert (row.issue, row.severity, row.diff_pct) == ("MIN_PRICE_MISMATCH", "LOW", None)


def test_missing_sides_skip_other_checks(spark):
    both = compared(spark, [("A", 10, 100, 1.0), ("C", 1, 1, 1.0)], [("B", 10, 100, 1.0), ("C", 1, 1, 1.0)])
    found = {r.symbol: (r.issue, r.severity) for r in reconcile.discrepancies(both).collect()}
    assert found == {"A": ("MISSING_FROM_STREAM", "HIGH"), "B": ("MISSING_FROM_BATCH", "HIGH")}
    report = reconcile.report(both, DAY)
    row = report.first()
    assert (row.status, row.symbols_checked, row.discrepancy_count, row.high_severity_count) == ("FAIL", 3, 2, 2)
    assert row.details.index('"A"') < row.details.index('"B"')
    assert "Discrepancies: 2\nHigh Severity: 2" in reconcile.failure_text(report).first().text
    with pytest.raises(reconcile.ReconciliationFailed, match="2 high-severity"):
        reconcile.gate(report)


def test_clean_and_empty_days_pass(spark):
    clean = reconcile.report(compared(spark, [("A", 10, 100, 1.0)], [("A", 10, 100, 1.0)]))
    assert clean.first().status == "PASS"
    reconcile.gate(clean)
    empty = reconcile.report(compared(spark, [], []), DAY).first()
    assert (empty.status, empty.symbols_checked, empty.discrepancy_count) == ("PASS", 0, 0)


def test_quality_checks(spark):
    table = spark.createDataFrame([("A", "x"), ("A", None), (None, "y"), ("B", "z")], "symbol string, kind string")
    checks = quality.TableChecks(not_null=["symbol"], accepted={"kind": ["x", "y"]}, unique=["symbol"])
    rows = {r.check_name: (r.failures, r.status) for r in quality.check_table(table, "t", checks).collect()}
    assert rows == {"not_null": (1, "fail"), "accepted_values": (1, "fail"), "unique": (1, "fail")}
    with pytest.raises(quality.ChecksFailed, match="t.symbol unique: 1"):
        quality.require(quality.check_table(table, "t", checks))


@pytest.mark.parametrize("minutes, status", [(5, "pass"), (6, "warn"), (30, "warn"), (31, "error")])
def test_freshness(spark, minutes, status):
    table = spark.range(1).select(F.lit("2024-01-01 00:00:00").cast("timestamp").alias("loaded_at"))
    as_of = F.lit(f"2024-01-01 00:{minutes:02d}:00").cast("timestamp")
    assert quality.freshness(table, "t", as_of).first().status == status


def test_an_empty_table_is_stale(spark):
    empty = spark.createDataFrame([], "loaded_at timestamp")
    assert quality.freshness(empty, "t", F.lit("2024-01-01").cast("timestamp")).first().status == "error"
