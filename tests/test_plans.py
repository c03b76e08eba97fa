"""The physical plans the operators are meant to have."""

import datetime as dt

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tickloom.operators import anomaly, reconcile
from tickloom.operators.bars import ohlcv
from tickloom.operators.daily import daily_summary
from tickloom.plans.intermediate import int_symbol_daily_stats
from tickloom.plans.marts import fct_realtime_ohlcv
from tickloom.plans.staging import stg_trades
from tickloom.session import run_dir
from tickloom.sinks.tables import replace_dates
from tickloom.sources import events
from tickloom.sources.events import read_trades


@pytest.fixture(scope="module")
def trades(spark):
    path = run_dir(spark, "plans") + "/trades"
    replace_dates(read_trades(spark, SF).withColumn("trade_date", F.to_date("event_time")), path)
    return spark.read.parquet(path)


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_combine_before_one_shuffle(trades):
    text = plan(ohlcv(trades, "1 minute"))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in text and "partial_min_by" in text
    assert "exchange" not in text.split("ReadSchema")[1]


def test_day_filter_prunes_partitions_and_reaches_the_scan(trades):
    day = dt.date(2024, 1, 15)
    text = plan(daily_summary(trades, day, day))
    assert "GreaterThanOrEqual(event_time,2024-01-15" in text and "LessThan(event_time,2024-01-16" in text
    assert "PartitionFilters: [isnotnull(trade_date" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_dedup_cuts_copies_before_the_shuffle(trades):
    text = plan(stg_trades(trades))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange hashpartitioning") == 1


def test_damaged_ticks_are_dealt_once_over_tasks_by_rows(trades, monkeypatch):
    monkeypatch.setattr(events, "TASK_ROWS", 150)
    text = plan(events.damaged_ticks(trades))
    assert "Join" not in text and text.count("FileScan") == 1
    assert text.count("Exchange") == 1
    dealt = text.split("Exchange hashpartitioning(seq")[1].split(")")[0]
    assert int(dealt.split(", ")[1]) == -(-trades.count() // 150) > 4


def test_daily_stats_scan_once(trades):
    bars = trades.selectExpr(
        "symbol", "trade_date", "event_time as window_start", "hour(event_time) as trade_hour", "price as open",
        "price as high", "price as low", "price as close", "volume", "1L as trade_count", "price as vwap",
        "0.0D as bar_return_pct",
    )
    text = plan(int_symbol_daily_stats(bars))
    assert text.count("FileScan") == 1 and "SortAggregate" not in text


def test_reconciliation_shuffles_trades_once_and_then_sums_only(trades):
    compared = reconcile.compare(
        reconcile.batch_side(trades), reconcile.stream_side(trades.selectExpr(
            "symbol", "event_time as window_start", "event_time as window_end", "1L as trade_count",
            "price as close", "price as low", "price as high", "volume"))
    )
    text = plan(compared)
    # one exchange a side to sum; the null-safe join deals the sums, one row per symbol and day, again
    assert text.count("Exchange hashpartitioning") == 4 and "FullOuter" in text


def test_scoring_spreads_symbols_and_counts_from_narrow_columns(trades):
    text = plan(anomaly.score(trades))
    assert "hashpartitioning(symbol" in text and "chunk" in text
    assert "Cartesian" not in text and "NestedLoop" not in text
    # the second scan only counts; it does not read the columns that are carried along
    counting = text.split("ReadSchema")[-1]
    assert "exchange" not in counting and "loaded_at" not in counting


def test_plain_moving_averages_need_one_shuffle(trades):
    bars = trades.selectExpr(
        "symbol", "trade_date", "event_time as window_start", "event_time as window_end", "hour(event_time) as trade_hour",
        "price as open", "price as high", "price as low", "price as close", "volume", "1L as trade_count",
        "price as vwap", "0.0D as bar_return_pct", "0.0D as price_range",
    )
    text = plan(fct_realtime_ohlcv(bars, chunk_rows=None))
    assert text.count("Exchange hashpartitioning") <= 2


def test_detection_day_reaches_the_scan(spark):
    from tickloom import schemas as S
    from tickloom.plans.dashboards import recent_anomalies

    path = run_dir(spark, "plans") + "/anomalies"
    spark.createDataFrame([], S.ANOMALY).write.parquet(path)
    text = plan(recent_anomalies(spark.read.schema(S.ANOMALY).parquet(path), dt.date(2024, 1, 15)))
    assert "GreaterThanOrEqual(detected_at,2024-01-15)" in text and "LessThan(detected_at,2024-01-16)" in text
    assert "TakeOrderedAndProject" in text


def test_incremental_reads_only_the_dates_it_needs(spark, trades):
    from tickloom.plans.incremental import realtime_since

    bars = trades.selectExpr(
        "symbol", "trade_date", "event_time as window_start", "event_time as window_end", "hour(event_time) as trade_hour",
        "price as open", "price as high", "price as low", "price as close", "volume", "1L as trade_count",
        "price as vwap", "0.0D as bar_return_pct", "0.0D as price_range",
    )
    text = plan(realtime_since(bars, dt.date(2024, 1, 28)))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert all("PartitionFilters: [" in line and "trade_date" in line.split("PartitionFilters")[1] for line in scans)
    assert any("IN (" in line or "INSET" in line or " IN " in line for line in scans)


def test_scores_read_the_trades_once_and_spread_chunks_by_rows(spark, trades):
    from tickloom.operators import rolling

    scored = anomaly.score(trades)
    text = plan(scored)
    scans = [line for line in text.splitlines() if "FileScan" in line]
    # the trades in series order, and the spans counted from three narrow columns of them
    assert len(scans) == 2 and all("/trades" not in s for s in scans)
    assert "ReadSchema: struct<symbol:string,part:int,line:bigint>" in scans[1]
    many = anomaly.score_placed(rolling.place(trades.dropna(), "symbol", ["event_time", "seq"]), tasks=37)
    assert "chunk" in plan(many) and ", 37)" in plan(many)
    assert rolling.chunk_tasks(spark.range(250_001)) == 3


def test_bars_are_built_once_for_moving_averages(trades):
    from tickloom.plans.staging import stg_ohlcv_1min

    text = plan(fct_realtime_ohlcv(stg_ohlcv_1min(ohlcv(trades, "1 minute"))))
    assert "min_by" not in text and "window(" not in text
    assert len([line for line in text.splitlines() if "FileScan" in line]) == 2


def test_written_series_can_be_released(spark, trades):
    from tickloom.session import folder_exists, release_runs, written

    path = written(spark.range(3), "released").inputFiles()[0].rsplit("/", 1)[0]
    assert folder_exists(spark, path) and release_runs(spark) > 0 and not folder_exists(spark, path)


def test_all_checks_of_a_mart_take_one_scan(trades):
    from tickloom.operators.quality import TableChecks, check_table

    checks = TableChecks(not_null=["symbol", "price"], accepted={"symbol": ["view"]}, unique=["symbol"])
    text = plan(check_table(trades, "trades", checks))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
