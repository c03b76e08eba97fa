import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions import classify
from tickloom.operators.bars import ohlcv
from tickloom.operators.daily import daily_summary
from tickloom.plans.intermediate import int_symbol_daily_stats
from tickloom.plans.marts import fct_realtime_ohlcv
from tickloom.plans.staging import stg_ohlcv_1min, stg_trades


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "pct, expected",
    [(2.0001, "strong_up"), (2.0, "up"), (0.0001, "up"), (0.0, "down"), (-1.9999, "down"), (-2.0, "strong_down"),
     (None, "strong_down")],
)
def test_trend_direction(spark, pct, expected):
    assert value(spark, classify.trend_direction(F.lit(pct).cast("double"))) == expected


@pytest.mark.parametrize(
    "deviation, expected", [(2.01, "high"), (2.0, "medium"), (1.01, "medium"), (1.0, "low"), (None, "low")]
)
def test_volatility_regime(spark, deviation, expected):
    assert value(spark, classify.volatility_regime(F.lit(deviation).cast("double"), F.lit(100.0))) == expected


@pytest.mark.parametrize(
    "volume, expected",
    [(10_000_001, "mega_cap"), (10_000_000, "large_cap"), (1_000_000, "mid_cap"), (100_001, "mid_cap"),
     (100_000, "small_cap"), (None, "small_cap")],
)
def test_volume_tier(spark, volume, expected):
    assert value(spark, classify.volume_tier(F.lit(volume).cast("double"))) == expected


@pytest.mark.parametrize("volume, expected", [(21, "high"), (20, "elevated"), (15, "normal"), (16, "elevated")])
def test_volume_signal(spark, volume, expected):
    assert value(spark, classify.volume_signal(F.lit(volume), F.lit(10.0))) == expected


@pytest.mark.parametrize(
    "close, short, long, expected",
    [(3, 2, 1, "bullish"), (1, 2, 3, "bearish"), (2, 2, 1, "neutral"), (3, 2, 2, "neutral"), (None, 2, 1, "neutral")],
)
def test_trend_signal(spark, close, short, long, expected):
    columns = [F.lit(x).cast("double") for x in (close, short, long)]
    assert value(spark, classify.trend_signal(*columns)) == expected


@pytest.mark.parametrize(
    "hour, expected",
    [(8, "extended_hours"), (9, "market_open"), (10, "market_open"), (11, "midday"), (14, "midday"),
     (15, "market_close"), (16, "market_close"), (17, "extended_hours")],
)
def test_session_by_hour(trades_of, hour, expected):
    row = stg_trades(trades_of([("A", 1.0, 1, (hour - 9) * 3600)])).first()
    assert (row.trade_hour, row.trading_session) == (hour, expected)


def test_session_in_a_zone(trades_of):
    row = stg_trades(trades_of([("A", 1.0, 1, 6 * 3600)]), tz="America/New_York").first()
    assert (row.trade_hour, row.trading_session) == (10, "market_open")


def test_latest_load_wins(trades_of):
    trades = trades_of([("A", 1.0, 1, 0), ("A", 2.0, 1, 0), ("B", 3.0, 1, 0)])
    later = trades.withColumn("loaded_at", F.expr("loaded_at + make_interval(0, 0, 0, 0, 0, 0, 2 - seq)"))
    assert {(r.symbol, r.price) for r in stg_trades(later).collect()} == {("A", 1.0), ("B", 3.0)}


def test_bar_over_a_minute(trades_of):
    trades = trades_of([("A", 5.0, 10, 3), ("A", 7.0, 0, 1), ("A", 1.0, 30, 59), ("A", 2.0, 1, 60)])
    first = ohlcv(trades, "1 minute").orderBy("window_start").first()
    assert (first.open, first.high, first.low, first.close) == (7.0, 7.0, 1.0, 1.0)
    assert (first.volume, first.trade_count) == (40, 3)
    assert first.vwap == pytest.approx(13 / 3)
    assert first.vwap_weighted == 2.0


def test_ties_are_settled_by_a_struct(trades_of):
    trades = trades_of([("A", float(p), 1, 0) for p in (4, 9, 2)])
    bar = ohlcv(trades, "1 minute", order_by=F.struct("event_time", "seq")).first()
    assert (bar.open, bar.close) == (4.0, 2.0)
    by_arrival = ohlcv(trades, "1 minute", order_by="seq").first()
    assert (by_arrival.open, by_arrival.close) == (4.0, 2.0)


def test_sliding_bars_overlap(trades_of):
    bars = ohlcv(trades_of([("A", 5.0, 10, 3)]), "5 minutes", "1 minute")
    assert bars.count() == 5


def test_undated_trades_are_in_no_bar(trades_of):
    trades = trades_of([("A", 5.0, 10, 3)]).withColumn("event_time", F.lit(None).cast("timestamp"))
    assert ohlcv(trades, "1 minute").count() == 0


def test_zero_open_gives_no_return(trades_of):
    row = daily_summary(trades_of([("A", 0.0, 1, 0), ("A", 5.0, 1, 1)])).first()
    assert row.daily_return_pct is None
    single = daily_summary(trades_of([("A", 3.0, 1, 0)])).first()
    assert (single.price_stddev, single.daily_return_pct) == (None, 0.0)


def test_mean_on_a_rounding_tie(trades_of):
    prices = [0.01] * 7 + [0.0104 * 8 - 0.07 - 0.0004]  # mean 0.01035
    row = daily_summary(trades_of([("A", p, 1, i) for i, p in enumerate(prices)])).first()
    assert row.avg_price == pytest.approx(0.0104)


def test_day_filter(trades_of):
    trades = trades_of([("A", 1.0, 1, 0), ("A", 1.0, 1, 86400), ("A", 1.0, 1, 15 * 3600)])
    day = dt.date(2024, 1, 1)
    (row,) = daily_summary(trades, day, day).collect()
    assert (row.trade_date, row.trade_count) == (day, 1)


def bars_of(trades_of, closes, step=60, volume=10):
    return stg_ohlcv_1min(ohlcv(trades_of([("A", float(c), volume, i * step) for i, c in enumerate(closes)]), "1 minute"))


def test_day_close_is_the_highest_of_the_last_hour(trades_of):
    stats = int_symbol_daily_stats(bars_of(trades_of, [9, 7, 8, 5, 4], step=1200)).first()
    assert (stats.day_open, stats.day_close) == (4.0, 5.0)
    assert (stats.day_open_first, stats.day_close_last) == (9.0, 4.0)


def test_single_bar_day(trades_of):
    stats = int_symbol_daily_stats(bars_of(trades_of, [9])).first()
    assert stats.intraday_volatility is None
    assert stats.daily_return_pct == 0.0


def test_chunked_moving_averages_equal_the_plain_ones(trades_of):
    bars = bars_of(trades_of, [(i * 37) % 101 for i in range(400)], step=600).drop("processed_at")
    chunked = fct_realtime_ohlcv(bars, chunk_rows=60)
    plain = fct_realtime_ohlcv(bars, chunk_rows=None)
    assert chunked.count() == 400
    assert chunked.exceptAll(plain).count() == plain.exceptAll(chunked).count() == 0


def test_bars_without_a_symbol_are_kept(spark, trades_of):
    bars = bars_of(trades_of, [1, 2, 3]).withColumn("symbol", F.lit(None).cast("string"))
    kept = fct_realtime_ohlcv(bars.unionByName(bars_of(trades_of, [4]))).orderBy("symbol", "window_start").collect()
    assert [(r.symbol, r.sma_20) for r in kept] == [(None, 1.0), (None, 1.5), (None, 2.0), ("A", 4.0)]


def test_extreme_prices_stop_no_bar(spark, trades_of):
    trades = trades_of([("A", p, 1, 0) for p in (1e13, -1e300, 5.0, float("inf"))]).drop("seq")
    (bar,) = ohlcv(trades, "1 minute").collect()
    assert (bar.trade_count, bar.open, bar.low) == (4, -1e300, -1e300)
