import collections
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.functions import classify
from tickloom.operators import alerts, anomaly


def last_score(trades):
    return anomaly.score(trades).orderBy(F.col("seq").desc()).first()


def series(prices, volume=1000):
    return [("A", float(p), volume, i) for i, p in enumerate(prices)]


def brute_force(rows, lookback=100):
    """The definition, one trade at a time."""
    held = collections.defaultdict(lambda: (collections.deque(maxlen=lookback), collections.deque(maxlen=lookback)))
    out = {}
    for i, (symbol, price, volume, _) in sorted(enumerate(rows), key=lambda r: (r[1][3], r[0])):
        result = []
        for queue, value in zip(held[symbol], (price, volume)):
            mean = float(np.mean(queue)) if len(queue) > 1 else 0.0
            std = float(np.std(queue, ddof=1)) if len(queue) > 2 else 0.0
            flat = std <= 1e-12 * abs(mean)
            result += [mean, std, 0.0 if flat else (value - mean) / std]
        out[i] = result
        held[symbol][0].append(price)
        held[symbol][1].append(volume)
    return out


STATS = ["price_mean", "price_std", "price_zscore", "volume_mean", "volume_std", "volume_zscore"]


def test_empty_state(trades_of):
    row = last_score(trades_of(series([100])))
    assert [row[c] for c in STATS] == [0.0] * 6


def test_small_set(trades_of):
    row = last_score(trades_of(series([100, 101, 102, 103, 104, 102])))
    assert row.price_mean == pytest.approx(102.0, abs=0.01)
    assert row.price_std == pytest.approx(1.5811, abs=1e-4)


def test_constant_prices(trades_of):
    assert abs(last_score(trades_of(series([100] * 51))).price_zscore) < 0.01


@pytest.mark.parametrize("price", [0.1, 150.1, 2.8e-17, 1e12 / 3])
def test_rounding_error_is_not_a_deviation(trades_of, price):
    assert last_score(trades_of(series([price] * 130))).price_zscore == 0.0


def test_spike(trades_of):
    row = last_score(trades_of(series([100 + 0.01 * i for i in range(50)] + [200])))
    assert row.price_zscore == pytest.approx(684.3, abs=0.1)


def test_two_and_three_prior_rows(trades_of):
    two = last_score(trades_of(series([1, 2, 9])))
    assert (two.price_mean, two.price_std, two.price_zscore) == (1.5, 0.0, 0.0)
    three = last_score(trades_of(series([1, 2, 3, 9])))
    assert (three.price_mean, three.price_std, three.price_zscore) == (2.0, 1.0, 7.0)


def test_trade_101_evicts_the_first(trades_of):
    row = last_score(trades_of(series([1e6] + [1.0, 2.0] * 50 + [1.5])))
    assert row.price_mean == 1.5


def test_equals_brute_force_with_a_hot_symbol(spark, trades_of):
    rng = random.Random(7)
    symbols = ["HOT"] * 12 + ["B", "C", "D"]
    rows = [
        (rng.choice(symbols), round(rng.expovariate(0.02), 2), rng.randrange(10**6), rng.randrange(4000))
        for _ in range(3000)
    ]
    rows += [("ONE", 5.0, 5, 17)]
    expected = brute_force(rows)
    for chunk_rows in (100, 137, 10_000):
        got = anomaly.score(trades_of(rows), chunk_rows=chunk_rows).collect()
        assert len(got) == len(rows)
        for row in got:
            assert [row[c] for c in STATS] == pytest.approx(expected[row.seq], rel=1e-9, abs=1e-9)


def test_equals_one_window_per_symbol(trades_of):
    rng = random.Random(3)
    rows = [("AB"[i % 2], rng.uniform(1, 99), rng.randrange(1000), i) for i in range(700)]
    rounded = lambda df: df.select("seq", *[F.round(c, 8).alias(c) for c in STATS])
    chunked = rounded(anomaly.score(trades_of(rows), chunk_rows=150))
    simple = rounded(anomaly.score_by_symbol(trades_of(rows)))
    assert chunked.exceptAll(simple).count() == simple.exceptAll(chunked).count() == 0


def test_unusable_trades_take_no_part(trades_of):
    rows = series([1, 2, 3, 9])
    rows.insert(2, ("A", None, 7, 1))
    assert last_score(trades_of(rows)).price_zscore == 7.0


@pytest.mark.parametrize(
    "z, expected",
    [(1.5, "NORMAL"), (2.5, "WARNING"), (3.5, "CRITICAL"), (4.5, "EXTREME"), (-3.5, "CRITICAL"),
     (1.9999, "NORMAL"), (2.0, "WARNING"), (3.0, "CRITICAL"), (4.0, "EXTREME"), (-4.0, "EXTREME")],
)
def test_severity(spark, z, expected):
    assert spark.range(1).select(classify.severity(F.lit(z))).first()[0] == expected


def events(spark, price_z, volume_z, **options):
    scored = spark.createDataFrame(
        [("A", 200.0, 1000, price_z, volume_z, 150.0, 1.0, 1000.0, 1.0)],
        "symbol string, price double, volume bigint, price_zscore double, volume_zscore double, "
        "price_mean double, price_std double, volume_mean double, volume_std double",
    ).withColumn("event_time", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return anomaly.anomalies(scored, **options).collect()


@pytest.mark.parametrize(
    "price_z, volume_z, kind, severity",
    [(4.0, 0.5, "PRICE", "EXTREME"), (3.5, 4.0, "PRICE_AND_VOLUME", "EXTREME"), (0.0, -3.0, "VOLUME", "CRITICAL")],
)
def test_event(spark, price_z, volume_z, kind, severity):
    (event,) = events(spark, price_z, volume_z)
    assert (event.anomaly_type, event.severity) == (kind, severity)
    assert event.timestamp == "2024-01-01T00:00:00+00:00"


def test_no_event_below_threshold(spark):
    assert events(spark, 1.0, 1.0) == []
    assert events(spark, 2.9999999, -2.9999999) == []
    assert events(spark, 1.0, 1.6, threshold=1.5)[0].severity == "NORMAL"


def test_alert_payload(spark, trades_of):
    scored = anomaly.score(trades_of(series([100, 101, 102, 103, 104, 150.125], 1234567)))
    (row,) = alerts.alert_payloads(anomaly.anomalies(scored)).collect()
    message = json.loads(row.payload)["attachments"][0]
    assert message["color"] == "#FF0000"
    header, section, context = message["blocks"]
    assert header["text"]["text"] == ":rotating_light: EXTREME Anomaly: A"
    texts = [f["text"] for f in section["fields"]]
    assert texts[:4] == ["*Price:* $150.12 (UP)", "*Volume:* 1,234,567", "*Price Z-Score:* 30.44", "*Volume Z-Score:* 0.00"]
    assert context["elements"][0]["text"] == "Price mean: $102.00 (σ=1.58) | Volume mean: 1,234,567 (σ=0)"


def test_unknown_severity_has_fallbacks(spark):
    found = spark.createDataFrame(
        [("A", 1.0, 1, -1.0, 0.0, 1.0, 1.0, 1.0, 1.0, "ODD", "PRICE", "2024-01-01T00:00:00.5+00:00")],
        "symbol string, price double, volume bigint, price_zscore double, volume_zscore double, price_mean double, "
        "price_std double, volume_mean double, volume_std double, severity string, anomaly_type string, detected_at string",
    )
    row = alerts.alert_texts(found).first()
    assert (row.color, row.header) == ("#999999", ":question: ODD Anomaly: A")
    assert row.price_text.endswith("(DOWN)")
    assert row.detected_text == "*Detected:* 2024-01-01T00:00:00"
    assert alerts.alerting(found).count() == 0


def test_a_symbol_of_one_minute_is_placed_by_many_tasks(spark, trades_of):
    """Equal times and prices, too: only the sequence tells the trades apart."""
    from tickloom.operators import rolling

    rows = [("HOT", 1.0, 5, 3) for _ in range(4000)] + [("B", 2.0, 5, 3), ("A", 2.0, 5, 3)]
    placed = rolling.place(trades_of(rows), "symbol", ["event_time", "seq"])
    assert sorted((r.symbol, r.seq, r.position) for r in placed.collect()) == [
        ("A", 4001, 1), ("B", 4000, 1), *[("HOT", i, i + 1) for i in range(4000)]
    ]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from tickloom.session import _written

        rolling.place(trades_of(rows), "symbol", ["event_time", "seq"])
        held = spark.read.parquet(_written[-1]).groupBy("part").count().collect()
        assert len(held) == 4 and max(r["count"] for r in held) < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranks_within_days_of_many_partitions(spark):
    from tickloom.operators import rolling

    rows = [(k, f"d{d}" if d else None, d * 100 + i) for k in (None, "a", "b") for d in range(4) for i in range(7)]
    df = spark.createDataFrame(rows, "k string, day string, at int").withColumn("k", F.coalesce("k", F.lit("")))
    got = rolling.place(df.repartition(3), "k", ["at"], within="day", rank_as="n").collect()
    assert {(r.k, r.at): (r.position, r.n) for r in got} == {
        (k or "", at): (d * 7 + at % 100 + 1, at % 100 + 1) for k, _, at in rows for d in [at // 100]
    }
