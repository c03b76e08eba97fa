import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickloom import schemas as S
from tickloom.operators import anomaly
from tickloom.operators.dedup import unseen_stream
from tickloom.session import run_dir
from tickloom.sinks.streams import AVAILABLE_NOW, as_messages, to_console, to_table
from tickloom.sources import messages
from tickloom.sources.warehouse import Warehouse
from tickloom.streaming.anomaly_stream import RollingDetector, start_anomaly_stream
from tickloom.streaming.dedup_stream import FirstSightings, start_first_sightings
from tickloom.streaming.speed_layer import start_speed_layer

START = dt.datetime(2024, 1, 1, 9, tzinfo=dt.timezone.utc)


def message(symbol, price, volume, seconds):
    stamp = (START + dt.timedelta(seconds=seconds)).isoformat() if seconds is not None else "garbage"
    return json.dumps({"symbol": symbol, "price": price, "volume": volume, "timestamp": stamp, "exchange": "1"})


class Feed:
    """A folder of message files; each landing is one later file set."""

    def __init__(self, spark, name):
        self.spark = spark
        self.folder = run_dir(spark, name)

    def land(self, *texts):
        rows = self.spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
        rows.write.mode("append").text(f"{self.folder}/in")

    def messages(self):
        return messages.file_messages(self.spark, f"{self.folder}/in")

    def trades(self):
        return messages.decode_trades(self.messages())


def test_speed_layer(spark):
    feed = Feed(spark, "speed")
    warehouse = Warehouse(spark, f"{feed.folder}/warehouse")

    def run():
        queries = start_speed_layer(feed.messages(), warehouse, f"{feed.folder}/checkpoints", AVAILABLE_NOW)
        for query in queries.values():
            query.awaitTermination()
        return queries

    feed.land(message("A", 1.0, 10, 0), message("A", 3.0, 20, 30), message("A", 2.0, 30, 400), "{bad")
    assert set(run()) == {"ohlcv_1min", "ohlcv_5min", "ohlcv_1hr", S.RAW_TRADES, "trades_rejected"}
    # the first bar is closed by now, so its late trade is lost to the bars but not to the raw table
    feed.land(message("A", 9.0, 99, 10), message("A", 5.0, 1, None), message("A", 4.0, 40, 8000))
    run()

    minute = warehouse.read("ohlcv_1min").orderBy("window_start").collect()
    assert [(r.open, r.close, r.volume, r.trade_count) for r in minute] == [(1.0, 3.0, 30, 2), (2.0, 2.0, 30, 1)]
    hour = warehouse.read("ohlcv_1hr").collect()
    assert [(r.open, r.high, r.close, r.volume) for r in hour] == [(1.0, 9.0, 2.0, 159)]
    raw = warehouse.read(S.RAW_TRADES)
    assert raw.count() == 7
    assert raw.filter("event_time is null and price = 5.0").count() == 1
    reasons = [r.reason for r in warehouse.read("trades_rejected").orderBy("reason").collect()]
    assert reasons == ["malformed", "no_event_time"]


def random_trades(n, symbols):
    import random

    rng = random.Random(11)
    return [message(rng.choice(symbols), round(rng.expovariate(0.02), 2), rng.randrange(10**6), i * 7) for i in range(n)]


@pytest.mark.parametrize("chunk_rows", [100, 10_000])
def test_anomaly_stream_equals_batch_across_restarts(spark, chunk_rows):
    feed = Feed(spark, "anomalies")
    texts = random_trades(900, ["HOT"] * 5 + ["B", "C"]) + [message("LATE", 5.0, 1, 7000 + i) for i in range(5)]
    output = f"{feed.folder}/out"
    for part in (texts[:50], texts[50:520], texts[520:]):
        feed.land(*part)
        start_anomaly_stream(
            feed.trades(), output, f"{feed.folder}/cp", threshold=1.5, trigger=AVAILABLE_NOW, chunk_rows=chunk_rows
        ).awaitTermination()
    streamed = spark.read.parquet(output).drop("anomaly_date", "batch_id", "detected_at")
    everything = spark.createDataFrame([(t,) for t in texts], "value string")
    batch = anomaly.anomalies(anomaly.score(messages.decode_trades(everything)), 1.5).drop("detected_at")
    assert batch.count() > 50
    assert streamed.exceptAll(batch).count() == batch.exceptAll(streamed).count() == 0


def test_a_retried_batch_changes_nothing(spark):
    folder = run_dir(spark, "retry")
    detector = RollingDetector(f"{folder}/out", f"{folder}/state", threshold=1.5, chunk_rows=100)
    table = lambda texts: messages.decode_trades(spark.createDataFrame([(t,) for t in texts], "value string"))
    texts = random_trades(400, ["A", "B"])
    detector(table(texts[:200]), 0)
    detector(table(texts[200:]), 1)
    read = lambda: sorted(map(str, spark.read.parquet(f"{folder}/out").drop("detected_at").collect()))
    once = read()
    detector(table(texts[200:]), 1)
    assert read() == once
    state = spark.read.parquet(detector._slot(1))
    assert {(r.symbol, r["count"]) for r in state.groupBy("symbol").count().collect()} == {("A", 100), ("B", 100)}


def test_state_of_another_run_is_refused(spark):
    folder = run_dir(spark, "foreign")
    detector = RollingDetector(f"{folder}/out", f"{folder}/state")
    table = messages.decode_trades(spark.createDataFrame([(message("A", 1.0, 1, 0),)], "value string"))
    detector(table, 0)
    with pytest.raises(RuntimeError, match="does not belong"):
        detector(table, 3)


def test_stream_dedup(spark):
    feed = Feed(spark, "dedup")
    feed.land(message("A", 1.0, 1, 0), message("A", 2.0, 1, 60))
    folder = feed.folder
    run = lambda: to_table(
        unseen_stream(messages.with_watermark(feed.trades(), "10 minutes")), f"{folder}/out", f"{folder}/cp", AVAILABLE_NOW
    ).awaitTermination()
    run()
    feed.land(message("A", 7.0, 1, 60), message("A", 3.0, 1, 90))
    run()
    assert sorted(r.price for r in spark.read.parquet(f"{folder}/out").collect()) == [1.0, 2.0, 3.0]


def test_first_sightings_are_kept_however_late(spark):
    feed = Feed(spark, "sightings")
    run = lambda: start_first_sightings(feed.trades(), f"{feed.folder}/out", f"{feed.folder}/cp", AVAILABLE_NOW).awaitTermination()
    feed.land(message("A", 1.0, 1, 86_400 * 9), message("A", 2.0, 1, 86_400 * 9 + 60), message("A", 5.0, 1, 86_400 * 9))
    run()
    # a repeat, a first sighting nine days late, another symbol at a known time, two trades without a time
    feed.land(message("A", 7.0, 1, 86_400 * 9 + 60), message("A", 3.0, 1, 0), message("B", 4.0, 1, 0), *[message("A", 6.0, 1, None)] * 2)
    run()
    feed.land(message("A", 8.0, 1, 0))
    run()
    assert sorted(r.price for r in spark.read.parquet(f"{feed.folder}/out").collect()) == [1.0, 2.0, 3.0, 4.0, 6.0, 6.0]


def test_a_batch_of_first_sightings_run_again_changes_nothing(spark):
    folder = run_dir(spark, "sightings")
    sink = FirstSightings(f"{folder}/out")
    table = lambda *texts: messages.decode_trades(spark.createDataFrame([(t,) for t in texts], "value string"))
    read = lambda: sorted((r.symbol, r.price) for r in spark.read.parquet(f"{folder}/out").collect())
    sink(table(message("A", 1.0, 1, 0), message("A", 2.0, 1, 86_400)), 0)
    for _ in range(2):
        sink(table(message("A", 9.0, 1, 0), message("A", 3.0, 1, 60)), 1)
        assert read() == [("A", 1.0), ("A", 2.0), ("A", 3.0)]
    sink(table(message("A", 1.0, 1, 0), message("A", 2.0, 1, 86_400)), 0)
    assert read() == [("A", 1.0), ("A", 2.0), ("A", 3.0)]
    sink(table(message("A", 9.0, 1, 0)), 2)  # nothing new
    assert len(read()) == 3


def test_messages_are_keyed_json(spark):
    row = as_messages(spark.createDataFrame([("A", 1.5)], "symbol string, price double")).first()
    assert (row.key, json.loads(row.value)) == ("A", {"symbol": "A", "price": 1.5})


def test_console_sink_runs(spark, capfd):
    feed = Feed(spark, "console")
    feed.land(message("A", 1.0, 1, 0))
    query = to_console(feed.trades().select("symbol"), f"{feed.folder}/cp", AVAILABLE_NOW)
    query.awaitTermination()
    assert query.exception() is None


def test_kafka_source_needs_its_connector(spark):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException, match="kafka"):
        messages.kafka_messages(spark, "localhost:9092")
