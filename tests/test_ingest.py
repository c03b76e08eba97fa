import datetime as dt
import json

from pyspark.sql import functions as F

from tickloom.operators import dedup, universe
from tickloom.sources import intraday, messages, ticks


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_malformed_messages(spark):
    good = '{"symbol":"A","price":1.5,"volume":3,"timestamp":"2024-01-01T00:00:01.250000+00:00","extra":1}'
    bad = [
        "{bad",
        '{"symbol":"A","price":"x","volume":3,"timestamp":"2024-01-01T00:00:00Z"}',
        '{"symbol":"A","price":1.0,"volume":3.7,"timestamp":"2024-01-01T00:00:00Z"}',
        '{"symbol":"A","price":1.0,"volume":3,"timestamp":"garbage"}',
        '{"price":1.0,"volume":3,"timestamp":"2024-01-01T00:00:00Z"}',
    ]
    table = values(spark, good, *bad)
    trades = messages.decode_trades(table)
    assert trades.count() == 6
    (usable,) = messages.usable_trades(trades).collect()
    assert (usable.symbol, usable.price, usable.volume) == ("A", 1.5, 3)
    reasons = {r.value: r.reason for r in messages.rejected_messages(table).collect()}
    assert [reasons[b] for b in bad] == ["malformed", "no_price", "no_volume", "no_event_time", "no_symbol"]
    assert good not in reasons


def test_kafka_offset_becomes_the_sequence(spark):
    table = values(spark, '{"symbol":"A"}').selectExpr("cast(value as binary) as value", "7L as offset")
    assert messages.decode_trades(table).first().seq == 7


def test_ticks(spark):
    batch = [
        {"ev": "T", "sym": "A", "p": 10, "s": 5.9, "t": 1704067200123, "x": 4, "c": [14, 41]},
        {"ev": "Q", "sym": "A", "p": 11, "s": 1, "t": 1704067200124},
        {"ev": "T", "sym": "B", "p": "2.5", "s": 7, "t": 1704067201000},
        {"ev": "T", "sym": "C", "p": "odd", "s": 7, "t": 1704067201000},
    ]
    a, b, c = ticks.normalize_ticks(values(spark, json.dumps(batch), "not json")).collect()
    assert (a.symbol, a.price, a.volume, a.exchange, a.conditions) == ("A", 10.0, 5, "4", "[14,41]")
    assert a.timestamp == "2024-01-01T00:00:00.123000+00:00"
    assert (b.price, b.exchange, b.conditions, b.timestamp) == (2.5, "", "[]", "2024-01-01T00:00:01+00:00")
    assert (c.symbol, c.price, c.volume) == ("C", None, 7)


def test_damaged_ticks_of_repeated_and_missing_ids(spark, trades_of):
    from tickloom.sources import events

    trades = trades_of([("A", p, 1, 0) for p in (150.0, 50.0, 1.5, None, 0.5, 7.0)])
    ids = F.create_map(*[F.lit(x) for pair in ((0, 0), (1, 1), (2, 1), (3, 3), (4, 4)) for x in pair])
    sent = events.damaged_ticks(trades.withColumn("seq", ids[F.col("seq").cast("int")].cast("bigint"))).collect()
    assert sorted(r.seq for r in sent) == [0, 1, 1, 1, 1, 3, 4]
    values = {seq: sorted(r.value for r in sent if r.seq == seq) for seq in (0, 1, 3, 4)}
    assert values[0] == ["[{bad"]
    assert values[1][:2] == ["[]", "[]"] and [json.loads(v)[0]["p"] for v in values[1][2:]] == [1.5, 50.0]
    assert json.loads(values[3][0])[0].get("p") is None and len(json.loads(values[3][0])) == 2
    assert json.loads(values[4][0])[0]["t"] == 9223372036854775807


def test_rejected_ticks_in_one_pass(spark):
    texts = [None, "5", "[{bad", "[]", "[null]", '[{"ev":"T","t":1},{"ev":"Q"},{"ev":"T","t":9223372036854775807}]']
    sent = spark.createDataFrame(list(enumerate(texts)), "seq int, value string")
    rejected = ticks.rejected_ticks(sent, keep=("seq",))
    assert {(r.seq, r.event_index, r.value, r.reason) for r in rejected.collect()} == {
        (0, None, None, "malformed"),
        (1, None, "5", "malformed"),
        (2, None, "[{bad", "malformed"),
        (3, None, "[]", "empty"),
        (4, 0, None, "not_an_event"),
        (5, 1, '{"ev":"Q"}', "not_a_trade"),
        (5, 2, '{"ev":"T","t":"9223372036854775807"}', "time_out_of_range"),
    }
    assert "Union" not in rejected._jdf.queryExecution().optimizedPlan().toString()


def test_intraday(spark):
    bar = lambda close: {"1. open": "1.0", "2. high": "3.0", "3. low": "0.5", "4. close": close, "5. volume": "100"}
    responses = spark.createDataFrame(
        [
            ("A", json.dumps({"Time Series (1min)": {"2024-01-02 09:31:00": bar("2.0"), "2024-01-02 09:30:00": bar("1.5")}})),
            ("B", json.dumps({"Note": "slow down"})),
            ("C", json.dumps({"Error Message": "no such symbol"})),
            ("D", json.dumps({"Meta Data": {}})),
        ],
        "symbol string, payload string",
    )
    rows = intraday.normalize_intraday(responses).collect()
    assert [(r.symbol, r.price, r.volume, r.timestamp) for r in rows] == [
        ("A", 1.5, 100, "2024-01-02T09:30:00+00:00"),
        ("A", 2.0, 100, "2024-01-02T09:31:00+00:00"),
    ]
    assert (rows[0].exchange, rows[0].conditions, rows[0].high) == ("alpha_vantage", "[]", 3.0)
    rejected = {r.symbol: (r.reason, r.message) for r in intraday.rejected_responses(responses).collect()}
    assert rejected == {"B": ("rate_limited", "slow down"), "C": ("api_error", "no such symbol")}


def test_unseen_keeps_the_first_copy(spark, trades_of):
    polled = trades_of([("A", 1.0, 1, 0), ("A", 2.0, 1, 0), ("A", 3.0, 1, 5), ("B", 4.0, 1, 0)])
    landed = trades_of([("A", 9.0, 1, 5)])
    kept = dedup.unseen(polled, landed, ["symbol", "event_time"], [polled.seq]).collect()
    assert {(r.symbol, r.price) for r in kept} == {("A", 1.0), ("B", 4.0)}


def test_universe(spark, trades_of):
    trades = trades_of([("A", 1.0, 1, 0), ("B", 2.0, 1, 0)])
    assert universe.parse_symbols(" A , Z") == ["A", "Z"]
    assert len(universe.parse_symbols()) == 10
    assert universe.in_universe(trades, ["A", "Z"]).first().symbol == "A"
    listed = spark.createDataFrame([("B",), ("B",)], "symbol string")
    assert [r.symbol for r in universe.in_universe(trades, listed).collect()] == ["B"]


def test_iso_text_round_trip(spark, trades_of):
    from tickloom.sources.events import trade_messages

    trades = trades_of([("A", 1.0, 1, 0)])
    decoded = messages.decode_trades(trade_messages(trades)).first()
    assert decoded.event_time == trades.first().event_time
    assert isinstance(decoded.event_time, dt.datetime)
