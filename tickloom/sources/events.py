"""The ``events`` table seen as trades, and messages in the vendors' formats built from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tickloom.functions.temporal import iso_text
from tickloom.operators.bars import ohlcv
from tickloom.sources.intraday import ERROR_KEY, NOTE_KEY, SERIES_KEY

#: Trades that one task handles when damaged ticks are dealt by their id.
TASK_ROWS = 100_000


def read_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, price, volume, event_time, exchange, loaded_at and seq (the event id)."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    event_time = F.col("ts").cast("timestamp")  # stored without a zone; watermarks need one
    # a lambda's argument, unlike a column, is computed once however often it is used
    k = F.array(F.get_json_object("props", "$.k").cast("bigint"))
    volume = F.transform(k, lambda x: F.call_function("div", x * x * x * x * x * x, F.lit(1000000)))[0]
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        volume.alias("volume"),
        event_time.alias("event_time"),
        (F.col("user_id") % 4).cast("string").alias("exchange"),
        (event_time + F.expr("interval 1 minute")).alias("loaded_at"),
        F.col("event_id").alias("seq"),
    )


def read_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``lineitem`` table as trades of many symbols: suppliers, unit prices and quantities.

    Its times are whole days, so it suits measures that do not depend on order.
    """
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
    )


def with_corrections(trades: DataFrame) -> DataFrame:
    """Trades plus a correction of every trade of venue 0: a minute later, one higher."""
    corrected = trades.filter(F.col("exchange") == "0").withColumns(
        {
            "price": F.col("price") + 1,
            "loaded_at": F.col("loaded_at") + F.expr("interval 1 minute"),
        }
    )
    return trades.unionByName(corrected)


def lossy_feed(trades: DataFrame) -> DataFrame:
    """What a faulty stream would have seen: no penny trades, fewer views, no errors."""
    floor = F.when(F.col("symbol") == "view", 5.0).otherwise(1.0)
    return trades.filter((F.col("symbol") != "error") & (F.col("price") >= floor))


def trade_messages(trades: DataFrame) -> DataFrame:
    """Trades as topic messages: key and JSON value."""
    body = F.to_json(
        F.struct(
            "symbol",
            "price",
            "volume",
            iso_text(F.col("event_time")).alias("timestamp"),
            "exchange",
            F.lit("[]").alias("conditions"),
            iso_text(F.col("loaded_at")).alias("ingested_at"),
        )
    )
    return trades.select(F.col("symbol").alias("key"), body.alias("value"))


def damaged_messages(trades: DataFrame) -> DataFrame:
    """Topic messages of which some are unreadable, by a rule on price and venue."""
    venue = F.col("exchange")
    price = F.when(venue == "1", F.lit("x")).otherwise(F.col("price").cast("string"))
    body = F.to_json(
        F.struct(
            F.when(venue != "2", F.col("symbol")).alias("symbol"),
            price.try_cast("double").alias("price"),
            F.col("volume"),
            F.when(F.col("price") < 10, "garbage").otherwise(iso_text(F.col("event_time"))).alias("timestamp"),
        )
    )
    value = F.when(F.col("price") >= 100, F.lit("{bad")).otherwise(body)
    return trades.select("seq", value.alias("value"))


def tick_messages(trades: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Vendor tick arrays: each holds a trade and a quote event; clicks lack conditions. ``keep`` columns stay."""
    millis = F.unix_millis("event_time")
    trade = F.struct(
        F.lit("T").alias("ev"),
        F.col("symbol").alias("sym"),
        F.col("price").alias("p"),
        F.col("volume").alias("s"),
        millis.alias("t"),
        F.when(F.col("exchange") != "3", F.col("exchange").cast("int")).alias("x"),
        F.when(F.col("symbol") != "click", F.array(F.lit(12), F.col("exchange").cast("int"))).alias("c"),
    )
    quote = F.struct(
        F.lit("Q").alias("ev"),
        F.col("symbol").alias("sym"),
        F.col("price").alias("p"),
        F.lit(1).cast("bigint").alias("s"),
        millis.alias("t"),
        F.lit(None).cast("int").alias("x"),
        F.lit(None).cast("array<int>").alias("c"),
    )
    return trades.select("seq", *keep, F.to_json(F.array(trade, quote)).alias("value"))


def damaged_ticks(trades: DataFrame) -> DataFrame:
    """Tick arrays of which some are unreadable, empty, or hold a time no timestamp can, by price.

    A ``seq`` that repeats sends each of its arrays once for each of its prices; trades without one send
    nothing. Trades are counted when this is called and dealt by ``seq``, before they become text, over as
    many tasks as they need, so that what a task sorts does not grow with the input.
    """
    price = F.col("priced.price")
    far = F.regexp_replace("value", '"t":[0-9]+', '"t":9223372036854775807')
    value = F.when(price >= 100, F.lit("[{bad")).when(price < 1, far).when(price < 2, F.lit("[]")).otherwise(F.col("value"))
    tasks = max(1, -(-trades.count() // TASK_ROWS))
    dealt = trades.filter(F.col("seq").isNotNull()).repartition(tasks, "seq")
    prices = F.collect_list(F.struct("price")).over(W.partitionBy("seq"))
    whole = tick_messages(dealt.withColumn("prices", prices), keep=("prices",))
    return whole.select("seq", "value", F.explode("prices").alias("priced")).select("seq", value.alias("value"))


def damaged_responses(trades: DataFrame) -> DataFrame:
    """Intraday responses of which some are unreadable or lack bars, by symbol and day of the month."""
    symbol, day = F.col("symbol"), F.dayofmonth("day")
    damage = (
        F.when((symbol == "click") & (day % 2 == 0), F.lit("{bad"))
        .when((symbol == "purchase") & (day % 2 == 1), F.lit('{"Meta Data": {}}'))
        .when((symbol == "view") & (day % 3 == 0), F.lit(f'{{"{SERIES_KEY}": {{}}}}'))
    )
    return intraday_responses(trades).withColumn("payload", F.coalesce(damage, F.col("payload")))


def intraday_responses(trades: DataFrame) -> DataFrame:
    """Vendor intraday responses per symbol and day; at most 1,440 minute bars in each.

    The ``error`` symbol answers with an API error, ``signup`` with a rate-limit note.
    """
    text = lambda name: F.col(name).cast("string")
    bar = F.create_map(
        F.lit("1. open"), text("open"),
        F.lit("2. high"), text("high"),
        F.lit("3. low"), text("low"),
        F.lit("4. close"), text("close"),
        F.lit("5. volume"), text("volume"),
    )
    entry = F.struct(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"), bar)
    per_day = (
        ohlcv(trades, "1 minute")
        .groupBy("symbol", F.to_date("window_start").alias("day"))
        .agg(F.map_from_entries(F.collect_list(entry)).alias("series"))
    )
    failed = F.when(F.col("symbol") == "error", F.lit("Invalid API call"))
    limited = F.when(F.col("symbol") == "signup", F.lit("5 calls per minute"))
    series = F.when(failed.isNull() & limited.isNull(), F.col("series"))
    payload = F.to_json(F.struct(series.alias(SERIES_KEY), failed.alias(ERROR_KEY), limited.alias(NOTE_KEY)))
    return per_day.select("symbol", "day", payload.alias("payload"))
