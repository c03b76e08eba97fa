"""Trade messages: JSON text from Kafka (or from files of the same shape) to typed trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas as S


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str = S.TOPIC_TRADES,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Subscribe to a topic. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same stream read from text files holding one message per line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def decode_trades(messages: DataFrame) -> DataFrame:
    """Typed trades with ``event_time``. Unreadable fields become null, rows are kept.

    A Kafka offset, where present, is kept as ``seq``: the arrival order of one symbol.
    """
    trade = F.from_json(F.col("value").cast("string"), S.TRADE_MESSAGE)
    seq = [F.col("offset").alias("seq")] if "offset" in messages.columns else []
    return messages.select(trade.alias("trade"), *seq).select(
        "trade.*",
        F.try_to_timestamp(F.col("trade.timestamp")).alias("event_time"),
        *[F.col("seq") for _ in seq],
    )


def with_watermark(trades: DataFrame, delay: str = S.WATERMARK) -> DataFrame:
    return trades.withWatermark("event_time", delay)


def rejected_messages(messages: DataFrame) -> DataFrame:
    """Messages that cannot be used as trades, each with the first reason found."""
    trade = F.from_json(F.col("value").cast("string"), S.TRADE_MESSAGE)
    fields = [F.col(f"trade.{name}") for name in ("symbol", "price", "volume", "timestamp")]
    reason = (
        F.when(F.coalesce(*[f.cast("string") for f in fields]).isNull(), "malformed")
        .when(F.col("trade.symbol").isNull(), "no_symbol")
        .when(F.col("trade.price").isNull(), "no_price")
        .when(F.col("trade.volume").isNull(), "no_volume")
        .when(F.try_to_timestamp(F.col("trade.timestamp")).isNull(), "no_event_time")
    )
    return (
        messages.select("*", trade.alias("trade"))
        .withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .drop("trade")
    )


def landed_messages(messages: DataFrame) -> DataFrame:
    """Messages read once, for every use of them: the trade's fields, event_time, ``seq``, and of
    those that are no usable trade the ``reason`` and the text (``rejected_value``).
    """
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), S.TRADE_MESSAGE).alias("trade"),
        F.col("value").cast("string").alias("text"),
        *[F.col("offset").alias("seq") for name in messages.columns if name == "offset"],
    )
    typed = parsed.select(
        "trade.*", F.try_to_timestamp(F.col("trade.timestamp")).alias("event_time"), *[c for c in parsed.columns if c != "trade"]
    )
    fields = ("symbol", "price", "volume", "timestamp")
    reason = (
        F.when(F.coalesce(*[F.col(f).cast("string") for f in fields]).isNull(), "malformed")
        .when(F.col("symbol").isNull(), "no_symbol")
        .when(F.col("price").isNull(), "no_price")
        .when(F.col("volume").isNull(), "no_volume")
        .when(F.col("event_time").isNull(), "no_event_time")
    )
    judged = typed.withColumn("reason", reason)
    return judged.withColumn("rejected_value", F.when(F.col("reason").isNotNull(), F.col("text"))).drop("text")


def usable_trades(trades: DataFrame) -> DataFrame:
    """Trades that carry every field the scoring and the bars need."""
    return trades.dropna(subset=["symbol", "price", "volume", "event_time"])
