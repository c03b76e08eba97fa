"""Streaming sinks. The trigger is a parameter: an interval, or all that is available."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom import schemas as S

AVAILABLE_NOW = "available now"


def _writer(df: DataFrame, checkpoint: str, trigger: str) -> DataStreamWriter:
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if trigger == AVAILABLE_NOW:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def to_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str = S.TABLE_TRIGGER,
    partition_by: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append to a Parquet table, exactly once."""
    writer = _writer(df, checkpoint, trigger).format("parquet")
    writer = writer.partitionBy(partition_by) if partition_by else writer
    writer = writer.queryName(name) if name else writer
    return writer.start(path)


def as_messages(df: DataFrame) -> DataFrame:
    """Rows as topic messages keyed by symbol."""
    return df.select(F.col("symbol").alias("key"), F.to_json(F.struct("*")).alias("value"))


def to_topic(
    df: DataFrame, servers: str, checkpoint: str, topic: str = S.TOPIC_ANOMALIES, trigger: str = S.PUBLISH_TRIGGER
) -> StreamingQuery:
    """Publish rows to a topic. Needs the Kafka connector on the class path."""
    return (
        _writer(as_messages(df), checkpoint, trigger)
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .start()
    )


def to_message_files(df: DataFrame, path: str, checkpoint: str, trigger: str = S.PUBLISH_TRIGGER) -> StreamingQuery:
    """The same messages to JSON files, where no broker is at hand."""
    return _writer(as_messages(df), checkpoint, trigger).format("json").start(path)


def to_console(df: DataFrame, checkpoint: str, trigger: str = S.TABLE_TRIGGER) -> StreamingQuery:
    return _writer(df, checkpoint, trigger).format("console").option("truncate", "false").start()
