"""Removal of trades seen before, on a stream, that loses no late trade.

A micro-batch is compared with the rows that earlier batches have written for the days it holds,
so a first sighting is kept however late it comes, and nothing is kept besides the table itself.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.dedup import unseen
from tickloom.schemas import TABLE_TRIGGER
from tickloom.session import folder_exists
from tickloom.sinks.streams import AVAILABLE_NOW

KEYS = ["symbol", "event_time"]


class FirstSightings:
    """Writes each batch's unseen rows below ``path``, by trade date and batch.

    A batch that is run again compares with earlier batches only and replaces its own folders,
    so the table holds the same rows. Of copies within a batch the one with the lowest price,
    volume and exchange stays. Trades without a time have no key: all of them are kept.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def seen(self, batch: DataFrame, days: list[dt.date], batch_id: int) -> DataFrame:
        """Keys that earlier batches have written for ``days``; other days are not read."""
        spark = batch.sparkSession
        if not folder_exists(spark, self.path):
            return batch.select(*KEYS).limit(0)
        schema = f"symbol {batch.schema['symbol'].dataType.simpleString()}, event_time timestamp, trade_date date, batch_id bigint"
        written = spark.read.schema(schema).parquet(self.path)
        return written.filter(F.col("trade_date").isin(days) & (F.col("batch_id") < batch_id)).select(*KEYS)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("trade_date", F.to_date("event_time")).persist()
        try:
            days = [r.trade_date for r in batch.select("trade_date").distinct().collect()]  # days, not trades
            dated = batch.filter(F.col("event_time").isNotNull())
            seen = self.seen(batch, [d for d in days if d is not None], batch_id)
            fresh = unseen(dated, seen, KEYS, [F.col(c) for c in ("price", "volume", "exchange")])
            rows = fresh.unionByName(batch.filter(F.col("event_time").isNull()))
            (
                rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
                .hint("rebalance", "trade_date")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("trade_date", "batch_id")
                .parquet(self.path)
            )
        finally:
            batch.unpersist()


def start_first_sightings(trades: DataFrame, path: str, checkpoint: str, trigger: str = TABLE_TRIGGER) -> StreamingQuery:
    """Start the query that keeps ``path`` free of repeats; needs no watermark."""
    writer = trades.writeStream.option("checkpointLocation", checkpoint).foreachBatch(FirstSightings(path))
    writer = writer.trigger(availableNow=True) if trigger == AVAILABLE_NOW else writer.trigger(processingTime=trigger)
    return writer.start()
