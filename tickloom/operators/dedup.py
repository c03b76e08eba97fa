"""Choice of one row among copies, and removal of rows seen before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def pick_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in ``order``. Copies are cut to one per task before the shuffle."""
    first = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("copy_rank", F.row_number().over(first)).filter(F.col("copy_rank") == 1).drop("copy_rank")


def unseen(polled: DataFrame, landed: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Polled rows whose key has not landed yet; of copies within the poll the first wins.

    Landed keys are made distinct, which cuts copies of a key before they are shuffled.
    Pass only the days of ``landed`` that the poll can reach.
    """
    return pick_one(polled, keys, order).join(landed.select(*keys).distinct(), keys, "left_anti")


def unseen_stream(trades: DataFrame) -> DataFrame:
    """The streaming form, for the feed of a poller. Rows later than the watermark are
    dropped, so keep it off the path of the raw trade table."""
    return trades.dropDuplicatesWithinWatermark(["symbol", "event_time"])
