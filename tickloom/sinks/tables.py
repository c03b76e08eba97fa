"""Batch writes of dated Parquet tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def _laid_out(df: DataFrame, date_col: str, cluster: list[str]) -> DataFrame:
    """Rows gathered by date and sorted by the cluster columns inside each file.

    ``rebalance`` lets Spark split a date that holds much of the data over several tasks
    and merge small ones, which a plain repartition by date would not.
    """
    return df.hint("rebalance", date_col).sortWithinPartitions(date_col, *cluster)


def replace_dates(df: DataFrame, path: str, date_col: str = "trade_date", cluster: tuple[str, ...] = ("symbol",)) -> None:
    """Write ``df``, replacing exactly the dates it contains; other dates stay."""
    (
        _laid_out(df, date_col, list(cluster))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col)
        .parquet(path)
    )


def drop_dates(spark: SparkSession, path: str, dates: Iterable[dt.date], date_col: str = "trade_date") -> None:
    """Remove whole dates, which a dynamic overwrite leaves where it has no rows for them."""
    for date in dates:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{date_col}={date.isoformat()}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def append_dates(df: DataFrame, path: str, date_col: str = "trade_date", cluster: tuple[str, ...] = ("symbol",)) -> None:
    _laid_out(df, date_col, list(cluster)).write.mode("append").partitionBy(date_col).parquet(path)


def append_log(row: DataFrame, path: str) -> None:
    """Add a report to a log table."""
    row.coalesce(1).write.mode("append").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Write a whole undated table anew."""
    df.write.mode("overwrite").parquet(path)
