"""The warehouse: one Parquet table per product below a common root."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tickloom.schemas import ANOMALY, BAR_WINDOWS, RAW_TRADES

# The tables written by the speed and batch layers.
SOURCE_TABLES = [RAW_TRADES, *BAR_WINDOWS, "anomalies", "daily_summary_batch"]

# tables that may hold no file yet, from which a schema could be read
_SCHEMAS = {"anomalies": ANOMALY}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        """The table; before its first load it is empty, if its schema is declared."""
        if table not in _SCHEMAS:
            return self.spark.read.parquet(self.path(table))
        try:
            return self.spark.read.schema(_SCHEMAS[table]).parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _SCHEMAS[table])

    def read_or_none(self, table: str) -> DataFrame | None:
        """The table, or None before its first load."""
        try:
            return self.read(table)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def register(self, *tables: str) -> None:
        """Expose tables to SQL under their own names."""
        for table in tables or SOURCE_TABLES:
            self.read(table).createOrReplaceTempView(table)
