"""Restriction to the symbols followed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import DEFAULT_SYMBOLS


def parse_symbols(text: str = DEFAULT_SYMBOLS) -> list[str]:
    return [symbol.strip() for symbol in text.split(",")]


def in_universe(df: DataFrame, symbols: list[str] | DataFrame) -> DataFrame:
    """Keep followed symbols. A list becomes a pushed-down filter; a table of symbols a semi
    join, whose side Spark broadcasts only if its measured size allows."""
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select("symbol"), "symbol", "left_semi")
    return df.filter(F.col("symbol").isin(symbols))
