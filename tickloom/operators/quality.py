"""Data-quality checks: one aggregation per table for all its row-level checks."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.classify import TREND_DIRECTIONS, TREND_SIGNALS


@dataclass
class TableChecks:
    not_null: list[str] = field(default_factory=list)
    accepted: dict[str, list[str]] = field(default_factory=dict)
    unique: list[str] = field(default_factory=list)


# The checks declared for the marts.
MART_CHECKS = {
    "fct_daily_market": TableChecks(
        not_null=["symbol", "trade_date", "day_open", "day_close"],
        accepted={"trend_direction": TREND_DIRECTIONS},
    ),
    "fct_realtime_ohlcv": TableChecks(
        not_null=["symbol", "window_start"], accepted={"trend_signal": TREND_SIGNALS}
    ),
    "dim_symbols": TableChecks(not_null=["symbol"], unique=["symbol"]),
}

WARN_AFTER = dt.timedelta(minutes=5)
ERROR_AFTER = dt.timedelta(minutes=30)


def _row(table: str, column: str, check: str, failures: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(check).alias("check_name"),
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
    )


def check_table(df: DataFrame, table: str, checks: TableChecks) -> DataFrame:
    """Rows (table_name, column_name, check_name, failures, status), one per check.

    Nulls pass the accepted-values and unique checks, as nulls have a check of their own. The
    row-level checks are counted with the first uniqueness check, in the same aggregation;
    each further unique column takes a scan of that column.
    """
    failing = [(c, "not_null", F.col(c).isNull()) for c in checks.not_null]
    failing += [(c, "accepted_values", ~F.col(c).isin(values)) for c, values in checks.accepted.items()]
    results = []
    for place, c in enumerate(checks.unique or [None]):
        with_rows = failing if place == 0 else []
        counts = [F.count_if(condition).alias(f"failing_{i}") for i, (_, _, condition) in enumerate(with_rows)]
        if c is None:
            summed = [_row(table, column, check, count) for (column, check, _), count in zip(with_rows, counts)]
            grouped = df
        else:
            grouped = df.groupBy(F.col(c).alias("unique_key")).agg(F.count("*").alias("copies"), *counts)
            summed = [_row(table, column, check, F.sum(f"failing_{i}")) for i, (column, check, _) in enumerate(with_rows)]
            summed.append(_row(table, c, "unique", F.count_if(F.col("unique_key").isNotNull() & (F.col("copies") > 1))))
        if summed:
            results.append(grouped.agg(F.array(*summed).alias("checks")))
    flat = reduce(DataFrame.unionByName, results).select(F.inline("checks"))
    return flat.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def check_marts(marts: dict[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [check_table(df, name, MART_CHECKS[name]) for name, df in marts.items()]
    )


def freshness(df: DataFrame, table: str, as_of: Column, loaded_at: str = "loaded_at") -> DataFrame:
    """Age of the newest row at ``as_of``: pass, warn after 5 and error after 30 minutes."""
    age = F.unix_micros(F.col("as_of")) - F.unix_micros(F.col("newest"))
    micros = lambda span: int(span.total_seconds() * 1_000_000)
    return df.agg(F.max(loaded_at).alias("newest")).select(
        F.lit(table).alias("table_name"), "newest", as_of.cast("timestamp").alias("as_of")
    ).withColumn(
        "status",
        F.when(F.col("newest").isNull() | (age > micros(ERROR_AFTER)), "error")
        .when(age > micros(WARN_AFTER), "warn")
        .otherwise("pass"),
    )


class ChecksFailed(RuntimeError):
    pass


def require(results: DataFrame) -> None:
    """Raise when a check failed; the result has one row per check."""
    failed = results.filter(F.col("status") != "pass").collect()
    if failed:
        raise ChecksFailed("; ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in failed))
