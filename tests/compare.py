"""Run registered queries and their SQL side by side: rows, columns and values must agree.

Usage: python tests/compare.py SF_DIR [name ...]
"""

from __future__ import annotations

import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _rows(arrow_table) -> list[tuple]:
    names = sorted(arrow_table.column_names)
    columns = [arrow_table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr)


def differences(actual, expected) -> str | None:
    """What differs between two Arrow tables, or None. Numbers must be equal, not close."""
    if sorted(actual.column_names) != sorted(expected.column_names):
        return f"columns {sorted(actual.column_names)} vs {sorted(expected.column_names)}"
    for name in actual.column_names:
        kinds = actual.schema.field(name).type, expected.schema.field(name).type
        if str(kinds[0]).replace("large_", "") != str(kinds[1]).replace("large_", ""):
            return f"type of {name}: {kinds[0]} vs {kinds[1]}"
    if actual.num_rows != expected.num_rows:
        return f"rows {actual.num_rows} vs {expected.num_rows}"
    wrong = [(a, e) for a, e in zip(_rows(actual), _rows(expected)) if a != e]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else None


def check(spark, sf_dir: str, name: str) -> tuple[str | None, int]:
    import __spark_entry__ as entry

    actual = entry.queries()[name](spark, sf_dir).toArrow()
    with oracle_connection(sf_dir) as connection:
        expected = connection.sql(entry.oracle_sql()[name]).to_arrow_table()
    return differences(actual, expected), actual.num_rows


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tickloom.session import build_session

    session = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    failed = 0
    for query_name in sys.argv[2:] or entry.oracle_sql():
        begun = time.time()
        try:
            problem, rows = check(session, sys.argv[1], query_name)
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", 0
        failed += problem is not None
        print(f"{query_name:32} {rows:8} rows {time.time() - begun:6.2f} s  {problem or 'equal'}", flush=True)
    print("failed:", failed)
