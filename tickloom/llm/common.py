"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import run_dir

WHITE_SPACE = " \t\n\x0b\f\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts lineage: what follows never computes ``df`` again, and losing an executor loses
    nothing, as all executors see the files.
    """
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def per_worker(key: Any, build: Callable[[], Any]) -> Any:
    """What ``build`` returns, kept for the life of a Python worker process."""
    kept = vars(sys).setdefault("_corpus_worker_cache", {})
    if key not in kept:
        kept[key] = build()
    return kept[key]


def batches_of_bytes(batch: pa.RecordBatch, text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size + 1
    if start < batch.num_rows:
        yield batch.slice(start)
