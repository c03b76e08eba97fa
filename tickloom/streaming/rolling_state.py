"""The last trades of every symbol, kept between micro-batches in buckets of symbols.

A batch writes the new last trades of the symbols it touches as a version of their buckets,
and a commit table that lists the versions each bucket consists of; the newest version that
holds a symbol is its state. A bucket of many versions is written as one, as part of a
batch that touches it anyway. So a batch reads the buckets it touches, and writes the symbols
it touches.

Version and commit of a batch depend only on the commit of the batch before, so a retried
batch rewrites its own. Versions no longer listed are deleted once a later batch has begun.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.operators import rolling
from tickloom.session import delete_folder, folder_exists

BUCKETS = 256
#: Versions of a bucket before it is written as one.
VERSIONS = 8

_ROW = f"symbol string, {rolling.POSITION} bigint, price double, volume bigint"
_STORED = f"{_ROW}, version bigint, bucket int"
_COMMIT = "bucket int, version bigint"

Live = dict[int, list[int]]


class RollingState:
    """``lookback`` trades per symbol below ``path``, in ``buckets`` buckets."""

    def __init__(self, path: str, lookback: int, buckets: int = BUCKETS, versions: int = VERSIONS):
        self.path = path
        self.lookback = lookback
        self.buckets = buckets
        self.versions = versions

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("symbol"), F.lit(self.buckets)).cast("int")

    def version(self, batch_id: int) -> str:
        return f"{self.path}/data/version={batch_id}"

    def _commit(self, batch_id: int) -> str:
        return f"{self.path}/commits/batch={batch_id}"

    def live(self, spark: SparkSession, batch_id: int) -> Live:
        """The versions of each bucket after a batch; at most ``buckets`` * ``versions`` numbers."""
        if batch_id < 0:
            return {}
        if not folder_exists(spark, f"{self._commit(batch_id)}/_SUCCESS"):
            raise RuntimeError(f"state in {self.path} does not belong to batch {batch_id}")
        out: Live = {}
        for row in spark.read.schema(_COMMIT).parquet(self._commit(batch_id)).collect():
            out.setdefault(row["bucket"], []).append(row["version"])
        return {bucket: sorted(held) for bucket, held in out.items()}

    def read(self, spark: SparkSession, live: Live, buckets: Iterable[int]) -> DataFrame:
        """The state of the symbols in some buckets, from these buckets' files only."""
        paths = [f"{self.version(v)}/bucket={b}" for b in sorted(buckets) for v in live.get(b, [])]
        if not paths:
            return spark.createDataFrame([], _ROW)
        stored = spark.read.schema(_STORED).option("basePath", f"{self.path}/data").parquet(*paths)
        newest = F.max("version").over(W.partitionBy("symbol"))
        return stored.withColumn("newest", newest).where("version = newest").select("symbol", rolling.POSITION, "price", "volume")

    def full(self, live: Live, buckets: Iterable[int]) -> list[int]:
        """Those of ``buckets`` that are due to be written as one version."""
        return [b for b in buckets if len(live.get(b, [])) >= self.versions]

    def write(self, spark: SparkSession, batch_id: int, live: Live, trades: DataFrame, known: DataFrame, touched: list[int]) -> None:
        """The state after a batch: ``trades`` are its rows, ``known`` the state of their symbols."""
        newest = W.partitionBy("symbol").orderBy(F.col(rolling.POSITION).desc())
        fresh = trades.select("symbol", rolling.POSITION, "price", "volume").unionByName(known)
        fresh = fresh.withColumn("age", F.row_number().over(newest)).where(F.col("age") <= self.lookback).drop("age")
        whole = self.full(live, touched)
        if whole:
            untouched = self.read(spark, live, whole).join(trades.select("symbol").distinct(), "symbol", "left_anti")
            fresh = fresh.unionByName(untouched)
        (
            fresh.withColumn("bucket", self.bucket())
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(self.version(batch_id))
        )
        after = {**live, **{b: [batch_id] if b in whole else [*live.get(b, []), batch_id] for b in touched}}
        rows = [(b, v) for b, held in after.items() for v in held]
        spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("overwrite").parquet(self._commit(batch_id))

    def clean(self, spark: SparkSession, batch_id: int) -> int:
        """Delete what only batches before ``batch_id`` needed; called as the batch after it begins."""
        if batch_id < 1 or not folder_exists(spark, f"{self._commit(batch_id - 1)}/_SUCCESS"):
            return 0
        before, now = self.live(spark, batch_id - 1), self.live(spark, batch_id)
        gone = [(b, v) for b, held in before.items() for v in held if v not in now.get(b, [])]
        for b, v in gone:
            delete_folder(spark, f"{self.version(v)}/bucket={b}")
        still = {v for held in now.values() for v in held}
        for v in {v for _, v in gone} - still:
            delete_folder(spark, self.version(v))
        delete_folder(spark, self._commit(batch_id - 1))
        return len(gone)
