"""Session settings and the shared folder for checkpoints and state."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Every timestamp in the data is UTC; dates and hours are taken in this zone.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # stream state off the heap, with small incremental checkpoints
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "tickloom", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Fix the session zone on a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def stream_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session of its own for streams, with ``partitions`` state stores per query.

    A stream keeps its partition count for life, so it is chosen here and not taken from a
    default meant for batch queries; the caller's settings stay as they are.
    """
    session = pin_utc(spark.newSession())
    session.conf.set("spark.sql.shuffle.partitions", partitions)
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Where that is unset, as in tests, a folder of this application in the warehouse, which
    executors share as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/_shared/{spark.sparkContext.applicationId}"


def run_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    What follows reads the same rows however often it is run or retried, on any executor. The
    folder stays until ``release_runs``.
    """
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_written: list[str] = []


def release_runs(spark: SparkSession) -> int:
    """Delete the folders ``written`` has made in this process; call it when no result that reads them is needed."""
    paths = [_written.pop() for _ in range(len(_written))]
    for path in paths:
        delete_folder(spark, path)
    return len(paths)


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    at, files = _folder(spark, path)
    return files.exists(at)


def make_folder(spark: SparkSession, path: str) -> None:
    at, files = _folder(spark, path)
    files.mkdirs(at)


def delete_folder(spark: SparkSession, path: str) -> None:
    at, files = _folder(spark, path)
    files.delete(at, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    at, files = _folder(spark, source)
    to, _ = _folder(spark, target)
    files.mkdirs(to.getParent())
    if not files.rename(at, to):
        raise OSError(f"cannot move {source} to {target}")


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    at, files = _folder(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(at) or []]
