"""Anomaly detection on the trade stream.

Every symbol's state is its last 100 trades. A keyed state operator would run all of one
symbol's trades through one Python task; here each micro-batch is a DataFrame job over
(state + new trades), cut into chunks as in the batch form, so a hot symbol spreads out
and the scoring is the same code.

State and output are written per micro-batch and only ever depend on the previous one,
so a batch that is retried after a failure rewrites its own files: each trade is scored
once. Trades are ordered by time within a micro-batch; a later batch never re-scores an
earlier one. The state lies in buckets of symbols, of which a batch touches those of its
trades (``RollingState``). Output folders of earlier batches are merged as batches pass.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom import schemas as S
from tickloom.operators import anomaly, rolling
from tickloom.session import delete_folder, folder_exists, list_folders, move_folder
from tickloom.sinks.streams import AVAILABLE_NOW
from tickloom.sources.messages import usable_trades
from tickloom.streaming.rolling_state import BUCKETS, VERSIONS, RollingState

#: Batches whose output folders of a day become one; as many of these become one again, and so on.
MERGED_BATCHES = 16


class RollingDetector:
    """The per-micro-batch job: score, write anomalies, write the next state."""

    def __init__(
        self,
        output: str,
        state: str,
        threshold: float = S.Z_THRESHOLD,
        lookback: int = S.LOOKBACK,
        chunk_rows: int = rolling.CHUNK_ROWS,
        buckets: int = BUCKETS,
        versions: int = VERSIONS,
        merged_batches: int = MERGED_BATCHES,
    ):
        self.output = output
        self.state = RollingState(state, lookback, buckets, versions)
        self.threshold = threshold
        self.lookback = lookback
        self.chunk_rows = chunk_rows
        self.merged_batches = merged_batches

    def _slot(self, batch_id: int) -> str:
        """Where a batch's version of the state lies."""
        return self.state.version(batch_id)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        live = self.state.live(spark, batch_id - 1)
        self.state.clean(spark, batch_id - 1)
        self._merge_events(spark, batch_id)
        trades = usable_trades(batch).persist()
        try:
            buckets = trades.select(self.state.bucket().alias("bucket")).distinct().collect()
            touched = sorted(row["bucket"] for row in buckets)  # as many as there are buckets
            known = self.state.read(spark, live, touched)
            known = known.join(trades.select("symbol").distinct(), "symbol", "left_semi").persist()
            try:
                placed = self._placed(trades, known).persist()
                try:
                    self._score(placed, known, batch_id)
                    self.state.write(spark, batch_id, live, placed, known, touched)
                finally:
                    placed.unpersist()
            finally:
                known.unpersist()
        finally:
            trades.unpersist()

    def _placed(self, trades: DataFrame, known: DataFrame) -> DataFrame:
        reached = known.groupBy("symbol").agg(F.max("position").alias("last_position"))
        return rolling.with_position(
            trades, "symbol", anomaly.time_grain("event_time"), anomaly.arrival_order(trades, None), after=reached
        )

    def _score(self, placed: DataFrame, known: DataFrame, batch_id: int) -> None:
        both = placed.withColumn("is_new", F.lit(True)).unionByName(
            known.withColumn("is_new", F.lit(False)), allowMissingColumns=True
        )
        scored = anomaly.score_placed(both, self.lookback, self.chunk_rows).filter("is_new")
        events = anomaly.with_anomaly_date(anomaly.anomalies(scored, self.threshold))
        (
            events.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("anomaly_date", "batch_id")
            .parquet(self.output)
        )

    def _merge_events(self, spark: SparkSession, batch_id: int) -> None:
        """Before batch n, a multiple of ``merged_batches`` to some power, make the folders of that many batches before it one per day.

        The merged rows are complete in a hidden folder before the folders they come from go, and
        only batches before ``batch_id`` are merged, which aren't written again. A batch that is
        retried carries on where it was.
        """
        span = self.merged_batches
        if batch_id == 0 or batch_id % span:
            return
        while batch_id % (span * self.merged_batches) == 0:
            span *= self.merged_batches
        first = batch_id - span
        ready = f"{self.output}/_merged/batch={batch_id}"
        held = self._folders(spark, first, batch_id)
        if not folder_exists(spark, f"{ready}/_SUCCESS"):
            several = {day: paths for day, paths in held.items() if len(paths) > 1}
            if not several:
                return
            events = spark.read.schema(f"{S.ANOMALY}, batch_id bigint").option("basePath", self.output)
            events = events.parquet(*[path for paths in several.values() for path in paths])
            (
                events.withColumn("batch_id", F.lit(first).cast("bigint"))
                .hint("rebalance", "anomaly_date")
                .write.mode("overwrite")
                .partitionBy("anomaly_date", "batch_id")
                .parquet(ready)
            )
        for path in list_folders(spark, f"{ready}/anomaly_date=*/batch_id={first}"):
            day = path.split("/")[-2]
            for old in held.get(day, []):
                delete_folder(spark, old)
            move_folder(spark, path, f"{self.output}/{day}/batch_id={first}")
        delete_folder(spark, ready)

    def _folders(self, spark: SparkSession, first: int, end: int) -> dict[str, list[str]]:
        """Output folders of batches from ``first`` to before ``end``, by day."""
        out: dict[str, list[str]] = {}
        for path in list_folders(spark, f"{self.output}/anomaly_date=*/batch_id=*"):
            day, batch = path.split("/")[-2:]
            if first <= int(re.sub("^batch_id=", "", batch)) < end:
                out.setdefault(day, []).append(path)
        return out


def start_anomaly_stream(
    trades: DataFrame,
    output: str,
    checkpoint: str,
    threshold: float = S.Z_THRESHOLD,
    trigger: str = S.TABLE_TRIGGER,
    **options,
) -> StreamingQuery:
    """Write anomalies of a decoded trade stream to ``output``; state lives in the checkpoint folder."""
    detector = RollingDetector(output, f"{checkpoint}/rolling_state", threshold, **options)
    writer = trades.writeStream.foreachBatch(detector).option("checkpointLocation", f"{checkpoint}/query")
    if trigger == AVAILABLE_NOW:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()
