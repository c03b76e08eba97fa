"""The speed layer: three bar tables, the raw trade table and the rejects, fed by one message stream.

The topic is read and decoded once: one query lands the decoded messages in a table, and all
others stream from it, each at its own pace and from its own checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom import schemas as S
from tickloom.operators.bars import ohlcv
from tickloom.session import make_folder
from tickloom.sinks.streams import AVAILABLE_NOW, to_table
from tickloom.sources.messages import landed_messages, with_watermark
from tickloom.sources.warehouse import Warehouse


def bar_stream(trades: DataFrame, duration: str) -> DataFrame:
    """Bars of watermarked trades. A bar appears once the watermark passes its end; trades
    for closed bars and trades without a time are left out."""
    return ohlcv(trades, duration).withColumn("trade_date", F.to_date("window_start"))


def raw_trades(trades: DataFrame) -> DataFrame:
    """Every trade with its load time, late and undated ones included.

    The message's ``seq``, where it has one, is kept: it settles equal times in batch.
    """
    return trades.select(
        "symbol",
        "price",
        "volume",
        "event_time",
        "exchange",
        F.current_timestamp().alias("loaded_at"),
        F.to_date("event_time").alias("trade_date"),
        *[F.col(name) for name in ("seq",) if name in trades.columns],
    )


class SpeedLayer(dict[str, StreamingQuery]):
    """The queries by their tables; ``landing`` is the one that feeds them."""

    landing: StreamingQuery


def landed_stream(landed: DataFrame, path: str) -> DataFrame:
    """A stream of the landed table, of the schema of ``landed``; it holds what the landing query has committed."""
    return landed.sparkSession.readStream.schema(landed.schema).parquet(path)


def start_speed_layer(
    messages: DataFrame, warehouse: Warehouse, checkpoints: str, trigger: str = S.TABLE_TRIGGER
) -> SpeedLayer:
    """Start the landing query and, on the table it writes, the four table queries and one for rejects.

    Each has its own checkpoint. With all that is available, the landing ends before the others begin.
    """
    landed = landed_messages(messages)
    path = warehouse.path(S.LANDED)
    make_folder(warehouse.spark, path)  # the others may look before anything has landed
    layer = SpeedLayer()
    layer.landing = to_table(landed, path, f"{checkpoints}/{S.LANDED}", trigger, name=S.LANDED)
    if trigger == AVAILABLE_NOW:
        layer.landing.awaitTermination()
    trades = landed_stream(landed, path)
    timed = with_watermark(trades)
    outputs = {table: bar_stream(timed, duration) for table, duration in S.BAR_WINDOWS.items()}
    outputs[S.RAW_TRADES] = raw_trades(trades)
    dated = list(outputs)
    kept = [c for c in ("seq",) if c in trades.columns]
    rejected = trades.filter(F.col("reason").isNotNull())
    outputs["trades_rejected"] = rejected.select(*kept, F.col("rejected_value").alias("value"), "reason")
    for table, df in outputs.items():
        layer[table] = to_table(
            df,
            warehouse.path(table),
            f"{checkpoints}/{table}",
            trigger,
            partition_by="trade_date" if table in dated else None,
            name=table,
        )
    return layer
