"""Fixed schemas and constants of the data model."""

from pyspark.sql import types as T

TRADE_MESSAGE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("conditions", T.StringType()),
        T.StructField("ingested_at", T.StringType()),
    ]
)

# Window lengths, watermark, topics, table names.
BAR_WINDOWS = {"ohlcv_1min": "1 minute", "ohlcv_5min": "5 minutes", "ohlcv_1hr": "1 hour"}
WATERMARK = "30 seconds"
TABLE_TRIGGER = "30 seconds"
PUBLISH_TRIGGER = "10 seconds"
TOPIC_TRADES = "stock.trades"
TOPIC_ANOMALIES = "stock.anomalies"
RAW_TRADES = "trades_raw_stream"
#: Decoded messages, from which the speed layer's queries read.
LANDED = "messages_landed"

ANOMALY = (
    "symbol string, price double, volume bigint, timestamp string, price_zscore double, volume_zscore double, "
    "price_mean double, price_std double, volume_mean double, volume_std double, severity string, "
    "anomaly_type string, detected_at string, anomaly_date date"
)

# Anomaly scoring.
LOOKBACK = 100
Z_WARNING = 2.0
Z_CRITICAL = 3.0
Z_EXTREME = 4.0
Z_THRESHOLD = 3.0

# Symbols followed when none are configured.
DEFAULT_SYMBOLS = "AAPL,GOOGL,MSFT,AMZN,TSLA,NVDA,META,JPM,V,JNJ"
