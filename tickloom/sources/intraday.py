"""Vendor intraday responses: one JSON object per symbol, a map of minute bars, to trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.temporal import iso_text

# Field names of the response and the exchange label of its rows.
SERIES_KEY = "Time Series (1min)"
ERROR_KEY = "Error Message"
NOTE_KEY = "Note"
EXCHANGE = "alpha_vantage"

_RESPONSE = (
    f"struct<`{SERIES_KEY}`:map<string,map<string,string>>,`{ERROR_KEY}`:string,`{NOTE_KEY}`:string>"
)


def _parsed(responses: DataFrame) -> DataFrame:
    return responses.withColumn("response", F.from_json("payload", _RESPONSE))


def normalize_intraday(responses: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Rows (``symbol``, ``payload``) to trades at each bar's close, in time order per response.

    Error and rate-limit responses yield nothing here; see ``rejected_responses``.
    """
    response = F.col("response")
    bars = F.transform(
        F.map_entries(response[SERIES_KEY]),
        lambda entry: F.struct(
            entry["key"].alias("at"),
            entry["value"]["1. open"].alias("open"),
            entry["value"]["2. high"].alias("high"),
            entry["value"]["3. low"].alias("low"),
            entry["value"]["4. close"].alias("close"),
            entry["value"]["5. volume"].alias("volume"),
        ),
    )
    bar = F.col("bar")
    event_time = F.try_to_timestamp(bar["at"], F.lit("yyyy-MM-dd HH:mm:ss"))
    stamp = ingested_at if ingested_at is not None else F.current_timestamp()
    return (
        _parsed(responses)
        .filter(response[ERROR_KEY].isNull() & response[NOTE_KEY].isNull())
        .select("symbol", F.explode(F.sort_array(bars)).alias("bar"))
        .select(
            "symbol",
            bar["close"].try_cast("double").alias("price"),
            bar["open"].try_cast("double").alias("open"),
            bar["high"].try_cast("double").alias("high"),
            bar["low"].try_cast("double").alias("low"),
            bar["volume"].try_cast("bigint").alias("volume"),
            iso_text(event_time).alias("timestamp"),
            F.lit(EXCHANGE).alias("exchange"),
            F.lit("[]").alias("conditions"),
            iso_text(stamp).alias("ingested_at"),
            event_time.alias("event_time"),
        )
    )


def refused_responses(responses: DataFrame) -> DataFrame:
    """Every response without a trade, with a reason and, where it has one, its message.

    Beside errors and rate limits: ``malformed`` text, responses without a series (``no_series``),
    and with one that holds no bar (``empty_series``). Each response is either here or in
    ``normalize_intraday``.
    """
    response = F.col("response")
    # text that is no JSON object is read as an object of nulls
    is_object = F.coalesce(F.json_object_keys("payload").isNotNull(), F.lit(False))
    reason = (
        F.when(response[ERROR_KEY].isNotNull(), "api_error")
        .when(response[NOTE_KEY].isNotNull(), "rate_limited")
        .when(~is_object, "malformed")
        .when(response[SERIES_KEY].isNull(), "no_series")
        .when(F.size(response[SERIES_KEY]) == 0, "empty_series")
    )
    return (
        _parsed(responses)
        .withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .withColumn("message", F.coalesce(response[ERROR_KEY], response[NOTE_KEY]))
        .drop("response")
    )


def rejected_responses(responses: DataFrame) -> DataFrame:
    """Responses that carry an error or a rate-limit note, with kind and message."""
    response = F.col("response")
    return (
        _parsed(responses)
        .filter(response[ERROR_KEY].isNotNull() | response[NOTE_KEY].isNotNull())
        .withColumn("reason", F.when(response[ERROR_KEY].isNotNull(), "api_error").otherwise("rate_limited"))
        .withColumn("message", F.coalesce(response[ERROR_KEY], response[NOTE_KEY]))
        .drop("response")
    )
