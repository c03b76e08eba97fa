"""Vendor tick messages: a JSON array of events to normalised trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.temporal import iso_text

# The field names of a tick event. Every field is read as text first, so one odd value cannot null its neighbours.
_EVENTS = "array<struct<ev:string,sym:string,p:string,s:string,t:string,x:string,c:string>>"


# the milliseconds of the years 1 to 9999
_FIRST_MS, _LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def _millis(event: Column) -> Column:
    return event["t"].try_cast("bigint")


def _reason(event: Column) -> Column:
    """Why an event is no trade, null if it is one."""
    return (
        F.when(event.isNull(), "not_an_event")
        .when(F.coalesce(event["ev"], F.lit("")) != "T", "not_a_trade")
        .when(~F.coalesce(_millis(event).between(_FIRST_MS, _LAST_MS), F.lit(True)), "time_out_of_range")
    )


def rejected_ticks(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """What ``normalize_ticks`` leaves out, each with a reason: ``keep``, event_index, value, reason.

    A message that is no array of events is one row (``malformed``, or ``empty``) without an index;
    an event that is no trade, or whose time is out of range, is one row with its place in the
    array. So each event is in one of the two, and each message without events here.
    """
    held = F.from_json(F.col("value").cast("string"), _EVENTS)
    # text that is no JSON array is read as one event of nulls or none at all
    is_array = F.trim(F.col("value").cast("string")).startswith("[")
    listed = messages.select(*keep, "value", F.when(is_array, held).alias("events"))
    malformed = F.col("events").isNull().alias("malformed")
    # in one pass: a message without events gives one row without an index
    rows = listed.select(*keep, "value", malformed, F.posexplode_outer("events").alias("event_index", "event"))
    no_event = F.col("event_index").isNull()
    reason = F.when(F.col("malformed"), "malformed").when(no_event, "empty").otherwise(_reason(F.col("event")))
    value = F.when(no_event, F.col("value").cast("string")).otherwise(F.to_json("event"))
    judged = rows.withColumn("reason", reason).filter(F.col("reason").isNotNull())
    return judged.select(*keep, "event_index", value.alias("value"), "reason")


def normalize_ticks(messages: DataFrame, ingested_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Explode ``value`` (a JSON array) and keep trade events (``ev`` = T), renamed and typed.

    The rest, events whose time no timestamp can hold included, is in ``rejected_ticks``.
    """
    event = F.col("event")
    event_time = F.timestamp_millis(_millis(event))
    stamp = ingested_at if ingested_at is not None else F.current_timestamp()
    return (
        messages.select(*keep, F.explode(F.from_json(F.col("value").cast("string"), _EVENTS)).alias("event"))
        .filter(_reason(event).isNull())
        .select(
            *keep,
            event["sym"].alias("symbol"),
            event["p"].try_cast("double").alias("price"),
            event["s"].try_cast("double").try_cast("bigint").alias("volume"),
            iso_text(event_time).alias("timestamp"),
            F.coalesce(event["x"], F.lit("")).alias("exchange"),
            F.coalesce(event["c"], F.lit("[]")).alias("conditions"),
            iso_text(stamp).alias("ingested_at"),
            event_time.alias("event_time"),
        )
    )
