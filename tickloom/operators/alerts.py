"""Alert payloads for severe anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rounding import fixed_text, grouped_text

# Severities that alert, and their look.
ALERTING = ["CRITICAL", "EXTREME"]
COLORS = {"EXTREME": "#FF0000", "CRITICAL": "#FF6600", "WARNING": "#FFCC00"}
OTHER_COLOR = "#999999"
EMOJI = {"EXTREME": ":rotating_light:", "CRITICAL": ":warning:", "WARNING": ":large_yellow_circle:"}
OTHER_EMOJI = ":question:"


def alerting(anomalies: DataFrame) -> DataFrame:
    return anomalies.filter(F.col("severity").isin(ALERTING))


def _lookup(table: dict[str, str], key: Column, default: str) -> Column:
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def alert_texts(anomalies: DataFrame) -> DataFrame:
    """One row per anomaly with every text of its alert as a flat column."""
    col = F.col
    direction = F.when(col("price_zscore") > 0, "UP").otherwise("DOWN")
    return anomalies.select(
        *[c for c in ("seq",) if c in anomalies.columns],
        "symbol",
        "severity",
        _lookup(COLORS, col("severity"), OTHER_COLOR).alias("color"),
        F.concat_ws(" ", _lookup(EMOJI, col("severity"), OTHER_EMOJI), col("severity"), F.lit("Anomaly:"), col("symbol")).alias("header"),
        F.concat(F.lit("*Price:* $"), fixed_text(col("price"), 2), F.lit(" ("), direction, F.lit(")")).alias("price_text"),
        F.concat(F.lit("*Volume:* "), grouped_text(col("volume"))).alias("volume_text"),
        F.concat(F.lit("*Price Z-Score:* "), fixed_text(col("price_zscore"), 2)).alias("price_z_text"),
        F.concat(F.lit("*Volume Z-Score:* "), fixed_text(col("volume_zscore"), 2)).alias("volume_z_text"),
        F.concat(F.lit("*Type:* "), col("anomaly_type")).alias("type_text"),
        F.concat(F.lit("*Detected:* "), F.substring("detected_at", 1, 19)).alias("detected_text"),
        F.concat(
            F.lit("Price mean: $"), fixed_text(col("price_mean"), 2),
            F.lit(" (σ="), fixed_text(col("price_std"), 2),
            F.lit(") | Volume mean: "), grouped_text(col("volume_mean")),
            F.lit(" (σ="), grouped_text(col("volume_std")), F.lit(")"),
        ).alias("context_text"),
    )


def _markdown(name: str) -> Column:
    return F.struct(F.lit("mrkdwn").alias("type"), F.col(name).alias("text"))


def alert_payloads(anomalies: DataFrame) -> DataFrame:
    """Severe anomalies as ready-to-post JSON messages, beside their flat texts."""
    fields = ["price_text", "volume_text", "price_z_text", "volume_z_text", "type_text", "detected_text"]
    header = F.struct(
        F.lit("header").alias("type"),
        F.struct(F.lit("plain_text").alias("type"), F.col("header").alias("text")).alias("text"),
    )
    section = F.struct(F.lit("section").alias("type"), F.array(*[_markdown(f) for f in fields]).alias("fields"))
    context = F.struct(F.lit("context").alias("type"), F.array(_markdown("context_text")).alias("elements"))
    # blocks differ in shape, so each is rendered on its own and the list is joined
    blocks = F.concat(
        F.lit("["), F.concat_ws(",", F.to_json(header), F.to_json(section), F.to_json(context)), F.lit("]")
    )
    payload = F.concat(
        F.lit('{"attachments":[{"color":"'), F.col("color"), F.lit('","blocks":'), blocks, F.lit("}]}")
    )
    return alert_texts(alerting(anomalies)).withColumn("payload", payload)
