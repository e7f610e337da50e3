"""Gateway messages: nested JSON to flat telemetry rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.schemas import GATEWAY_MESSAGE


def flatten_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """One flat row per message. The time stays a UTC wall-clock value without a zone."""
    message = F.from_json(column, GATEWAY_MESSAGE)
    return messages.select(message.alias("m")).select(
        "m.gateway_id",
        F.to_timestamp_ntz(F.rtrim(F.replace("m.timestamp", F.lit("T"), F.lit(" ")), F.lit("Z"))).alias("ts"),
        "m.telemetry.*",
        "m.status.*")
