"""Service tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.clock import month_of
from wattloom.functions.texts import ticket_tone
from wattloom.operators.accounts import share_of_total


def open_tickets(tickets: DataFrame, as_of: str, priorities: tuple[str, ...]) -> DataFrame:
    """Tickets raised by ``as_of`` and not resolved by then."""
    day = F.to_date(F.lit(as_of))
    unresolved = F.col("resolution_date").isNull() | (F.col("resolution_date") > day)
    return tickets.where((F.col("log_date") <= day) & unresolved & F.col("priority").isin(*priorities)).select(
        "log_id", "customer_key", "log_date", "topic", "priority")


def topic_priority_shares(tickets: DataFrame) -> DataFrame:
    counts = tickets.groupBy("topic", "priority").agg(F.count("*").alias("tickets"))
    return share_of_total(counts, "tickets", "share_of_topic", within=["topic"])


def sentiment_trend(tickets: DataFrame, as_of: str, months: int = 6) -> DataFrame:
    last = F.trunc(F.to_date(F.lit(as_of)), "month")
    recent = (F.col("log_date") >= F.add_months(last, -(months - 1))) & (F.col("log_date") < F.add_months(last, 1))
    return (tickets.where(recent).groupBy(month_of("log_date").alias("month"), "sentiment")
            .agg(F.count("*").alias("tickets")))


def tagged_tickets(tickets: DataFrame) -> DataFrame:
    return tickets.withColumn("tone", ticket_tone(F.col("description")))
