"""Queries over the append-only history of checked URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions import cards
from ..plans import ordered


def shown_status() -> "F.Column":
    return cards.display_status(F.col("status"), F.col("trust_score"))


def search(history: DataFrame, text: str = "", status: str = "All") -> DataFrame:
    """Case-insensitive substring of the URL and, unless 'All', the shown status."""
    found = history.where(F.contains(F.lower("url"), F.lower(F.lit(text))))
    return found if status == "All" else found.where(shown_status() == status)


def get(history: DataFrame, check_id: int) -> DataFrame:
    return history.where(F.col("id") == check_id)


def recent(history: DataFrame, count: int = K.HISTORY_RECENT) -> DataFrame:
    """Newest first; each task keeps `count` rows before the merge."""
    return history.orderBy(F.col("id").desc()).limit(count)


def retained(history: DataFrame, count: int = K.HISTORY_KEEP) -> DataFrame:
    return recent(history, count)


def dashboard(history: DataFrame) -> DataFrame:
    status = shown_status()
    return history.agg(
        F.count("*").alias("total_checks"),
        F.count_if(status == "Safe").alias("lower_predicted_risk"),
        F.count_if(status == "Dangerous").alias("potential_phishing"))


def check_numbers(history: DataFrame, order: list[str] = ("ts", "id")) -> DataFrame:
    """Chronological check index 1, 2, 3, ..."""
    return ordered.number_rows(history, list(order), "check_number")


def next_id(history: DataFrame) -> DataFrame:
    return history.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("next_id"))


def windowed_totals(history: DataFrame, minutes: int = 5) -> DataFrame:
    """Counts per tumbling window and shown status; the batch twin of the stream."""
    return (history.groupBy(F.window("ts", f"{minutes} minutes").alias("w"),
                            shown_status().alias("shown"))
            .agg(F.count("*").alias("checks"))
            .select(F.col("w.start").alias("window_start"), "shown", "checks"))
