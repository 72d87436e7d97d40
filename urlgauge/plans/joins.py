"""Joins of many rows, possibly with hot keys, to a table that is unique by key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .ordered import cut


def lookup(rows: DataFrame, table: DataFrame, on, how: str = "left") -> DataFrame:
    """Join `rows` to `table`, which has one row per key.

    The table is written first, so its size in bytes is known and the optimizer decides on a
    broadcast. Otherwise both sides are plain shuffles, the form in which adaptive execution
    splits a hot partition of the left side into several tasks; an aggregation left inside the
    join would rule that out.
    """
    return rows.join(cut(table), on, how)
