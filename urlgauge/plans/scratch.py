"""Scratch folders inside the session's checkpoint folder, reachable by every executor."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession

from .ordered import working_folder


def folder(spark: SparkSession, name: str) -> str:
    return f"{working_folder(spark)}/{name}-{uuid4().hex}"
