"""Domain-grouped, hash-based splits and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import constants as K
from ..functions import hosts
from ..plans import joins, ordered


def assign(df: DataFrame, url: str = "url", seed: int = K.DEFAULT_SEED, rules=None, host: str | None = None,
           spelling: str | None = None) -> DataFrame:
    """Add domain_group and split; both are functions of the URL, so nothing is shuffled.

    `rules` are required; a URL without a host is an error. `host` and `spelling` name columns that came with the features.
    """
    grouped = hosts.url_group(df, url, rules, host=host, spelling=spelling)
    return grouped.withColumn("split", hosts.choose_split(F.col("domain_group"), seed))


def with_split_row_number(df: DataFrame, row_number: str = "row_number") -> DataFrame:
    return ordered.number_ordinals(df, row_number, "split_row_number", within=["split"])


def leaking_groups(df: DataFrame) -> DataFrame:
    """Domain groups that occur in more than one split; must be empty."""
    return (df.groupBy("domain_group")
            .agg(F.min("split").alias("low"), F.max("split").alias("high"))
            .where("low <> high").select("domain_group"))


def statistics(df: DataFrame) -> DataFrame:
    """Per split: rows, percent, distinct groups and class counts.

    Rows are first combined per group, so the distinct count is a plain count.
    """
    groups = df.groupBy("split", "domain_group").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("label") == 0).alias("label_0_rows"),
        F.count_if(F.col("label") == 1).alias("label_1_rows"))
    splits = groups.groupBy("split").agg(
        F.sum("rows").alias("rows"), F.count("*").alias("domain_groups"),
        F.sum("label_0_rows").alias("label_0_rows"), F.sum("label_1_rows").alias("label_1_rows"))
    total = F.sum("rows").over(Window.partitionBy(F.lit(1)))  # over the three split rows
    return splits.withColumn("row_percent", F.round(100 * F.col("rows") / total, 2))


def check(df: DataFrame) -> list[dict]:
    """Raise on a leak or a one-class split; return the statistics as plain rows."""
    if not leaking_groups(df).isEmpty():
        raise AssertionError("A domain group appears in multiple splits")
    rows = [r.asDict() for r in statistics(df).collect()]
    for row in rows:
        if not row["label_0_rows"] or not row["label_1_rows"]:
            raise ValueError(f"{row['split']} does not contain both classes; review the grouping")
    if {r["split"] for r in rows} != set(K.SPLITS):
        raise ValueError("A split is empty; review the grouping")
    return rows


def assignments_aligned(df: DataFrame) -> DataFrame:
    """Per split: do the ordinals run 1..n without gaps or repeats?"""
    once = df.groupBy("split", "split_row_number").agg(F.count("*").alias("n"))
    return once.groupBy("split").agg(
        F.sum("n").alias("rows"), F.min("split_row_number").alias("low"),
        F.max("split_row_number").alias("high"), F.count("*").alias("distinct_numbers"),
    ).withColumn("contiguous", (F.col("low") == 1) & (F.col("high") == F.col("rows"))
                 & (F.col("distinct_numbers") == F.col("rows")))


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either table the other lacks, counted as multisets; empty when aligned."""
    tagged = left.withColumn("_n", F.lit(1)).unionByName(
        right.select(*left.columns).withColumn("_n", F.lit(-1)))
    return tagged.groupBy(*left.columns).agg(F.sum("_n").alias("surplus")).where("surplus <> 0")


def shared_groups(left: DataFrame, right: DataFrame) -> DataFrame:
    """Domain groups that occur in both tables."""
    return left.select("domain_group").distinct().join(
        right.select("domain_group").distinct(), "domain_group", "left_semi")


def outside_source(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target rows whose domain group never occurs in the other source."""
    return joins.lookup(target, source.select("domain_group").distinct(), "domain_group", "left_anti")
