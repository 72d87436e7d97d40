"""Cleaning: label mapping, rejects, conflicts, keep-first duplicates, audit, summary.

A row needs (url, original_label, source_row). One aggregation by key, combined
before the shuffle, decides conflicts and survivors; only keys that occur more
than once come back to the rows. No window is partitioned by key, so a key that
holds a third of the rows is never sorted in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions import features, urls
from ..plans import joins, ordered
from ..sources.registry import Source, mapped, normal_label

AUDIT = ["source_row", "url", "original_label", "original_category", "label"]


def unknown_labels(raw: DataFrame, source: Source) -> DataFrame:
    """Distinct normalised labels outside the source's map (empty ones are allowed)."""
    seen = raw.select(normal_label(F.col("original_label")).alias("label")).distinct()
    return seen.where(~F.col("label").isin([*source.labels, ""]))


def labelled(raw: DataFrame, source: Source) -> DataFrame:
    """Map labels and trim URLs; `trimmed` marks rows that had outer white space."""
    label = normal_label(F.col("original_label"))
    url = urls.strip(F.coalesce(F.col("url"), F.lit("")))
    return raw.select(
        "source_row", url.alias("url"), "original_label",
        mapped(source.categories, label).alias("original_category"),
        mapped(source.labels, label).cast("tinyint").alias("label"),
        (F.coalesce(F.col("url"), F.lit("")) != url).alias("trimmed"),
        (label == "").alias("unlabelled"))


def inspected(raw: DataFrame, source: Source) -> DataFrame:
    """Add url_key, hostname and reason; a missing label outranks every other reason."""
    rows = urls.inspect(labelled(raw, source))
    return rows.withColumn(
        "reason", F.when(F.col("unlabelled"), "missing_label").otherwise(F.col("reason"))
    ).drop("unlabelled")


def joined_categories(source: Source, category: str = "original_category") -> Column:
    """Sorted distinct categories joined by ';'. The category set is fixed and small."""
    names = sorted(set(source.categories.values()))
    present = [F.when(F.max(F.when(F.col(category) == n, 1)) == 1, n) for n in names]
    return F.array_join(F.array_compact(F.array(*present)), ";")


def repeated_keys(rows: DataFrame, source: Source) -> DataFrame:
    """One row per key that occurs more than once among the valid rows."""
    return (
        rows.where("reason = ''").groupBy("url_key")
        .agg(F.min("source_row").alias("first_row"), F.min("label").alias("low"),
             F.max("label").alias("high"), F.count("*").alias("records"),
             joined_categories(source).alias("categories"))
        .where("records > 1"))


def conflicting_keys(rows: DataFrame) -> DataFrame:
    """Keys that carry both labels; a difference of category alone is no conflict."""
    return (packed(rows.where("reason = ''")).groupBy("packed_key")
            .agg(F.min("label").alias("low"), F.max("label").alias("high"))
            .where("low <> high").select(F.lower(F.hex("packed_key")).alias("url_key")))


def packed(rows: DataFrame) -> DataFrame:
    """Add packed_key, the 32 bytes that the 64 digits of `url_key` stand for: half as much to shuffle."""
    return rows.withColumn("packed_key", F.unhex("url_key"))


def eligible(rows: DataFrame) -> DataFrame:
    """The valid rows whose key isn't in conflict."""
    conflicting = packed(conflicting_keys(rows)).select("packed_key")
    valid = packed(rows.where("reason = ''")).drop("url_key")
    return joins.lookup(valid, conflicting, "packed_key", "left_anti")


def routed(raw: DataFrame, source: Source) -> DataFrame:
    """Every input row with its route: invalid, conflict, duplicate or kept.

    The inspected rows are used twice, so they are written once instead of parsed
    twice.
    """
    rows = ordered.cut(inspected(raw, source))
    # Rejected rows share the empty key, so they go past the join.
    joined = joins.lookup(rows.where("reason = ''"), repeated_keys(rows, source), "url_key").unionByName(
        rows.where("reason <> ''"), allowMissingColumns=True)
    route = (F.when(F.col("reason") != "", "invalid")
             .when(F.col("low") != F.col("high"), "conflict")
             .when(F.col("first_row") != F.col("source_row"), "duplicate")
             .otherwise("kept"))
    return joined.select(
        "source_row", "url", "original_label", "original_category", "label", "trimmed",
        "url_key", "hostname",
        F.when(route == "conflict", "conflicting_binary_labels").otherwise(F.col("reason")).alias("reason"),
        route.alias("route"),
        F.coalesce("first_row", "source_row").alias("first_row"),
        F.coalesce("records", F.lit(1)).alias("records"),
        F.coalesce("categories", "original_category").alias("categories"))


def featured(route: DataFrame) -> DataFrame:
    """Features of the kept rows; a row whose features are unusable gets route 'failed'."""
    rows = features.with_features(route.where("route = 'kept'"))
    ok = features.finite()
    return rows.withColumns({
        "reason": F.when(ok, F.col("reason")).otherwise("feature_extraction_ValueError"),
        "route": F.when(ok, F.col("route")).otherwise("failed")})


@dataclass
class Prepared:
    table: DataFrame
    metadata: DataFrame
    excluded: DataFrame
    duplicates: DataFrame


def split_routes(route: DataFrame, scored: DataFrame, dataset: str) -> Prepared:
    """The four outputs from the routed rows and the featured kept rows.

    Both inputs are best read back from written tables: they are used several times.
    """
    kept = ordered.number_ordinals(scored.where("route = 'kept'"), "source_row")
    numbers = kept.select(F.col("source_row").alias("first_row"),
                          F.col("row_number").alias("retained_row_number"))
    again = route.where("route = 'duplicate'").select(*AUDIT, "first_row")
    retained = numbers.join(again.select("first_row").distinct(), "first_row", "left_semi")
    duplicates = joins.lookup(again, retained, "first_row").select(*AUDIT, "retained_row_number")
    excluded = route.where("route in ('invalid', 'conflict')").select(*AUDIT, "reason").unionByName(
        scored.where("route = 'failed'").select(*AUDIT, "reason"))
    metadata = kept.select(
        "row_number", F.lit(dataset).alias("dataset"), "source_row", "url_key", "hostname",
        "original_label", F.col("categories").alias("original_categories"),
        F.col("records").alias("source_record_count"))
    table = kept.select("row_number", "url", "label", *K.FEATURES)
    return Prepared(table, metadata, excluded, duplicates)


def reconcile(route: DataFrame) -> DataFrame:
    """One row: input = excluded + duplicates + output, and every kept key occurs once."""
    return route.agg(
        F.count("*").alias("input_rows"),
        F.count_if(F.col("route").isin("invalid", "conflict", "failed")).alias("excluded_rows"),
        F.count_if(F.col("route") == "duplicate").alias("duplicate_rows"),
        F.count_if(F.col("route") == "kept").alias("output_rows"),
        F.count_if((F.col("route") == "kept") & (F.col("url_key") == "")).alias("missing_keys"),
    ).withColumn("reconciled", F.col("input_rows") == F.col("excluded_rows")
                 + F.col("duplicate_rows") + F.col("output_rows"))


def summary(route: DataFrame) -> DataFrame:
    """Counts of a preparation run in one row, from one aggregation."""
    # A conflicting key is counted through its first row only.
    return route.agg(
        F.count("*").alias("input_rows"),
        F.count_if(F.col("route") == "kept").alias("output_rows"),
        F.count_if((F.col("route") == "kept") & (F.col("label") == 0)).alias("output_label_0"),
        F.count_if((F.col("route") == "kept") & (F.col("label") == 1)).alias("output_label_1"),
        F.count_if("trimmed").alias("outer_whitespace_trimmed_rows"),
        F.count_if(F.col("route") == "invalid").alias("invalid_rows"),
        F.count_if((F.col("route") == "conflict") & (F.col("first_row") == F.col("source_row")))
        .alias("conflicting_url_keys"),
        F.count_if(F.col("route") == "conflict").alias("conflicting_label_rows"),
        F.count_if(F.col("route") == "duplicate").alias("duplicate_rows"))


def value_counts(df: DataFrame, column: str, name: str = "value") -> DataFrame:
    return df.groupBy(F.col(column).cast("string").alias(name)).agg(F.count("*").alias("rows"))
