"""Threshold, ranking, subgroup and comparison metrics of scored rows.

A scored table is long: one row per (example, model) with `label` and `probability`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..plans import ordered


def confusion(scored: DataFrame, by: list[str] | None = None, label: str = "label",
              probability: str = "probability") -> DataFrame:
    y, p = F.col(label) == 1, F.col(probability) >= K.THRESHOLD
    return scored.groupBy(*(by or [])).agg(
        F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"))


def _or_zero(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, 0.0).otherwise(top / bottom)


def threshold_metrics(counts: DataFrame) -> DataFrame:
    """accuracy, balanced_accuracy, precision, recall, f1; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    recall = _or_zero(tp, tp + fn)
    specificity = _or_zero(tn, tn + fp)
    # With one class only, balanced accuracy is the recall of that class.
    balanced = (F.when(tp + fn == 0, specificity).when(tn + fp == 0, recall)
                .otherwise((recall + specificity) / 2))
    return counts.withColumns({
        "accuracy": _or_zero(tn + tp, tn + fp + fn + tp), "balanced_accuracy": balanced,
        "precision": _or_zero(tp, tp + fp), "recall": recall,
        "f1": _or_zero(2 * tp, 2 * tp + fp + fn)})


def curve(scored: DataFrame, by: list[str] | None = None, label: str = "label",
          probability: str = "probability") -> DataFrame:
    """One row per distinct score, best first, with cumulative tp and fp.

    Equal scores are combined before anything is ordered; the running totals come
    from range partitions of the distinct scores.
    """
    by = by or []
    points = scored.groupBy(*by, F.col(probability).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    return ordered.running_totals(
        points, [F.col("score").desc()], {"cum_tp": "pos", "cum_fp": "neg"}, by)


def ranking_metrics(scored: DataFrame, by: list[str] | None = None, label: str = "label",
                    probability: str = "probability") -> DataFrame:
    """roc_auc and average_precision, exact and tie-aware; NULL when a class is missing."""
    points = curve(scored, by, label, probability)
    # Unnormalised sums need no totals beside the rows: the totals divide at the end.
    sums = points.groupBy(*(by or [])).agg(
        F.sum(F.col("pos") * F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("_ap"),
        F.sum(F.col("neg") * (F.col("cum_tp") - F.col("pos") / 2.0)).alias("_area"),
        F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    return sums.select(
        *(by or []),
        F.when((F.col("_pos") > 0) & (F.col("_neg") > 0),
               F.col("_area") / F.col("_pos") / F.col("_neg")).alias("roc_auc"),
        F.when(F.col("_pos") > 0, F.col("_ap") / F.col("_pos")).alias("average_precision"))


METRIC_COLUMNS = ["accuracy", "balanced_accuracy", "precision", "recall", "f1", "roc_auc",
                  "average_precision", "tn", "fp", "fn", "tp"]


def binary_metrics(scored: DataFrame, label: str = "label", probability: str = "probability",
                   by: list[str] | None = None) -> DataFrame:
    """All metrics, one row per `by` group. Everything follows from the score curve."""
    by = by or []
    points = curve(scored, by, label, probability)
    hit = F.col("score") >= K.THRESHOLD
    sums = points.groupBy(*by).agg(
        F.sum(F.when(~hit, F.col("neg")).otherwise(0)).alias("tn"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~hit, F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.col("pos") * F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("_ap"),
        F.sum(F.col("neg") * (F.col("cum_tp") - F.col("pos") / 2.0)).alias("_area"))
    pos, neg = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    full = threshold_metrics(sums).withColumns({
        "roc_auc": F.when((pos > 0) & (neg > 0), F.col("_area") / pos / neg),
        "average_precision": F.when(pos > 0, F.col("_ap") / pos)})
    return full.select(*by, *METRIC_COLUMNS)


def curve_points(scored: DataFrame, by: list[str] | None = None, label: str = "label",
                 probability: str = "probability") -> DataFrame:
    """ROC and precision-recall points per distinct score."""
    by = by or []
    points = curve(scored, by, label, probability)
    totals = points.groupBy(*by).agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    if by:
        joined = points.join(ordered.cut(totals), by)
    else:
        one = totals.first()
        joined = points.withColumns({"_pos": F.lit(one["_pos"]), "_neg": F.lit(one["_neg"])})
    return joined.select(
        *by, "score", "cum_tp", "cum_fp",
        (F.col("cum_fp") / F.col("_neg")).alias("false_positive_rate"),
        (F.col("cum_tp") / F.col("_pos")).alias("recall"),
        (F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("precision"))


def subgroup_metrics(scored: DataFrame, flag: str = "uses_https", variant: str = "variant") -> DataFrame:
    """Per variant and flag value 0 and 1, both always present; undefined rates are NULL."""
    y, p = F.col("label") == 1, F.col("probability") >= K.THRESHOLD

    def counted(value):
        here = F.col(flag) == value
        return F.struct(
            F.lit(value).alias(flag), F.count_if(here).alias("rows"),
            F.count_if(here & ~y & ~p).alias("tn"), F.count_if(here & ~y & p).alias("fp"),
            F.count_if(here & y & ~p).alias("fn"), F.count_if(here & y & p).alias("tp"))

    both = scored.groupBy(variant).agg(F.array(counted(0), counted(1)).alias("g"))
    rows = both.select(variant, F.inline_outer("g"))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return rows.select(
        variant, flag, "rows", (tn + fp).alias("label_0_rows"), (tp + fn).alias("label_1_rows"),
        "tn", "fp", "fn", "tp", F.try_divide(tn + tp, F.col("rows")).alias("accuracy"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(fp, fp + tn).alias("false_positive_rate"))


def flag_share(df: DataFrame, flag: str = "uses_https", by: str = "split") -> DataFrame:
    return df.groupBy(by, "label").agg(
        F.count("*").alias("rows"), F.sum(F.col(flag).cast("long")).alias("https_rows"),
        (F.sum(F.col(flag).cast("long")) / F.count("*")).alias("https_share"))


def change(metrics: DataFrame, base: DataFrame, on: list[str], column: str = "f1",
           name: str = "f1_change") -> DataFrame:
    """Difference of one metric between two metric tables matched on `on`."""
    before = base.select(*on, F.col(column).alias("_base"))
    return metrics.join(before, on, "left").withColumn(
        name, F.col(column) - F.col("_base")).drop("_base")


def best_model(metrics: DataFrame, by: list[str]) -> DataFrame:
    """Per group the row first by f1, recall, average precision, then name."""
    key = F.struct(-F.col("f1"), -F.col("recall"), -F.col("average_precision"), F.col("model"))
    names = F.min(key.alias("k")).alias("k")
    return metrics.groupBy(*by).agg(names).select(*by, F.col("k.model").alias("selected"))


def consistent(stored: DataFrame, recomputed: DataFrame, on: list[str],
               tolerance: float = 1e-8) -> DataFrame:
    """Per row of stored metrics: do all recomputed values agree within tolerance?"""
    other = recomputed.select(*on, *[F.col(c).alias("_" + c) for c in METRIC_COLUMNS])
    agree = F.lit(True)
    for c in METRIC_COLUMNS:
        agree = agree & (F.abs(F.col(c) - F.col("_" + c)) <= tolerance)
    return stored.join(other, on, "left").select(*on, F.coalesce(agree, F.lit(False)).alias("agrees"))


def majority_probability(train: DataFrame) -> DataFrame:
    return train.agg(F.avg("label").alias("probability"))


def class_weights(train: DataFrame) -> dict[int, float]:
    """Balanced weights n / (2 n_c) from the training rows."""
    row = train.agg(F.count("*").alias("n"), F.count_if(F.col("label") == 0).alias("n0"),
                    F.count_if(F.col("label") == 1).alias("n1")).first()
    if not row["n0"] or not row["n1"]:
        raise ValueError("Both classes are required")
    return {0: row["n"] / (2 * row["n0"]), 1: row["n"] / (2 * row["n1"])}


def class_weight_table(train: DataFrame) -> DataFrame:
    counts = train.agg(F.count("*").alias("n"), F.count_if(F.col("label") == 0).alias("n0"),
                       F.count_if(F.col("label") == 1).alias("n1"))
    return counts.select(F.inline_outer(F.array(
        F.struct(F.lit(0).alias("label"), (F.col("n") / (2 * F.col("n0"))).alias("weight")),
        F.struct(F.lit(1).alias("label"), (F.col("n") / (2 * F.col("n1"))).alias("weight")))))
