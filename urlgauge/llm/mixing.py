"""Mixing sources to target weights by capped water-filling.

Every source asks for its weight's share of the total; no target may exceed `max_epochs` times the
source's size. Sources above their cap are clamped, the excess is reshared among the others by
weight, and so on until no target is above its cap. Each round is one aggregation over the
sources, and only its two sums come to the driver.

A target is met by whole repetitions of the source and a fractional one: documents are taken in
the order of a seeded hash until the remaining words are used up; the document at that border
gives only the words still missing, so the words taken equal the rounded target. The order is kept
in blocks by the hash's first three digits, so no task holds a source.

Size: number of runs of characters outside [\\x20\\x09-\\x0D]; a null text has 0. A null source is a
source of its own. A source whose documents are all empty has target 0 and takes nothing. Rows that
repeat are documents of their own; ties of the hash are broken by text hash and size. Rows without an id are
ordered by a hash of their text instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, written

BLOCK_DIGITS = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cycle_weights(sources: DataFrame, weights: tuple = (5, 2, 1)) -> DataFrame:
    """Weights by the sources' code-point order, null last, repeating. One row per source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int")).cast("bigint"))


def water_fill(sources: DataFrame, total: int, max_epochs: int = 3) -> DataFrame:
    """Add `target` (double) to (source, weight, source_size): the level times the weight, or the cap.

    The level only rises, so each round clamps at least one more source or is the last."""
    cap = F.col("source_size") * max_epochs
    level = None
    while True:
        over = F.lit(False) if level is None else cap <= F.lit(level) * F.col("weight")
        row = sources.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("open")).first()
        raised = (total - row["held"]) / row["open"] if row["open"] else level
        if raised is None or raised == level:
            break
        level = raised
        if not row["open"]:
            break
    level = 0.0 if level is None else level
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(float(level)) * F.col("weight")))


def mix(docs: DataFrame, weights=cycle_weights, max_epochs: int = 3, seed: str = "mix",
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        keep: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken; `keep` columns too.

    `weights` turns the table of sources (source, source_size) into one with a positive `weight`.
    """
    sized = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).alias("source"),
        words(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("_text"),
        F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.concat(
            F.lit("text:"), F.xxhash64(F.col(text_col)).cast("string"))))).alias("_order"))
    sized = written(sized.withColumn("_block", F.substring("_order", 1, BLOCK_DIGITS)), "sized")
    blocks = written(sized.groupBy("source", "_block").agg(F.sum("size").alias("_words")), "blocks")
    sources = blocks.groupBy("source").agg(F.sum("_words").alias("source_size"))
    sources = written(weights(sources), "sources")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    targets = water_fill(sources, total, max_epochs)
    size, target = F.col("source_size"), F.col("target")
    whole = F.when(size > 0, F.floor(target / size)).otherwise(0).cast("bigint")
    targets = targets.select(
        "source", "source_size", "target", whole.alias("_whole"),
        F.greatest(F.lit(0), F.round(target).cast("bigint") - whole * size).alias("_rest"))
    # Words of a source before each block: sources x 4096 rows at most.
    before = F.sum("_words").over(Window.partitionBy("source").orderBy("_block")) - F.col("_words")
    placed = written(blocks.withColumn("_before", before).join(
        targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "_words")
        .withColumnsRenamed({"source": "_s", "_block": "_b"}), "targets")
    joined = sized.join(placed, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")))
    run = F.sum("size").over(
        Window.partitionBy("source", "_block").orderBy("_order", "doc_id", "_text", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size") + F.col("_before")
    part = F.least(F.col("size"), F.greatest(F.lit(0), F.col("_rest") - run))
    return joined.select("doc_id", "size", "source_size", "target",
                         (F.col("_whole") * F.col("size") + part).cast("bigint").alias("taken"), "source")


def repeated(docs: DataFrame, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """The mix as documents: each as often as `taken` holds its size, a half or more counting as one.

    Columns and texts are those of `docs`; empty documents, which have no words to take, are kept once.
    Documents are looked up by doc_id; rows that repeat one id repeat alike."""
    taken = mix(docs, max_epochs=max_epochs, seed=seed).groupBy("doc_id").agg(
        F.sum("size").alias("size"), F.sum("taken").alias("taken"))
    times = taken.select(
        F.col("doc_id").alias("__mix_id"),
        F.when(F.col("size") == 0, 1).otherwise(F.round(F.col("taken") / F.col("size"))).cast("int").alias("__mix_times"))
    times = written(times.where("__mix_times > 0"), "times")
    joined = docs.join(times, F.col("doc_id").eqNullSafe(F.col("__mix_id")))
    copies = joined.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_times"))))
    return copies.select(*docs.columns)
