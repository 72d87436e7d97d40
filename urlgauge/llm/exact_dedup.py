"""Exact deduplication against a persistent index of text digests.

The index is a table bucketed and sorted by digest, one row per distinct text. A batch of new
documents is reduced to one candidate per digest, joined against the index by a sort-merge
anti-join that does not shuffle the index, and the survivors are appended.

Texts are equal when they are identical once every character of [\\x20\\x09-\\x0D] is deleted.
A null text counts as empty; all empty texts are equal. Of equal new texts the one with the most
code points stays, then the smallest doc_id, null ids last. Rows that repeat with the same
doc_id and text are one document repeated: every such row is returned, and one id is kept.

A batch with a name can be added again: texts that the index holds from the batch itself are new to it, so a
batch whose answer was lost gets the same answer, and nothing is appended twice. An added batch leaves up to one
file per bucket; Spark sorts buckets of several files again for the join, `compact` makes them one.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import SPACES, written


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


class ExactIndex:
    """Table `name` in the session's catalog: digest, keep_id, keep_chars, batch; bucketed by digest. The session's
    warehouse must be a folder that all executors reach.

    `buckets` counts for a new table only."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = 64):
        self.spark, self.name, self.buckets = spark, name, buckets
        if spark.catalog.tableExists(name):
            told = spark.sql(f"describe extended {name}").where("col_name = 'Num Buckets'").first()
            self.buckets = int(told["data_type"])
        else:
            empty = spark.createDataFrame([], "digest string, keep_id bigint, keep_chars bigint, batch string")
            self._append(empty)

    def _append(self, rows: DataFrame, name: str | None = None) -> None:
        # One file per bucket: the rows are dealt out as the buckets are.
        (rows.select("digest", "keep_id", "keep_chars", "batch").repartition(self.buckets, "digest").write
         .bucketBy(self.buckets, "digest").sortBy("digest").mode("append").saveAsTable(name or self.name))

    def compact(self) -> "ExactIndex":
        """The same rows in one file per bucket, as a new table; the old one is left for its readers to finish."""
        name = f"{self.name}_{uuid4().hex[:8]}"
        self._append(self.table(), name)
        return ExactIndex(self.spark, name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def fresh(self, candidates: DataFrame) -> DataFrame:
        """Candidates (one row per digest) whose digest the index does not hold yet."""
        return candidates.hint("merge").join(self.table().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
        """Append the new distinct texts of `docs`; return one row per row of `docs`. Give `batch` a name of its own
        if the call may be repeated.

        Columns: doc_id, keep_id, group_size (rows of this batch with the digest), kept,
        text_sha256, known (the text was in the index before this batch; then no row is kept).
        """
        text, batch = F.col(text_col), batch or uuid4().hex
        rows = written(docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"), digest(text).alias("digest"),
            F.coalesce(F.length(text), F.lit(0)).cast("bigint").alias("chars")), "digests")
        # Of each text, the most code points and then the smallest id, combined before the shuffle.
        order = F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id"))
        groups = rows.groupBy("digest").agg(
            F.min_by(F.struct("doc_id", "chars"), order).alias("best"),
            F.count("*").alias("group_size"))
        groups = written(groups.select(
            "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.chars").alias("keep_chars"),
            "group_size"), "groups")
        self._append(written(self.fresh(groups), "fresh").withColumn("batch", F.lit(batch)))
        # Kept ids come from the index. A digest that was known keeps the indexed document's id.
        held = groups.select("digest", "group_size").hint("merge").join(
            self.table().select("digest", "keep_id", "batch").hint("merge"), "digest")
        decided = written(held.select("digest", "group_size", "keep_id", (F.col("batch") != batch).alias("known")), "decided")
        # Two plain shuffles: a digest that holds a third of the rows is split by adaptive execution.
        return rows.join(decided, "digest").select(
            "doc_id", "keep_id", "group_size",
            (~F.col("known") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            F.col("digest").alias("text_sha256"), "known")
