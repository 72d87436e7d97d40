"""Reading raw lists, feature tables, requests, history, files and suffix rules."""

from __future__ import annotations

import hashlib
import re
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import constants as K
from ..functions import features
from ..plans import ordered
from .registry import Source

FEATURE_SCHEMA = T.StructType(
    [T.StructField("url", T.StringType()), T.StructField("label", T.ByteType())]
    + [T.StructField(n, T.DoubleType() if n in K.DOUBLE_FEATURES else T.IntegerType())
       for n in K.FEATURES])
REQUEST_SCHEMA = "request_id string, url string, ts timestamp"
HISTORY_SCHEMA = (
    "id long, url string, trust_score double, risk_percent double, status string, "
    "reasons array<struct<title:string,flagged:boolean,detail:string>>, checked_at string, ts timestamp")


#: Bytes of a plain scan that one task should get. URL work costs far more than reading.
TASK_BYTES = 4 << 20


def spread(scan: DataFrame) -> DataFrame:
    """Deal a scan out into tasks of bounded size, however its files are cut.

    A row group is never divided between tasks, so splits alone leave some of them empty and others with
    millions of rows. `scan` must be a plain scan: its size is that of its files. Filters and column
    choices still move below the added exchange.
    """
    size = int(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = min(32, scan.sparkSession.sparkContext.defaultParallelism)
    return scan.repartition(max(least, -(-size // TASK_BYTES)))


def read_raw_csv(spark: SparkSession, path: str, source: Source) -> DataFrame:
    """Two text columns of a raw list, empty cells as '', with a 1-based source_row.

    Quoted line breaks keep one file in one task, so supply many files at scale.
    The row order is (file, position in the file).
    """
    header = spark.read.option("header", True).csv(path, multiLine=True, escape='"').columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in header])
    raw = spark.read.schema(schema).csv(
        path, header=True, multiLine=True, escape='"', encoding="UTF-8",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    names = {n.lstrip("﻿"): n for n in header}
    picked = raw.select(
        F.coalesce(F.col(f"`{names[source.url_column]}`"), F.lit("")).alias("url"),
        F.coalesce(F.col(f"`{names[source.label_column]}`"), F.lit("")).alias("original_label"),
        F.col("_metadata.file_path").alias("_file"),
        F.monotonically_increasing_id().alias("_position"))
    return ordered.number_rows(picked, ["_file", "_position"], "source_row").drop("_file", "_position")


def with_source_row(df: DataFrame, key: list[str]) -> DataFrame:
    """1-based ordinal of a table by a declared unique key."""
    return ordered.number_rows(df, key, "source_row")


def contract(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """One row of counts a feature table must satisfy, from one pass."""
    expected = expected or ["url", "label", *K.FEATURES]
    if df.columns[:len(expected)] != expected:
        raise ValueError(f"Expected the columns {expected}")
    counts = [f for f in K.COUNT_FEATURES if f in df.columns]
    negative = F.least(*[F.col(c) for c in counts]) < 0
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("label").isNull() | ~F.col("label").isin(0, 1)).alias("bad_label"),
        F.count_if(~features.finite([f for f in K.FEATURES if f in df.columns])).alias("not_finite"),
        F.count_if(negative).alias("negative"),
        F.count_if(F.col("label") == 0).alias("label_0_rows"),
        F.count_if(F.col("label") == 1).alias("label_1_rows"))


def check_contract(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Raise unless the feature table is usable; returns it unchanged."""
    found = contract(df).first()
    if rows is not None and found["rows"] != rows:
        raise ValueError("Row count disagrees with the split summary")
    if found["bad_label"] or not found["label_0_rows"] or not found["label_1_rows"]:
        raise ValueError("Both classes, 0 and 1 and nothing else, are required")
    if found["not_finite"]:
        raise ValueError("The feature table contains missing or non-finite values")
    return df


def read_features(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    df = spark.read.schema(FEATURE_SCHEMA).parquet(path)
    return check_contract(df) if check else df


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a table written by split; the others' files are never opened."""
    return spark.read.parquet(path).where(F.col("split") == split)


def read_requests(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.schema(REQUEST_SCHEMA).json(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY_SCHEMA).parquet(path)


def read_suffix_rules(spark: SparkSession, path: str) -> DataFrame:
    """A public suffix list file as one rule per row."""
    lines = spark.read.text(path).select(F.trim(F.split("value", r"\s")[0]).alias("rule"))
    return lines.where((F.col("rule") != "") & ~F.col("rule").startswith("//")).distinct()


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 per file, read in parallel; each file must stay below 2 GB (`file_trees` has no such bound)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select(F.element_at(F.split("path", "/"), -1).alias("file"),
                    F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")))


def _block_digests(block: int):
    def run(batches):
        for batch in batches:
            found = []
            for path, place, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
                # Spark names files unescaped, and local ones with one slash, which are no URIs to Arrow.
                store, at = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", quote(path, safe="/:@")))
                digest, left = hashlib.sha256(), min(block, size - place * block)
                with store.open_input_file(at) as source:
                    source.seek(place * block)
                    while left > 0:
                        piece = source.read(min(left, 1 << 20))
                        if not piece:
                            raise OSError(f"{path} is shorter than it was")
                        digest.update(piece)
                        left -= len(piece)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())],
                                             ["path", "place", "bytes", "digest"])
    return run


def file_trees(spark: SparkSession, path: str, block: int = 64 << 20, fan: int = 16) -> DataFrame:
    """A fingerprint per file of any size: SHA-256 of its blocks, then of every `fan` digests in a row, as hex text, until
    one is left. Many tasks share a file; the root depends on `block` and `fan` only, and for a file of one block
    it is the file's own SHA-256. Empty files have no row, as Spark lists none. Files that change while they are read are an error or give another root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    last = F.greatest(F.lit(0), F.expr(f"(length - 1) div {block}")).cast("long")
    blocks = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("place"), F.col("length").alias("bytes"))
    count, most = ordered.cut(blocks).agg(F.count("*"), F.max("place")).first()
    tasks = max(1, min(count, 4 * spark.sparkContext.defaultParallelism))
    nodes = ordered.cut(blocks.repartition(tasks, "path", "place").mapInArrow(
        _block_digests(block), "path string, place long, bytes long, digest string"))
    left = (most or 0) + 1
    while left > 1:
        run = F.transform(F.array_sort(F.collect_list(F.struct("place", "digest"))), lambda n: n["digest"])
        # What is alone at its level and first is a root already.
        over = nodes.withColumn("alone", F.col("bytes") <= F.lit(block)).groupBy(
            "path", "bytes", F.expr(f"place div {fan}").alias("place"), "alone").agg(run.alias("run"))
        nodes = over.select("path", "place", "bytes", F.when(F.col("alone"), F.col("run")[0]).otherwise(
            F.sha2(F.array_join("run", ""), 256)).alias("digest"))
        left, block = -(-left // fan), block * fan
    return nodes.select(F.element_at(F.split("path", "/"), -1).alias("file"), "bytes", F.col("digest").alias("root"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-free fingerprint of a table of any size: row count and summed row hashes."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in df.columns]
    digest = F.sha2(F.concat_ws("\x1f", *cells), 256)
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"),
                  F.coalesce(F.sum(number), F.lit(0)).cast("string").alias("digest_sum"))
