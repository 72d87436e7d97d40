"""Publish-once folders, manifests and tamper checks through the Hadoop file system."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import file_fingerprints, table_fingerprint


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


class Publication:
    """Collects tables under a staging folder and renames it when complete.

    An existing destination is an error: results are written once. Before anything is staged, a claim file is
    created, which fails if there is one: of two writers only one goes on. The same owner (the application, if not given)
    may claim again after a failure; `abandon` removes a claim that is left behind.
    """

    def __init__(self, spark: SparkSession, destination: str, owner: str | None = None):
        self.spark, self.destination = spark, destination.rstrip("/")
        if exists(spark, self.destination):
            raise FileExistsError(f"Results already exist: {self.destination}. Choose a new folder.")
        parent, _, leaf = self.destination.rpartition("/")
        self.staging, self.claim = f"{parent}/_staging_{leaf}", f"{parent}/_claim_{leaf}"
        self.owner = owner or spark.sparkContext.applicationId
        self._take()

    def _take(self) -> None:
        fs, claim = _fs(self.spark, self.claim)
        try:
            stream = fs.create(claim, False)
        except Exception as taken:
            if not fs.exists(claim):
                raise
            stream = fs.open(claim)
            try:
                holder = stream.readUTF()
            finally:
                stream.close()
            if holder != self.owner:
                raise FileExistsError(f"{self.destination} is being written by {holder}.") from taken
            return
        try:
            stream.writeUTF(self.owner)
        finally:
            stream.close()

    def abandon(self) -> None:
        """Remove what was staged, and the claim."""
        for path in (self.staging, self.claim):
            fs, target = _fs(self.spark, path)
            fs.delete(target, True)

    def path(self, name: str) -> str:
        return f"{self.staging}/{name}"

    def table(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Write one table and return it read back, free of its lineage."""
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))

    def csv(self, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").csv(
            self.path(name), header=True, encoding="UTF-8", lineSep="\n", escape='"')

    def manifest(self, values: dict, name: str = "summary") -> None:
        write_manifest(self.spark, self.path(name), values)

    def publish(self) -> str:
        fs, source = _fs(self.spark, self.staging)
        _, target = _fs(self.spark, self.destination)
        if not fs.rename(source, target):
            raise IOError(f"Could not publish {self.destination}")
        fs.delete(_fs(self.spark, self.claim)[1], False)
        return self.destination


def write_manifest(spark: SparkSession, path: str, values: dict) -> None:
    text = json.dumps({"spark_version": spark.version, **values}, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def fingerprint(df: DataFrame) -> dict:
    row = table_fingerprint(df).first()
    return {"rows": row["rows"], "digest_sum": row["digest_sum"]}


def check_fingerprint(df: DataFrame, recorded: dict, what: str) -> DataFrame:
    if fingerprint(df) != recorded:
        raise ValueError(f"{what} changed after it was written. Restore the original.")
    return df


def folder_signature(spark: SparkSession, path: str) -> str:
    """One digest for all files of a small folder such as a saved model."""
    files = file_fingerprints(spark, path).where(~F.col("file").startswith("."))
    total = F.sum(F.conv(F.substring("sha256", 1, 15), 16, 10).cast("decimal(38,0)"))
    row = files.agg(F.count("*").alias("n"), total.cast("string").alias("t")).first()
    return f"{row['n']}:{row['t']}"


def same_provenance(manifest: dict, split: dict, features: list[str]) -> None:
    """A training manifest must name the same inputs, columns and threshold."""
    wrong = [k for k in ("dataset", "inputs") if manifest.get(k) != split.get(k)]
    if manifest.get("features") != features:
        wrong.append("features")
    if manifest.get("threshold") != 0.5 or manifest.get("test_evaluated"):
        wrong.append("protocol")
    if wrong:
        raise ValueError(f"Training provenance does not match: {', '.join(wrong)}")
