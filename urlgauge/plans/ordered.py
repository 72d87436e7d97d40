"""Row numbers and running totals without a single-task window.

Rows are range-partitioned on the whole order key (a hot leading value simply
spans partitions), written to the reliable checkpoint folder so that the
partitions stay what they are if executors are lost, and then numbered from
per-partition totals.
"""

from __future__ import annotations

import atexit
import tempfile
import threading
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

_POSITION = (1 << 33) - 1


def _remove(spark: SparkSession, path: str) -> None:
    try:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001 - the session may have ended; then the folder's owner cleans up
        pass


_folders: dict[str, str] = {}


def working_folder(spark: SparkSession) -> str:
    """A folder of this application in `spark.checkpoint.dir`, which all executors reach; removed at exit.

    Only a local session without that setting uses a temporary folder."""
    sc = spark.sparkContext
    if sc.applicationId not in _folders:
        base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        if not base:
            if not sc.master.startswith("local["):
                raise RuntimeError("Set spark.checkpoint.dir to a folder all executors can reach.")
            base = tempfile.mkdtemp(prefix="urlgauge-")
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(base)
        _folders[sc.applicationId] = f"{base}/work-{sc.applicationId}-{uuid4().hex[:8]}"
        atexit.register(_remove, spark, _folders[sc.applicationId])
    return _folders[sc.applicationId]


_passing = threading.local()


@contextmanager
def passing(spark: SparkSession):
    """Remove what `cut` writes inside, in this thread, at the end. Results must be written by then."""
    before = getattr(_passing, "paths", None)
    _passing.paths = []
    try:
        yield
    finally:
        for path in _passing.paths:
            _remove(spark, path)
        _passing.paths = before


def cut(df: DataFrame, compression: str = "zstd", schema: StructType | None = None) -> DataFrame:
    """Write `df` to the working folder and read it back, with another `schema` if one is given: columns can be pruned,
    sizes are known.

    Digests in hex take half of their digits in zstd. Scans are split by bytes on disk, so tables that grow much in
    memory are better packed less."""
    path = f"{working_folder(df.sparkSession)}/{uuid4().hex}"
    if getattr(_passing, "paths", None) is not None:
        _passing.paths.append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the files of a table made by `cut` that nothing will read again."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        _remove(df.sparkSession, path)


def _laid_out(df: DataFrame, order: list[Column]) -> DataFrame:
    # Range partitioning samples its input first, so the input is written instead of computed twice.
    laid = cut(df).repartitionByRange(*order).sortWithinPartitions(*order)
    laid = laid.withColumn("_slot", F.monotonically_increasing_id())
    return cut(laid).withColumns({
        "_block": F.shiftright("_slot", 33), "_at": F.col("_slot").bitwiseAND(_POSITION)})


def _before(totals: DataFrame, names: list[str], by: list[str]) -> DataFrame:
    """Totals of all earlier blocks. There is one row per partition and group."""
    window = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*by, "_block", *[
        F.coalesce(F.sum(n).over(window), F.lit(0)).alias("_before_" + n) for n in names])


def number_rows(df: DataFrame, order_by: list, name: str = "row_number",
                within: list[str] | None = None) -> DataFrame:
    """Add 1, 2, 3, ... in the order of a unique key, restarting per `within` group.

    Groups are made contiguous by ordering on them first; each group's start is
    then taken off, so a group of any size is numbered by many tasks.
    """
    within = within or []
    order = [F.col(c) for c in within] + [F.col(c) if isinstance(c, str) else c for c in order_by]
    laid = _laid_out(df, order)
    runs = cut(laid.groupBy(*within, "_block").agg(
        F.count("*").alias("n"), F.min("_at").alias("_first")))
    before = cut(_before(runs.groupBy("_block").agg(F.sum("n").alias("n")), ["n"], []))
    numbered = laid.join(before, "_block")
    value = F.col("_before_n") + F.col("_at") + 1
    if within:
        starts = cut(runs.join(before, "_block").groupBy(*within).agg(
            F.min(F.col("_before_n") + F.col("_first")).alias("_start")))
        numbered = numbered.join(starts, within)
        value = value - F.col("_start")
    return numbered.select(*df.columns, value.cast("long").alias(name))


def number_ordinals(df: DataFrame, ordinal: str, name: str = "row_number",
                    within: list[str] | None = None, bucket: int = 1 << 20) -> DataFrame:
    """Dense numbers in the order of a unique integer, without a checkpoint.

    The ordinal's high part is a bucket of at most `bucket` rows, whatever the
    data; buckets are ranked on their own and shifted by the counts before them.
    """
    within = within or []
    work = df.withColumn("_block", F.floor(F.col(ordinal) / bucket).cast("long"))
    totals = work.groupBy(*within, "_block").agg(F.count("*").alias("n"))
    local = F.row_number().over(Window.partitionBy(*within, "_block").orderBy(ordinal))
    ranked = work.withColumn("_local", local)
    before = cut(_before(totals, ["n"], within))
    shifted = ranked.join(before, [*within, "_block"])
    return shifted.select(*df.columns, (F.col("_before_n") + F.col("_local")).cast("long").alias(name))


def running_totals(df: DataFrame, order_by: list[Column], sums: dict[str, str],
                   by: list[str] | None = None) -> DataFrame:
    """Add inclusive running sums in order within each `by` group.

    `sums` maps new names to summed columns. Every partition sums its own run and
    adds the totals of the partitions before it.
    """
    by = by or []
    laid = _laid_out(df, [F.col(c) for c in by] + order_by)
    sources = sorted(set(sums.values()))
    totals = laid.groupBy(*by, "_block").agg(*[F.sum(c).alias(c) for c in sources])
    run = (Window.partitionBy(*by, "_block").orderBy("_slot")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = laid.withColumns({"_run_" + c: F.sum(c).over(run) for c in sources})
    before = cut(_before(totals, sources, by))
    joined = own.join(before, [*by, "_block"])
    return joined.select(*df.columns, *[
        (F.col("_run_" + c) + F.col("_before_" + c)).alias(n) for n, c in sums.items()])
