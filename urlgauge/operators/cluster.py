"""Clustering of one class: scaling, k choice, profiles, central examples, silhouette."""

from __future__ import annotations

from math import ceil
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import constants as K
from ..plans import ordered, workers
from . import sampling

SILHOUETTE_BLOCK = 10_000
ORDER = K.COUNT_FEATURES + K.OTHER_FEATURES + K.FLAG_FEATURES


def select_class(train: DataFrame, minimum: int = 20) -> DataFrame:
    """Rows of class 1; raise when there are too few or a count is negative."""
    chosen = train.where(F.col("label") == 1)
    low = F.least(*[F.min(c) for c in K.COUNT_FEATURES])
    row = chosen.agg(F.count("*").alias("n"), low.alias("low")).first()
    if row["n"] < minimum or row["low"] < 0:
        raise ValueError(f"Need at least {minimum} class 1 rows with nonnegative counts")
    return chosen


def _raw(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.log1p(value) if name in K.COUNT_FEATURES else value


def scaling(df: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and population deviation (0 becomes 1) of every scaled column, in one pass."""
    scaled = K.COUNT_FEATURES + K.OTHER_FEATURES
    row = df.agg(*[F.avg(_raw(n)).alias("m_" + n) for n in scaled],
                 *[F.stddev_pop(_raw(n)).alias("s_" + n) for n in scaled]).first()
    return {n: (row["m_" + n], row["s_" + n] or 1.0) for n in scaled}


def preprocess(df: DataFrame, scale: dict[str, tuple[float, float]]) -> DataFrame:
    """Add one z_ column per feature: log counts and others standardised, flags as they are."""
    made = {}
    for name in ORDER:
        mean, spread = scale.get(name, (0.0, 1.0))
        made["z_" + name] = (_raw(name) - mean) / spread if name in scale else _raw(name)
    return df.withColumns(made)


def assemble(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=["z_" + n for n in ORDER], outputCol="values").transform(df)


def starting_centres(sample: np.ndarray, k: int, seed: int, tries: int = 10) -> np.ndarray:
    """k centres of a bounded sample: the best of some k-means++ draws, each moved a few times over the sample."""
    best = (np.inf, sample[:k])
    for attempt in range(tries):
        rng = np.random.default_rng((seed, k, attempt))
        centres = sample[rng.integers(len(sample))][None]
        while len(centres) < min(k, len(sample)):
            far = _distances(sample, centres).min(1) ** 2
            chance = far / far.sum() if far.sum() > 0 else np.full(len(sample), 1 / len(sample))
            centres = np.vstack([centres, sample[rng.choice(len(sample), p=chance)]])
        for _ in range(20):
            own = _distances(sample, centres).argmin(1)
            centres = np.stack([sample[own == c].mean(0) if (own == c).any() else centres[c] for c in range(len(centres))])
        cost = float((_distances(sample, centres).min(1) ** 2).sum())
        if cost < best[0]:
            best = cost, centres
    return best[1]


def moved(points: DataFrame, centres: dict[int, np.ndarray], values: str = "point"):
    """One scan for all k: the centres' means, and per k each cluster's rows and squared distances.

    Tasks sum their own rows, Spark sums the tasks; a cluster without rows keeps its centre."""
    workers.ship(points.sparkSession)

    def sums(batches):
        totals = {k: np.zeros((len(c), c.shape[1] + 2)) for k, c in centres.items()}
        for batch in batches:
            rows = np.array(batch[values].tolist(), float).reshape(len(batch), -1)
            for at in range(0, len(rows), 4096):
                part = rows[at:at + 4096]
                for k, c in centres.items():
                    far = _distances(part, c)
                    own = far.argmin(1)
                    table = np.column_stack([part, np.ones(len(part)), far[np.arange(len(part)), own] ** 2])
                    totals[k] += np.eye(len(c))[own].T @ table
        for k, table in totals.items():
            yield pd.DataFrame({"k": k, "cluster": np.repeat(np.arange(len(table)), table.shape[1]),
                                "place": np.tile(np.arange(table.shape[1]), len(table)), "total": table.ravel()})

    found = {k: np.zeros((len(c), c.shape[1] + 2)) for k, c in centres.items()}
    for r in points.select(values).mapInPandas(sums, "k int, cluster int, place int, total double").groupBy(
            "k", "cluster", "place").agg(F.sum("total").alias("total")).collect():
        found[r["k"]][r["cluster"], r["place"]] = r["total"]
    means = {k: np.where(t[:, -2:-1] > 0, t[:, :-2] / np.maximum(t[:, -2:-1], 1), centres[k]) for k, t in found.items()}
    return means, {k: (t[:, -2], t[:, -1]) for k, t in found.items()}


def lloyd(points: DataFrame, centres: dict[int, np.ndarray], iterations: int = 100, tolerance: float = 1e-4, values: str = "point"):
    """Move the centres of all k, a scan per iteration, until none moves further than `tolerance`.

    Returns the centres and, per k, rows and squared distances by cluster at these centres."""
    for _ in range(iterations):
        means, _ = moved(points, centres, values)
        far = max(float(np.sqrt(((means[k] - centres[k]) ** 2).sum(1)).max()) for k in centres)
        centres = means
        if far <= tolerance:
            break
    return centres, moved(points, centres, values)[1]


def as_model(spark: SparkSession, centres: np.ndarray) -> KMeansModel:
    """The centres as an MLlib model that assigns `cluster` to `values`."""
    jvm = spark.sparkContext._jvm
    vectors = spark.sparkContext._gateway.new_array(jvm.org.apache.spark.mllib.linalg.Vector, len(centres))
    for i, c in enumerate(centres):
        numbers = spark.sparkContext._gateway.new_array(jvm.double, len(c))
        for j, x in enumerate(c):
            numbers[j] = float(x)
        vectors[i] = jvm.org.apache.spark.mllib.linalg.Vectors.dense(numbers)
    parent = jvm.org.apache.spark.mllib.clustering.KMeansModel(vectors)
    model = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(f"KMeans_{uuid4().hex[:12]}", parent))
    return model.setFeaturesCol("values").setPredictionCol("cluster")


def with_distance(df: DataFrame, centers: list) -> DataFrame:
    """Euclidean distance to the assigned centre; the centres are k short literal arrays."""
    values = vector_to_array("values")
    table = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])
    own = F.element_at(table, F.col("cluster") + 1)
    squares = F.zip_with(values, own, lambda a, b: (a - b) * (a - b))
    return df.withColumn("distance_to_centroid",
                         F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)))


def sizes(df: DataFrame) -> DataFrame:
    """Per cluster: rows and label counts."""
    return df.groupBy("cluster").agg(
        F.count("*").alias("rows"), F.count_if(F.col("label") == 0).alias("label_0_rows"),
        F.count_if(F.col("label") == 1).alias("label_1_rows"))


def cluster_summary(df: DataFrame) -> DataFrame:
    total = df.count()
    return sizes(df).select(
        "cluster", "rows", (100 * F.col("rows") / total).alias("share_percent"),
        "label_0_rows", "label_1_rows", (F.col("label_1_rows") / F.col("rows")).alias("label_1_share"))


def profile(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Per (cluster, feature): mean against the whole class, ranked by absolute difference.

    One aggregation holds counts, sums and squares per cluster; everything after it
    works on one row per cluster.
    """
    names = names or K.FEATURES
    moments = df.groupBy("cluster").agg(*[
        F.struct(F.lit(i).alias("feature_index"), F.lit(n).alias("feature"),
                 F.count("*").alias("n"), F.avg(F.col(n).cast("double")).alias("mean"),
                 F.var_pop(F.col(n).cast("double")).alias("var"),
                 F.min(F.col(n).cast("double")).alias("low"),
                 F.max(F.col(n).cast("double")).alias("high")).alias(f"_{i}")
        for i, n in enumerate(names)])
    tall = moments.select("cluster", F.inline_outer(F.array(*[F.col(f"_{i}") for i in range(len(names))])))
    n, mean, var = F.col("n"), F.col("mean"), F.col("var")
    overall = tall.groupBy("feature").agg((F.sum(n * mean) / F.sum(n)).alias("overall_class_mean"))
    # Within plus between variance keeps the deviation accurate for large means.
    joined = tall.join(overall, "feature").withColumn(
        "_between", n * F.pow(mean - F.col("overall_class_mean"), 2))
    spread = joined.groupBy("feature").agg(
        F.sqrt(F.sum(n * var + F.col("_between")) / F.sum(n)).alias("_spread"),
        (F.min("low") == F.max("high")).alias("_constant"))
    joined = joined.join(spread, "feature")
    delta = F.when(F.col("_constant"), 0.0).otherwise(
        (mean - F.col("overall_class_mean")) / F.col("_spread"))
    rows = joined.select(
        "cluster", "feature", "feature_index", mean.alias("cluster_mean"), "overall_class_mean",
        delta.alias("standardized_difference"),
        F.when(delta > 0, "higher").when(delta < 0, "lower").otherwise("same").alias("direction"))
    ranked = F.sort_array(F.collect_list(F.struct(
        (-F.abs("standardized_difference")).alias("o"), "feature_index", "feature", "cluster_mean",
        "overall_class_mean", "standardized_difference", "direction")))
    # A cluster has one entry per feature, so the list is as short as the feature list.
    lists = rows.groupBy("cluster").agg(ranked.alias("_l"))
    return lists.select("cluster", F.posexplode_outer("_l").alias("_p", "r")).select(
        "cluster", "r.feature", (F.col("_p") + 1).alias("rank"), "r.cluster_mean",
        "r.overall_class_mean", "r.standardized_difference", "r.direction")


def top_features(details: DataFrame, count: int = 3) -> DataFrame:
    return details.where(F.col("rank") <= count)


def difference_table(details: DataFrame, clusters: list[int]) -> DataFrame:
    """Features down, clusters across."""
    return details.groupBy("feature").pivot("cluster", clusters).agg(
        F.first("standardized_difference"))


def representatives(df: DataFrame, row: str, count: int = 3) -> DataFrame:
    """Per cluster up to `count` most central rows from distinct domain groups."""
    order = ["distance_to_centroid", row]
    one = sampling.first_per_group(df, ["cluster", "domain_group"], order, 1)
    best = sampling.first_per_group(one, ["cluster"], order, count)
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(*order))
    return best.withColumn("example_rank", rank)


def _distances(points, rows):
    """Euclidean distances, points down. Where the product form would cancel, they are taken from differences."""
    import numpy as np

    squares = (points ** 2).sum(1)[:, None] + (rows ** 2).sum(1)
    out = squares - 2 * (points @ rows.T)
    close = np.nonzero(~(out > 1e-4 * squares))
    for at in range(0, len(close[0]), 1 << 16):
        i, j = close[0][at:at + (1 << 16)], close[1][at:at + (1 << 16)]
        out[i, j] = ((points[i] - rows[j]) ** 2).sum(1)
    return np.sqrt(out, out=out)


def silhouette_rows(df: DataFrame, values: str = "values", cluster: str = "cluster",
                    block: int | None = None) -> DataFrame:
    """Silhouette of every row against all rows (Euclidean).

    The rows are asked about in blocks of about `block`, one at a time: a block is shared with all tasks, each
    task sums its own rows' distances to it per cluster, and the sums are added up. So no pair is
    materialised, and the driver holds one block. The work grows with the square of the rows.
    Rows of a cluster of one have 0; without a second cluster there is none."""
    spark = df.sparkSession
    held = ordered.cut(df.repartition(spark.sparkContext.defaultParallelism).withColumn(
        "_row", F.monotonically_increasing_id()))
    blocks = max(1, ceil(held.count() / (block or SILHOUETTE_BLOCK)))
    kind = held.schema[cluster].dataType.simpleString()

    def sums_to(ids, points):
        import numpy as np
        import pandas as pd

        shared = spark.sparkContext.broadcast((ids, points))

        def run(batches):
            ids, points = shared.value
            totals = {}
            for batch in batches:
                for name, part in batch.groupby(cluster, dropna=False):
                    rows = np.array(part[values].tolist(), dtype="float64").reshape(len(part), -1)
                    total = totals.setdefault(None if pd.isna(name) else name, np.zeros(len(ids)))
                    for at in range(0, len(rows), 256):
                        total += _distances(points, rows[at:at + 256]).sum(1)
            for name, total in totals.items():
                yield pd.DataFrame({"_row": ids, "_other": pd.Series([name] * len(ids), dtype=object), "_total": total})

        found = ordered.cut(held.select(values, cluster).mapInPandas(
            run, f"_row bigint, _other {kind}, _total double").groupBy("_row", "_other").agg(
            F.sum("_total").alias("_total")))
        shared.destroy()
        return found

    sums = None
    for number in range(blocks):
        asked = held.where(F.pmod(F.xxhash64("_row"), F.lit(blocks)) == number).select("_row", values).toPandas()
        if len(asked):
            import numpy as np

            points = np.array(asked[values].tolist(), dtype="float64").reshape(len(asked), -1)
            part = sums_to(asked["_row"].to_numpy(), points)
            sums = part if sums is None else sums.unionByName(part)
    if sums is None:
        return df.drop(values).withColumn("silhouette", F.lit(None).cast("double"))
    counts = held.groupBy(F.col(cluster).alias("_other")).agg(F.count("*").alias("_n"))
    own = F.col(cluster) == F.col("_other")
    # As in SQL, rows without a cluster are neither of a row's own cluster nor of another.
    parts = held.select("_row", cluster).join(sums, "_row").join(counts, "_other")
    widths = parts.groupBy("_row").agg(
        F.max(F.when(own & (F.col("_n") > 1), F.col("_total") / (F.col("_n") - 1))).alias("_a"),
        F.min(F.when(~own, F.col("_total") / F.col("_n"))).alias("_b"))
    top = F.greatest("_a", "_b")
    width = F.when(F.col("_a").isNull() | (top == 0), 0.0).otherwise((F.col("_b") - F.col("_a")) / top)
    return held.drop(values).join(widths, "_row", "left").withColumn("silhouette", width).drop("_row", "_a", "_b")


def mean_silhouette(sample: DataFrame, values: str = "values", cluster: str = "cluster") -> DataFrame:
    return silhouette_rows(sample, values, cluster).agg(F.avg("silhouette").alias("silhouette"))


def compare_k(df: DataFrame, row: str, ks=range(2, 7), sample_size: int = 2000,
              seed: int = K.DEFAULT_SEED):
    """Fit all k on all rows, in scans that they share, and score each on one fixed sample.

    The sample also gives the starting centres; its size is the bound of what comes to the driver. Returns the k table
    and the fitted models. `df` holds `values` and should be read from a written table, since every iteration scans it.
    """
    spark, records, models = df.sparkSession, [], {}
    sample = ordered.cut(sampling.fixed_sample(df.select(row, "values"), row, sample_size, seed))
    held = sample.withColumn("point", vector_to_array("values"))
    points = np.array([r["point"] for r in held.select("point").collect()], float)
    centres, found = lloyd(df.select(vector_to_array("values").alias("point")),
                           {k: starting_centres(points, k, seed) for k in ks})
    for k in ks:
        model = models[k] = as_model(spark, centres[k])
        counts = [int(n) for n in found[k][0] if n]
        chosen = model.transform(held).select(row, "cluster", "point")
        present = chosen.agg(F.count_distinct("cluster").alias("c"), F.count("*").alias("n")).first()
        usable = len(counts) == k and 1 < present["c"] < present["n"]
        score = mean_silhouette(chosen, "point").first()[0] if usable else None
        records.append((k, score, float(found[k][1].sum()), min(counts),
                        max(counts) / sum(counts)))
    table = spark.createDataFrame(
        records, "k int, silhouette_estimate double, inertia double, smallest_cluster_rows long, "
                 "largest_cluster_share double")
    return table, models


def choose_k(table: DataFrame) -> DataFrame:
    """Highest finite silhouette; the first k on ties."""
    usable = table.where(F.col("silhouette_estimate").isNotNull() & ~F.isnan("silhouette_estimate"))
    return usable.orderBy(F.col("silhouette_estimate").desc(), "k").limit(1)
