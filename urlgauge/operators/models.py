"""Training, saving and batch scoring of the classifiers, as MLlib models."""

from __future__ import annotations

from dataclasses import dataclass, field
from time import perf_counter

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import constants as K
from ..plans import ordered
from ..sources import publish
from . import boosting, ensembles, metrics

WITHOUT_HTTPS = [n for n in K.FEATURES if n != "uses_https"]


@dataclass
class Settings:
    """Sizes and rates of the learners; the defaults follow the published protocol."""

    logistic_iterations: int = 2000
    forest_trees: int = 200
    forest_depth: int = 20
    forest_leaf: int = 2
    boosted_rounds: int = 1500
    boosted_rate: float = 0.05
    boosted_leaves: int = 31
    boosted_leaf: int = 50
    boosted_patience: int = 100
    boosted_share: float = 0.9
    additive_rounds: int = 1000
    additive_rate: float = 0.03
    additive_leaf: int = 20
    additive_bins: int = 128
    additive_pairs: int = 10
    additive_pair_bins: int = 16
    seed: int = K.DEFAULT_SEED


@dataclass
class Fitted:
    """A model by name with its inputs; `majority` holds the prior instead of a pipeline."""

    name: str
    features: list[str]
    pipeline: PipelineModel | None = None
    prior: float | None = None
    fit_seconds: float = 0.0
    extra: dict = field(default_factory=dict)


def weighted(train: DataFrame, weights: dict[int, float] | None = None) -> DataFrame:
    weights = weights or metrics.class_weights(train)
    return train.withColumn("weight", F.when(F.col("label") == 1, weights[1]).otherwise(weights[0]))


def _assembler(names: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=names, outputCol="inputs")


def fit_majority(train: DataFrame) -> Fitted:
    begun = perf_counter()
    prior = metrics.majority_probability(train).first()[0]
    return Fitted("majority_baseline", K.FEATURES, prior=prior, fit_seconds=perf_counter() - begun)


def _vectors(train: DataFrame, names: list[str]) -> DataFrame:
    """Label, weight and the inputs as written vectors: learners pass over them several times, and an assembler makes each
    row's vector anew in a slow function. Missing values are an error, as they are to it."""
    missing = F.lit(False)
    for name in names:
        missing = missing | F.col(name).isNull() | F.isnan(F.col(name).cast("double"))
    values = F.when(missing, F.raise_error(F.lit("A feature is missing"))).otherwise(
        F.array(*[F.col(n).cast("double") for n in names]))
    # A dense vector as MLlib stores it.
    vector = F.struct(F.lit(1).cast("byte").alias("type"), F.lit(None).cast("int").alias("size"),
                      F.lit(None).cast("array<int>").alias("indices"), values.alias("values"))
    kept = train.select("label", "weight", vector.alias("inputs"))
    return ordered.cut(kept, "snappy", T.StructType([*kept.schema.fields[:2], T.StructField("inputs", VectorUDT())]))


def _fit(name, names, stages, train) -> Fitted:
    ordered.working_folder(train.sparkSession)
    begun = perf_counter()
    with ordered.passing(train.sparkSession):
        data, fits = _vectors(train, names), [_assembler(names)]
        for stage in stages:
            fits.append(stage.fit(data))
            data = fits[-1].transform(data)
    return Fitted(name, list(names), PipelineModel(fits), fit_seconds=perf_counter() - begun)


def fit_logistic(train: DataFrame, settings: Settings) -> Fitted:
    """L2 with C = 1: balanced weights add up to n, so the penalty is 1 / n."""
    rows = train.count()
    return _fit("logistic_regression", K.FEATURES, [
        StandardScaler(inputCol="inputs", outputCol="scaled", withMean=True, withStd=True),
        LogisticRegression(featuresCol="scaled", labelCol="label", weightCol="weight",
                           regParam=1.0 / rows, elasticNetParam=0.0, standardization=False,
                           maxIter=settings.logistic_iterations)], train)


def fit_forest(train: DataFrame, settings: Settings) -> Fitted:
    return _fit("random_forest", K.FEATURES, [RandomForestClassifier(
        featuresCol="inputs", labelCol="label", weightCol="weight", numTrees=settings.forest_trees,
        maxDepth=settings.forest_depth, minInstancesPerNode=settings.forest_leaf,
        featureSubsetStrategy="sqrt", subsamplingRate=1.0, seed=settings.seed)], train)


def _loaded(names: list[str], model) -> PipelineModel:
    return PipelineModel([_assembler(names), model])


def fit_boosted(train: DataFrame, validation: DataFrame, settings: Settings,
                names: list[str] = K.FEATURES, name: str = "boosted_trees") -> Fitted:
    """Boosted trees, cut back to the round with the least validation log loss; `extra` has the losses and that round."""
    begun = perf_counter()
    fit = boosting.fit_trees(train, validation, list(names), boosting.TreeSettings(
        rounds=settings.boosted_rounds, rate=settings.boosted_rate, leaves=settings.boosted_leaves,
        least=settings.boosted_leaf, row_share=settings.boosted_share, column_share=settings.boosted_share,
        patience=settings.boosted_patience, seed=settings.seed))
    seconds = perf_counter() - begun
    return Fitted(name, list(names), _loaded(names, ensembles.boosted(train.sparkSession, fit, list(names))), fit_seconds=seconds,
                  extra={"losses": fit.losses, "best_round": fit.best_round})


def fit_additive(train: DataFrame, settings: Settings) -> Fitted:
    """One step function per feature and one per chosen pair; `extra` has them for `explain.build`."""
    begun = perf_counter()
    cuts, fit = boosting.fit_additive(
        train, K.FEATURES, settings.additive_rounds, settings.additive_rate, settings.additive_leaf, settings.additive_bins,
        settings.additive_pairs, settings.additive_pair_bins)
    seconds = perf_counter() - begun
    model = ensembles.additive(train.sparkSession, fit, [cuts[n] for n in K.FEATURES])
    return Fitted("additive", K.FEATURES, _loaded(K.FEATURES, model), fit_seconds=seconds, extra={"cuts": cuts, "fit": fit})


def score(model: Fitted, df: DataFrame, keep: list[str]) -> DataFrame:
    """Long rows: `keep`, model, probability, prediction."""
    if model.pipeline is None:
        scored = df.withColumn("probability_1", F.lit(model.prior))
    else:
        scored = model.pipeline.transform(df).withColumn(
            "probability_1", vector_to_array("probability")[1])
    return scored.select(*keep, F.lit(model.name).alias("model"),
                         F.col("probability_1").alias("probability"),
                         (F.col("probability_1") >= K.THRESHOLD).cast("int").alias("prediction"))


def with_chances(models: list[Fitted], df: DataFrame) -> DataFrame:
    """Add __p0, __p1, ..., the probabilities of all models, from one pass over `df`. Models with the same inputs share their vector."""
    scored, chances, inputs = df, [], {}
    for i, model in enumerate(models):
        if model.pipeline is None:
            scored = scored.withColumn(f"__p{i}", F.lit(model.prior))
        else:
            first, *rest = model.pipeline.stages
            names = tuple(first.getInputCols())
            if names not in inputs:
                inputs[names] = f"__inputs{len(inputs)}"
                scored = first.transform(scored).withColumnRenamed(first.getOutputCol(), inputs[names])
            scored = PipelineModel(rest).transform(scored.withColumn(first.getOutputCol(), F.col(inputs[names]))).withColumn(
                f"__p{i}", vector_to_array("probability")[1])
        chances.append(f"__p{i}")
        scored = scored.select(*df.columns, *inputs.values(), *chances)
    return scored.drop(*inputs.values())


def score_all(models: list[Fitted], df: DataFrame, keep: list[str]) -> DataFrame:
    """All models' long rows together, from one pass over `df`."""
    return with_chances(models, df).select(*keep, F.inline(F.array(*[F.struct(
        F.lit(model.name).alias("model"), F.col(f"__p{i}").alias("probability"),
        (F.col(f"__p{i}") >= K.THRESHOLD).cast("int").alias("prediction")) for i, model in enumerate(models)])))


def wide(scored: DataFrame, keep: list[str], names: list[str]) -> DataFrame:
    """One row per example with a probability and a prediction column per model."""
    table = scored.groupBy(*keep).pivot("model", names).agg(
        F.first("probability").alias("probability"), F.first("prediction").alias("prediction"))
    return table


def bad_probabilities(scored: DataFrame) -> DataFrame:
    p = F.col("probability")
    return scored.where(p.isNull() | F.isnan(p) | (p < 0) | (p > 1))


def importances(model: Fitted) -> list[tuple[str, float]]:
    """Coefficients by size, or importances, best first."""
    last = model.pipeline.stages[-1]
    if hasattr(last, "coefficients"):
        values = last.coefficients.toArray()
    else:
        values = last.featureImportances.toArray()
    pairs = [(n, float(v)) for n, v in zip(model.features, values)]
    return sorted(pairs, key=lambda p: -abs(p[1]))


def importance_table(spark: SparkSession, model: Fitted) -> DataFrame:
    rows = [(model.name, i + 1, n, v) for i, (n, v) in enumerate(importances(model))]
    return spark.createDataFrame(rows, "model string, rank int, feature string, importance double")


def save(spark: SparkSession, model: Fitted, path: str, manifest: dict) -> None:
    """Store the pipeline beside a manifest that names its inputs in order."""
    values = {**manifest, "model": model.name, "features": model.features, "prior": model.prior,
              "fit_seconds": model.fit_seconds}
    if model.pipeline is not None:
        model.pipeline.write().overwrite().save(f"{path}/pipeline")
        values["signature"] = publish.folder_signature(spark, f"{path}/pipeline")
    publish.write_manifest(spark, f"{path}/manifest", values)


def load(spark: SparkSession, path: str, expected: list[str] | None = None) -> Fitted:
    """Load a model and reject changed files, other columns or other classes."""
    info = publish.read_manifest(spark, f"{path}/manifest")
    if expected is not None and info["features"] != list(expected):
        raise ValueError("The saved feature order does not match.")
    pipeline = None
    if info.get("signature"):
        if publish.folder_signature(spark, f"{path}/pipeline") != info["signature"]:
            raise ValueError(f"Model changed after it was saved: {path}")
        pipeline = PipelineModel.load(f"{path}/pipeline")
        if pipeline.stages[0].getInputCols() != info["features"]:
            raise ValueError("The saved feature order does not match the pipeline.")
        if pipeline.stages[-1].numClasses != 2:
            raise ValueError("Expected binary classes 0 and 1")
    return Fitted(info["model"], info["features"], pipeline, info["prior"], info["fit_seconds"])
