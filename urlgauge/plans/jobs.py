"""The pipeline jobs: prepare, split, train, ablate, cluster and evaluate.

Every job writes its tables under a staging folder of its destination, reads them
back instead of recomputing them, and renames the folder when all is written.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as K
from ..operators import cluster, explain, metrics, models, prepare, sampling, split
from ..sources import publish, tables
from ..sources.registry import SOURCES

BASELINES = ["majority_baseline", "logistic_regression", "random_forest"]
LEARNED = ["additive", "boosted_trees"]
ABLATED = "boosted_trees_without_https"


def prepare_dataset(spark: SparkSession, raw: DataFrame, dataset: str, destination: str) -> dict:
    """Clean one source. `raw` has url, original_label and a unique source_row."""
    source = SOURCES[dataset]
    unknown = [r[0] for r in prepare.unknown_labels(raw, source).limit(20).collect()]
    if unknown:
        raise ValueError(f"Unexpected labels in {dataset}: {sorted(unknown)}")
    out = publish.Publication(spark, destination)
    route = out.table("audit/routes", prepare.routed(raw, source), ["route"])
    scored = out.table("audit/featured", prepare.featured(route), ["route"])
    parts = prepare.split_routes(route, scored, dataset)
    table = out.table("features", parts.table)
    metadata = out.table("audit/metadata", parts.metadata)
    excluded = out.table("audit/excluded", parts.excluded)
    duplicates = out.table("audit/duplicates", parts.duplicates)

    counts = prepare.summary(route).first().asDict()
    made = {n: d.count() for n, d in (("output", table), ("excluded", excluded),
                                      ("duplicates", duplicates), ("metadata", metadata))}
    if counts["input_rows"] != made["output"] + made["excluded"] + made["duplicates"]:
        raise AssertionError("Cleaning counts do not reconcile")
    if made["output"] == 0:
        raise ValueError(f"No usable URL records remain in {dataset}")
    if metadata.select("url_key").distinct().count() != made["output"]:
        raise AssertionError("Feature output contains duplicate keys")
    reasons = {r["value"]: r["rows"] for r in prepare.value_counts(excluded, "reason").collect()}
    categories = {r["value"]: r["rows"] for r in prepare.value_counts(route, "original_category").collect()
                  if r["value"] is not None}
    result = {
        **counts, "output_rows": made["output"], "dataset": dataset, "feature_columns": K.FEATURES,
        "exclusions_by_reason": reasons, "original_category_counts": categories,
        "label_mapping": source.labels, "sources_combined": False,
        "feature_extraction_failures": sum(v for k, v in reasons.items() if k.startswith("feature_extraction")),
        "fingerprint": publish.fingerprint(table)}
    out.manifest(result)
    out.publish()
    return result


def split_dataset(spark: SparkSession, prepared: str, destination: str,
                  seed: int = K.DEFAULT_SEED, rules=None) -> dict:
    """Assign every row to a split by the hash of its domain group; never twice."""
    info = publish.read_manifest(spark, f"{prepared}/summary")
    table = publish.check_fingerprint(
        spark.read.parquet(f"{prepared}/features"), info["fingerprint"], "The feature table")
    tables.check_contract(table.drop("row_number"))
    out = publish.Publication(spark, destination)
    assigned = out.table("audit/assigned", split.assign(table, "url", seed, rules))
    statistics = split.check(assigned)
    rows = out.table("rows", split.with_split_row_number(assigned), ["split"])
    result = {
        "dataset": info["dataset"], "seed": seed, "features": K.FEATURES,
        "splits": {r["split"]: r for r in statistics}, "input_rows": info["output_rows"],
        "domain_groups": sum(r["domain_groups"] for r in statistics),
        "inputs": {s: publish.fingerprint(rows.where(F.col("split") == s)) for s in K.SPLITS},
        "domain_overlap_between_splits": 0, "sources_combined": False}
    out.manifest(result)
    out.publish()
    return result


def load_split(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One verified split; the other splits' files stay closed."""
    info = publish.read_manifest(spark, f"{folder}/summary")
    rows = tables.read_split(spark, f"{folder}/rows", name)
    publish.check_fingerprint(rows, info["inputs"][name], f"Split {name}")
    return tables.check_contract(
        rows.select("url", "label", *K.FEATURES, "row_number", "split_row_number", "domain_group", "split"),
        info["splits"][name]["rows"])


def _manifest(split_info: dict, settings: models.Settings) -> dict:
    return {"dataset": split_info["dataset"], "inputs": split_info["inputs"],
            "positive_class": SOURCES[split_info["dataset"]].positive_class,
            "threshold": K.THRESHOLD, "test_evaluated": False, "settings": asdict(settings)}


def train_dataset(spark: SparkSession, split_folder: str, destination: str,
                  settings: models.Settings | None = None) -> DataFrame:
    """Fit all models on train, score validation, store models, metrics and examples."""
    settings = settings or models.Settings()
    info = publish.read_manifest(spark, f"{split_folder}/summary")
    if info["sources_combined"] or info["domain_overlap_between_splits"]:
        raise ValueError("Resolve domain overlap before training")
    out = publish.Publication(spark, destination)
    train = models.weighted(load_split(spark, split_folder, "train"))
    validation = load_split(spark, split_folder, "validation")
    fits = [models.fit_majority(train), models.fit_logistic(train, settings),
            models.fit_forest(train, settings), models.fit_additive(train, settings),
            models.fit_boosted(train, validation, settings),
            models.fit_boosted(train, validation, settings, models.WITHOUT_HTTPS, ABLATED)]
    keep = ["split_row_number", "url", "label", "uses_https"]
    scored = out.table("validation_predictions", models.score_all(fits, validation, keep))
    if not models.bad_probabilities(scored).isEmpty():
        raise ValueError("A model returned probabilities outside 0..1")
    quality = metrics.binary_metrics(scored, by=["model"])
    seconds = spark.createDataFrame([(f.name, f.fit_seconds) for f in fits], "model string, fit_seconds double")
    quality = quality.join(seconds, "model").withColumns({
        "evaluation_split": F.lit("validation"), "threshold": F.lit(K.THRESHOLD)})
    saved = out.table("validation_metrics", quality)
    out.table("validation_subgroups", metrics.subgroup_metrics(scored.withColumnRenamed("model", "variant")))
    ablation = saved.where(F.col("model").isin("boosted_trees", ABLATED))
    out.table("ablation", metrics.change(
        ablation, ablation.where("model = 'boosted_trees'"), ["evaluation_split"]))
    both = train.select("split", "label", "uses_https").unionByName(
        validation.select("split", "label", "uses_https"))
    out.table("https_by_class", metrics.flag_share(both))

    additive = explain.build(fits[3], train)
    if not explain.unreconstructed(validation.select(*K.FEATURES, "url"), additive, fits[3]).isEmpty():
        raise AssertionError("Contributions do not reconstruct the prediction")
    importance = models.importance_table(spark, fits[1])
    for fit in (fits[2], fits[4], fits[5]):
        importance = importance.unionByName(models.importance_table(spark, fit))
    out.table("importances", importance)
    out.table("term_importances", explain.term_importance(train, additive))
    out.table("shapes", explain.shape_table(spark, additive))
    explain.save(spark, additive, out.path("additive"))
    chosen = sampling.outcome_sample(
        scored.where("model = 'additive'"), "split_row_number", seed=settings.seed)
    examples = validation.join(F.broadcast(chosen.select("split_row_number", "outcome", "prediction")),
                               "split_row_number")  # at most twelve rows
    out.table("local_examples", explain.contributions(
        examples, additive, ["split_row_number", "url", "label", "outcome", "prediction"]))
    for fit in fits:
        models.save(spark, fit, out.path(f"models/{fit.name}"), _manifest(info, settings))
    out.manifest({**_manifest(info, settings), "models": [f.name for f in fits]})
    out.publish()
    return spark.read.parquet(f"{destination}/validation_metrics")


def cluster_dataset(spark: SparkSession, split_folder: str, destination: str,
                    seed: int = K.DEFAULT_SEED, sample_size: int = 2000, ks=range(2, 7)) -> dict:
    """Cluster the class-1 training rows; labels only filter and check."""
    out = publish.Publication(spark, destination)
    chosen = cluster.select_class(load_split(spark, split_folder, "train"))
    scaled = cluster.assemble(cluster.preprocess(chosen, cluster.scaling(chosen)))
    values = out.table("audit/values", scaled)
    selection, fits = cluster.compare_k(values, "split_row_number", ks, sample_size, seed)
    selection = out.table("k_selection", selection)
    best = cluster.choose_k(selection).first()
    if best is None:
        raise ValueError("No usable clustering found; inspect feature diversity")
    model = fits[best["k"]]
    assigned = out.table("cluster_assignments", cluster.with_distance(
        model.transform(values), model.clusterCenters()).drop("values", *["z_" + n for n in cluster.ORDER]))
    out.table("cluster_summary", cluster.cluster_summary(assigned))
    details = out.table("cluster_feature_comparison", cluster.profile(assigned))
    out.table("cluster_top_features", cluster.top_features(details))
    out.table("cluster_examples", cluster.representatives(assigned, "split_row_number"))
    model.write().overwrite().save(out.path("model"))
    result = {"selected_k": best["k"], "seed": seed, "clustered_rows": assigned.count(),
              "labels_used_as_features": False, "held_out_sets_used": False}
    out.manifest(result)
    out.publish()
    return result


def _verified_models(spark, split_folder: str, model_folder: str) -> dict:
    """Provenance, ordinals and stored metrics of one source, before any test row is read."""
    info = publish.read_manifest(spark, f"{split_folder}/summary")
    rows = spark.read.parquet(f"{split_folder}/rows").select("domain_group", "split", "split_row_number")
    if not split.leaking_groups(rows).isEmpty():
        raise ValueError("A domain appears in multiple partitions")
    if not split.assignments_aligned(rows).where("not contiguous").isEmpty():
        raise ValueError("Split row numbers are not contiguous")
    stored = spark.read.parquet(f"{model_folder}/validation_metrics")
    again = metrics.binary_metrics(
        spark.read.parquet(f"{model_folder}/validation_predictions"), by=["model"])
    if not metrics.consistent(stored, again, ["model"]).where("not agrees").isEmpty():
        raise ValueError("Stored metrics disagree with the stored predictions")
    names = publish.read_manifest(spark, f"{model_folder}/summary")["models"]
    for name in names:
        manifest = publish.read_manifest(spark, f"{model_folder}/models/{name}/manifest")
        wanted = models.WITHOUT_HTTPS if name == ABLATED else K.FEATURES
        publish.same_provenance(manifest, info, wanted)
    best = metrics.best_model(stored.withColumn("dataset", F.lit(info["dataset"])), ["dataset"])
    return {"info": info, "names": names, "selected": best.first()["selected"], "stored": stored}


def _evaluate_set(spark, out, name, rows, fits, selected, validation, seed) -> None:
    keep = ["split_row_number", "domain_group", "url", "label", "uses_https"]
    scored = out.table(f"{name}/test_predictions", models.score_all(fits, rows, keep))
    if not models.bad_probabilities(scored).isEmpty():
        raise ValueError("A model returned probabilities outside 0..1")
    quality = metrics.binary_metrics(scored, by=["model"])
    before = validation.select("model", F.col("f1").alias("validation_f1"))
    out.table(f"{name}/test_metrics", quality.join(before, "model", "left").withColumns({
        "evaluation_split": F.lit("test"), "threshold": F.lit(K.THRESHOLD),
        "selected_on_validation": F.col("model").isin(selected),
        "f1_change_from_validation": F.col("f1") - F.col("validation_f1")}))
    out.table(f"{name}/test_https_subgroups",
              metrics.subgroup_metrics(scored.withColumnRenamed("model", "variant")))
    out.table(f"{name}/curves", metrics.curve_points(scored, ["model"]))
    for model in selected:
        picked = sampling.error_sample(scored.where(F.col("model") == model), "split_row_number", seed=seed)
        few = F.broadcast(picked.select("split_row_number", "outcome", "prediction", "probability"))  # at most six rows
        examples = out.table(f"{name}/{model}_error_examples", rows.join(few, "split_row_number"))
        fit = next(f for f in fits if f.name == model)
        if fit.pipeline is not None and hasattr(fit.pipeline.stages[-1], "treeWeights") \
                and "boosted" in fit.extra.get("original", fit.name):
            out.table(f"{name}/{model}_error_contributions", explain.tree_contributions(
                examples, fit, ["split_row_number", "outcome"], out.path(f"{name}/nodes_{model}")))
        elif fit.extra.get("original", fit.name) == "additive":
            # The shapes as published with the model: centred on its training rows.
            out.table(f"{name}/{model}_error_contributions", explain.contributions(
                examples, fit.extra["shapes"], ["split_row_number", "outcome"]))


def evaluate(spark: SparkSession, sources: dict[str, tuple[str, str]], destination: str,
             seed: int = K.DEFAULT_SEED) -> dict:
    """Freeze the validation choices, then open the tests and the cross-source challenge.

    `sources` maps 'larger' and 'smaller' to (split folder, model folder). The frozen
    selection is written and read back before any test row is touched.
    """
    out = publish.Publication(spark, destination)
    found = {k: _verified_models(spark, *folders) for k, folders in sources.items()}
    out.manifest({"selected": {k: v["selected"] for k, v in found.items()},
                  "selection_completed_before_test_read": True,
                  "rule": "f1, recall, average precision, then name"}, "selection_before_test")
    selected = publish.read_manifest(spark, out.path("selection_before_test"))["selected"]
    fits, tests = {}, {}
    for key, (split_folder, model_folder) in sources.items():
        fits[key] = [models.load(spark, f"{model_folder}/models/{n}") for n in found[key]["names"]]
        for fit in fits[key]:
            if fit.name == "additive":
                fit.extra["shapes"] = explain.load(spark, f"{model_folder}/additive", fit.features)
        tests[key] = load_split(spark, split_folder, "test")
        _evaluate_set(spark, out, key, tests[key], fits[key], [selected[key]], found[key]["stored"], seed)
    known = spark.read.parquet(f"{sources['larger'][0]}/rows")
    challenge = out.table("cross_source/rows", split.outside_source(tests["smaller"], known))
    excluded = tests["smaller"].count() - challenge.count()
    if not split.shared_groups(challenge, known).isEmpty():
        raise AssertionError("Source domain overlap in the transfer test")
    crossing, stored = [], None
    for key in ("larger", "smaller"):
        fit = next(f for f in fits[key] if f.name == selected[key])
        alias = f"{key}_source_model"
        crossing.append(models.Fitted(alias, fit.features, fit.pipeline, fit.prior, fit.fit_seconds,
                                      {**fit.extra, "original": fit.name}))
        row = found[key]["stored"].where(F.col("model") == fit.name).withColumn("model", F.lit(alias))
        stored = row if stored is None else stored.unionByName(row)
    classes = {r[0] for r in challenge.select("label").distinct().collect()}
    if classes == {0, 1}:
        _evaluate_set(spark, out, "cross_source", challenge, crossing,
                      [f.name for f in crossing], stored, seed)
    else:
        raise ValueError("The cross-source challenge needs both classes")
    result = {"selected": selected, "excluded_shared_domain_rows": excluded, "test_evaluated": True,
              "models_refitted": False, "sources_combined": False}
    out.manifest(result, "completion")
    out.publish()
    return result
