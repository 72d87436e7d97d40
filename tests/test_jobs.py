"""The whole pipeline on two derived sources: clean, split, train, cluster, evaluate."""

import pytest
from pyspark.sql import functions as F

from urlgauge import constants as K
from urlgauge.catalog import inputs
from urlgauge.operators import explain, models
from urlgauge.plans import jobs, ordered
from urlgauge.sources import publish

TINY = models.Settings(logistic_iterations=20, forest_trees=4, forest_depth=4, boosted_rounds=4,
                       boosted_rate=0.3, boosted_leaf=5, additive_rounds=4,
                       additive_rate=0.3, additive_leaf=5, additive_bins=16)


@pytest.fixture(scope="module")
def folders(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs"))
    rows = inputs.view(spark, sf_dir, inputs.URLS_V)
    # A digit keeps domains of the two sources partly apart.
    bad = F.col("l_partkey") % 6 == F.lit(1)
    odd = F.col("l_orderkey") % 11 == 0
    kinds = {
        "larger": rows.where("l_suppkey % 2 = 0").withColumn(
            "original_label", F.when(bad != odd, "phishing").otherwise("benign")),
        "smaller": rows.withColumn("url", F.regexp_replace("url", r"\.com", ".net")).withColumn(
            "original_label", F.when(bad != odd, "0").otherwise("1")),
    }
    out = {}
    for name, df in kinds.items():
        numbered = ordered.number_rows(df, inputs.ROW_KEY, "source_row")
        # Give each row its own path so that labels of one URL do not conflict.
        numbered = numbered.withColumn("url", F.concat("url", F.lit("/r"), F.col("source_row")))
        jobs.prepare_dataset(spark, numbered, name, f"{root}/{name}/prepared")
        jobs.split_dataset(spark, f"{root}/{name}/prepared", f"{root}/{name}/split", rules=inputs.RULES)
        jobs.train_dataset(spark, f"{root}/{name}/split", f"{root}/{name}/models", TINY)
        out[name] = f"{root}/{name}"
    return root, out


def test_manifest_reconciles(spark, folders):
    for folder in folders[1].values():
        info = publish.read_manifest(spark, f"{folder}/prepared/summary")
        assert info["input_rows"] == (info["output_rows"] + info["invalid_rows"]
                                      + info["conflicting_label_rows"] + info["duplicate_rows"])


def test_publish_once(spark, folders):
    folder = folders[1]["larger"]
    with pytest.raises(FileExistsError):
        jobs.split_dataset(spark, f"{folder}/prepared", f"{folder}/split", rules=inputs.RULES)


def test_changed_input_is_detected(spark, folders):
    rows = spark.read.parquet(f"{folders[1]['larger']}/split/rows")
    recorded = publish.fingerprint(rows)
    with pytest.raises(ValueError, match="changed"):
        publish.check_fingerprint(rows.withColumn("label", 1 - F.col("label")), recorded, "rows")


def test_additive_model_serves_without_training_rows(spark, folders):
    folder = f"{folders[1]['larger']}/models"
    model = explain.load(spark, f"{folder}/additive", K.FEATURES)
    fit = models.load(spark, f"{folder}/models/additive")
    rows = spark.read.parquet(f"{folders[1]['larger']}/split/rows").where("split = 'test'").select("url", *K.FEATURES)
    assert rows.count() > 0 and explain.unreconstructed(rows, model, fit).isEmpty()
    # The contributions are those that training published, centred ones.
    given = {(r["split_row_number"], r["term"]): r["contribution_log_odds"]
             for r in spark.read.parquet(f"{folder}/local_examples").collect()}
    numbers = sorted({n for n, _ in given})
    held = spark.read.parquet(f"{folders[1]['larger']}/split/rows").where("split = 'validation'").where(
        F.col("split_row_number").isin(numbers))
    got = {(r["split_row_number"], r["term"]): r["contribution_log_odds"]
           for r in explain.contributions(held, model, ["split_row_number"]).collect()}
    assert got == given
    with pytest.raises(ValueError, match="feature order"):
        explain.load(spark, f"{folder}/additive", ["url_length"])


def test_model_reload_rejects_other_columns(spark, folders):
    path = f"{folders[1]['larger']}/models/models/additive"
    assert models.load(spark, path).name == "additive"
    with pytest.raises(ValueError, match="feature order"):
        models.load(spark, path, ["url_length"])


def test_clusters(spark, folders):
    root, sources = folders
    result = jobs.cluster_dataset(spark, f"{sources['larger']}/split", f"{root}/clusters",
                                  sample_size=200, ks=(2, 3))
    table = spark.read.parquet(f"{root}/clusters/k_selection").collect()
    assert result["selected_k"] == max(table, key=lambda r: (r["silhouette_estimate"], -r["k"]))["k"]
    examples = spark.read.parquet(f"{root}/clusters/cluster_examples").collect()
    for row in examples:
        assert row["example_rank"] <= 3
    seen = {(r["cluster"], r["domain_group"]) for r in examples}
    assert len(seen) == len(examples)


def test_evaluation(spark, folders):
    root, sources = folders
    result = jobs.evaluate(spark, {k: (f"{v}/split", f"{v}/models") for k, v in sources.items()},
                           f"{root}/final")
    assert set(result["selected"]) == {"larger", "smaller"}
    known = spark.read.parquet(f"{sources['larger']}/split/rows").select("domain_group").distinct()
    crossed = spark.read.parquet(f"{root}/final/cross_source/test_predictions")
    assert crossed.join(known, "domain_group", "left_semi").isEmpty()
    per_model = {r["model"]: r["n"] for r in crossed.groupBy("model").agg(F.count("*").alias("n")).collect()}
    assert len(set(per_model.values())) == 1 and len(per_model) == 2


def test_one_of_two_writers_publishes(spark, tmp_path):
    target = str(tmp_path / "out")
    first = publish.Publication(spark, target, owner="first")
    with pytest.raises(FileExistsError, match="first"):
        publish.Publication(spark, target, owner="second")
    again = publish.Publication(spark, target, owner="first")  # the same owner after a failure
    again.table("rows", spark.range(3))
    again.publish()
    with pytest.raises(FileExistsError):
        publish.Publication(spark, target, owner="second")
    other = publish.Publication(spark, str(tmp_path / "left"), owner="first")
    other.table("rows", spark.range(3))
    other.abandon()
    publish.Publication(spark, str(tmp_path / "left"), owner="second").table("rows", spark.range(1))
    assert first.claim == again.claim and not publish.exists(spark, again.claim)
