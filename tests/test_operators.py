"""Operators against small brute-force answers and published rows."""

import datetime
import hashlib
import pathlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from urlgauge.catalog import inputs, learning_queries
from urlgauge.functions import cards, features, numbers, urls
from urlgauge.operators import cluster, explain, metrics, prepare, sampling
from urlgauge.plans import ordered
from urlgauge.sources import registry, tables


def test_exact_rounding_matches_python(spark):
    rng = random.Random(5)
    values = [rng.randint(0, 10_000) / 100 for _ in range(400)] + [6.25, 0.05, 2.675, 50.15, 99.95]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", numbers.exact_round(F.col("v"), 1).alias("r")).collect():
        assert row["r"] == round(row["v"], 1), row["v"]


def test_numbering_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randint(0, 50)}", i) for i in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i int").repartition(7)
    got = {(r["k"], r["i"]): (r["n"], r["m"]) for r in ordered.number_rows(
        ordered.number_rows(df, ["k", "i"], "n"), ["i"], "m", within=["k"]).collect()}
    seen = {}
    for place, key in enumerate(sorted(rows), start=1):
        seen[key[0]] = seen.get(key[0], 0) + 1
        assert got[key] == (place, seen[key[0]])


def test_ordinals_with_gaps(spark):
    ids = sorted(random.Random(2).sample(range(100_000), 500))
    df = spark.createDataFrame([(i,) for i in ids], "i long")
    got = {r["i"]: r["row_number"] for r in ordered.number_ordinals(df, "i", bucket=1000).collect()}
    assert got == {i: n for n, i in enumerate(ids, start=1)}


def brute_ranking(pairs):
    pos = [p for p, y in pairs if y]
    neg = [p for p, y in pairs if not y]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
    ap, before = 0.0, 0.0
    for cut in sorted({p for p, _ in pairs}, reverse=True):
        tp = sum(a >= cut for a in pos)
        recall = tp / len(pos)
        ap += (recall - before) * tp / (tp + sum(b >= cut for b in neg))
        before = recall
    return auc, ap


def test_ranking_metrics_by_definition(spark):
    rng = random.Random(3)
    rows = [(m, rng.randint(0, 20) / 20 if m == "a" else rng.random(), rng.randint(0, 1))
            for m in "ab" for _ in range(200)]
    df = spark.createDataFrame(rows, "model string, probability double, label int")
    for row in metrics.binary_metrics(df, by=["model"]).collect():
        auc, ap = brute_ranking([(p, y) for m, p, y in rows if m == row["model"]])
        assert row["roc_auc"] == pytest.approx(auc) and row["average_precision"] == pytest.approx(ap)


def test_threshold_metrics_on_published_counts(spark):
    # Published held-out rows: a baseline that never predicts 1, and a logistic model.
    df = spark.createDataFrame([(63295, 0, 29759, 0), (56019, 7276, 5804, 23955)],
                               "tn long, fp long, fn long, tp long")
    first, second = metrics.threshold_metrics(df).orderBy("tp").collect()
    assert (first["precision"], first["recall"], first["f1"], first["balanced_accuracy"]) == (0, 0, 0, 0.5)
    assert second["f1"] == pytest.approx(0.7855386128873586)
    assert second["balanced_accuracy"] == pytest.approx(0.8450063884588876)


def test_subgroups_keep_undefined_rates(spark):
    df = spark.createDataFrame([("m", 0, 1, 0.9)] * 3 + [("m", 0, 1, 0.1)],
                               "variant string, uses_https int, label int, probability double")
    rows = {r["uses_https"]: r for r in metrics.subgroup_metrics(df).collect()}
    assert rows[0]["recall"] == 0.75 and rows[0]["false_positive_rate"] is None
    assert rows[1]["rows"] == 0 and rows[1]["accuracy"] is None


def test_cleaning_routes(spark):
    rows = [("http://a.com/", "benign"), ("http://A.com/", "phishing"), ("http://b.com", "phishing"),
            (" http://b.com ", "malware"), ("http://c.com", ""), ("http:///x", "benign"), ("http://d.com", "benign")]
    df = spark.createDataFrame([(i, u, c) for i, (u, c) in enumerate(rows, start=1)],
                               "source_row long, url string, original_label string")
    route = prepare.routed(df, registry.SOURCES["larger"])
    got = {r["source_row"]: (r["route"], r["reason"]) for r in route.collect()}
    assert got == {
        1: ("conflict", "conflicting_binary_labels"), 2: ("conflict", "conflicting_binary_labels"),
        3: ("kept", ""), 4: ("duplicate", ""), 5: ("invalid", "missing_label"),
        6: ("invalid", "empty_hostname"), 7: ("kept", "")}
    parts = prepare.split_routes(route, prepare.featured(route), "larger")
    meta = {r["source_row"]: r for r in parts.metadata.collect()}
    assert meta[3]["original_categories"] == "malware;phishing" and meta[3]["source_record_count"] == 2
    assert meta[3]["row_number"] == 1 and meta[7]["row_number"] == 2
    assert parts.duplicates.first()["retained_row_number"] == 1
    assert prepare.reconcile(route).first()["reconciled"]


def test_unknown_label_is_found(spark):
    df = spark.createDataFrame([("u", "Benign "), ("u", "spam")], "url string, original_label string")
    found = prepare.unknown_labels(df, registry.SOURCES["larger"]).collect()
    assert [r["label"] for r in found] == ["spam"]


def test_samples_are_distinct_and_stable(spark):
    rows = [(i, i % 2, 0.9 if i % 3 else 0.1, f"d{i % 5}") for i in range(300)]
    df = spark.createDataFrame(rows, "row int, label int, probability double, domain_group string")
    first = sampling.error_sample(df, "row").collect()
    again = sampling.error_sample(df.repartition(5), "row").collect()
    assert sorted(r["row"] for r in first) == sorted(r["row"] for r in again)
    for kind in ("FP", "FN"):
        groups = [r["domain_group"] for r in first if r["outcome"] == kind]
        assert len(groups) == 3 == len(set(groups))


def test_silhouette_by_definition(spark):
    rng = np.random.default_rng(4)
    points, owners = rng.normal(size=(40, 3)), np.array([0] * 20 + [1] * 19 + [2])
    df = spark.createDataFrame([(i, points[i].tolist(), int(owners[i])) for i in range(40)],
                               "i int, values array<double>, cluster int")
    got = {r["i"]: r["silhouette"] for r in cluster.silhouette_rows(df).collect()}
    away = np.linalg.norm(points[:, None] - points[None], axis=2)
    for i in range(40):
        mine = owners == owners[i]
        if mine.sum() == 1:
            assert got[i] == 0
            continue
        a = away[i][mine].sum() / (mine.sum() - 1)
        b = min(away[i][owners == o].mean() for o in set(owners) - {owners[i]})
        assert got[i] == pytest.approx((b - a) / max(a, b))


def test_silhouette_takes_all_rows_in_blocks(spark, tmp_path):
    from urlgauge import catalog

    rng = np.random.default_rng(8)
    points, owners = rng.normal(size=(10_050, 2)).round(2), rng.integers(0, 3, 10_050)
    points[:60] = points[0]  # equal vectors
    spark.createDataFrame(
        [(i, points[i].tolist(), int(owners[i])) for i in range(len(points))],
        "vec_id bigint, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: r["silhouette"] for r in catalog.queries()["e22_silhouette_rows"](spark, str(tmp_path)).collect()}
    assert len(got) == len(points)
    for i in [*range(0, 60, 20), *range(60, len(points), 500)]:
        away = np.linalg.norm(points - points[i], axis=1)
        a = away[owners == owners[i]].sum() / ((owners == owners[i]).sum() - 1)
        b = min(away[owners == o].mean() for o in {0, 1, 2} - {owners[i]})
        assert got[i] == pytest.approx((b - a) / max(a, b), abs=1e-6)
    mean = catalog.queries()["e22_silhouette"](spark, str(tmp_path)).first()[0]
    assert mean == pytest.approx(np.mean(list(got.values())), abs=1e-6)


def test_silhouette_does_not_depend_on_blocks(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, rng.normal(size=3).tolist(), i % 4) for i in range(90)],
                               "i int, values array<double>, cluster int")
    whole, parts = ({r["i"]: r["silhouette"] for r in cluster.silhouette_rows(df, block=n).collect()} for n in (90, 20))
    assert whole == pytest.approx(parts) and len(whole) == 90


@pytest.mark.parametrize("length,label,failing", [
    (64, 9, ()), (64, 10, ("e20_difference_pivot",)), (64, None, ("e20_difference_pivot",)),
    *[(n, 9, ("e19_cluster_profile", "e20_difference_pivot", "f04_top_features")) for n in (63, 65)]])
def test_other_lengths_and_clusters_are_errors(spark, tmp_path, length, label, failing):
    from urlgauge import catalog

    rows = [(i, [float(i * j % 7) for j in range(64)], i % 2) for i in range(6)] + [(6, [1.0] * length, label)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    for name in ("e19_cluster_profile", "e20_difference_pivot", "f04_top_features"):
        query = catalog.queries()[name]
        if name in failing:
            with pytest.raises(Exception, match="Expected vectors|No column for cluster"):
                query(spark, str(tmp_path)).collect()
        else:
            assert query(spark, str(tmp_path)).count()


def test_best_k_from_published_table(spark):
    rows = [(2, 0.20451969577028636), (3, 0.2397788044536081), (4, 0.18360595742614821), (5, 0.23092436763889054)]
    table = spark.createDataFrame(rows + [(6, None)], "k int, silhouette_estimate double")
    assert cluster.choose_k(table).first()["k"] == 3


def test_highlight_rebuilds_the_url(spark):
    from urlgauge.functions import features
    addresses = ["http://192.0.2.7/" + "x" * 60, "https://a.b.c.xn--pple-43d.xyz/p", "http://o0l1.com",
                 "http://u@o0o1.co:80/q", "bit.ly/x", "http://[2001:db8::1]/x"]
    df = spark.createDataFrame([(a,) for a in addresses], "url string")
    for row in cards.with_highlight(features.with_features(df)).collect():
        assert "".join(p["text"] for p in row["url_parts"]) == row["url"]
        assert all(p["highlighted"] == bool(p["label"]) for p in row["url_parts"])
    parts = {r["url"]: r["url_parts"] for r in cards.with_highlight(features.with_features(df)).collect()}
    tld = [p for p in parts["https://a.b.c.xn--pple-43d.xyz/p"] if "TLD watchlist" in p["label"]]
    assert [p["text"] for p in tld] == ["xyz"]
    assert any(p["text"] == "192.0.2.7" and p["label"] == "IP address host" for p in parts[addresses[0]])


def test_validation_codes(spark):
    cases = {"": "EMPTY", "   ": "EMPTY", "http://a b": "WHITESPACE", "ftp://a.com": "INVALID",
             "http://": "INVALID", "a.com": None, "x" * 8193: "TOO_LONG", " https://a.com/ ": None}
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    assert {r["url"]: r["error_code"] for r in urls.validate(df).collect()} == cases
    form = {"https://u:p@a.com": "USERINFO", "https://localhost": None, "https://intranet": "HOST",
            "a.com": "INVALID", "mailto:a@b.c": "SCHEME"}
    df = spark.createDataFrame([(u,) for u in form], "url string")
    assert {r["url"]: r["error_code"] for r in urls.validate_form(df).collect()} == form


def test_csv_source(spark, tmp_path):
    (tmp_path / "raw.csv").write_bytes(
        "﻿url,type,extra\n\"http://a.com/\"\"q\"\"\nnext\",benign,1\nNA,phishing,2\n,malware,3\n".encode())
    rows = tables.read_raw_csv(spark, str(tmp_path), registry.SOURCES["larger"]).orderBy("source_row").collect()
    assert [(r["source_row"], r["url"], r["original_label"]) for r in rows] == [
        (1, 'http://a.com/"q"\nnext', "benign"), (2, "NA", "phishing"), (3, "", "malware")]


def test_day_label(spark):
    df = spark.createDataFrame([(datetime.datetime(2026, 3, 5, 1, 2, 3),)], "ts timestamp")
    row = df.select(cards.day_label(F.col("ts")).alias("d"), cards.iso_stamp(F.col("ts")).alias("s")).first()
    assert row["d"] == "Mar - 05 - 2026" and row["s"] == "2026-03-05T01:02:03Z"


def plain_root(data, block, fan):
    level = [hashlib.sha256(data[i:i + block]).hexdigest() for i in range(0, len(data), block)]
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[i:i + fan]).encode()).hexdigest() for i in range(0, len(level), fan)]
    return level[0]


def test_file_trees(spark, tmp_path):
    sizes = [1, 999, 1000, 1001, 3000, 3001, 9000, 9001, 50_000]
    texts = {f"part {n}.bin": random.Random(n).randbytes(n) for n in sizes}
    for name, data in texts.items():
        (tmp_path / name).write_bytes(data)
    whole = {r["file"]: r["sha256"] for r in tables.file_fingerprints(spark, str(tmp_path)).collect()}
    got = {r["file"]: (r["bytes"], r["root"]) for r in tables.file_trees(spark, str(tmp_path), 1000, 3).collect()}
    assert got == {n: (len(d), plain_root(d, 1000, 3)) for n, d in texts.items()}
    assert got["part 999.bin"][1] in whole.values()
    changed = bytearray(texts["part 50000.bin"])
    changed[31_234] ^= 1
    (tmp_path / "part 50000.bin").write_bytes(changed)
    again = {r["file"]: (r["bytes"], r["root"]) for r in tables.file_trees(spark, str(tmp_path), 1000, 3).collect()}
    assert {n for n in got if got[n] != again[n]} == {"part 50000.bin"}


def test_a_scan_is_dealt_out_whatever_its_row_groups(spark, tmp_path, monkeypatch):
    """One row group that many splits share: only one of them has rows."""
    spark.range(0, 50_000, 1, 1).select("id", F.hash("id").alias("x")).write.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(tables, "TASK_BYTES", 32 << 10)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        scan = spark.read.parquet(str(tmp_path / "t"))
        assert scan.rdd.getNumPartitions() > 8
        sizes = [r["n"] for r in tables.spread(scan).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sum(sizes) == 50_000 and max(sizes) < 8000


def test_url_work_runs_compiled(spark):
    """Methods that HotSpot would only interpret are left to the operators; a limit that a user set stays."""
    limit, df = "spark.sql.codegen.hugeMethodLimit", spark.range(1).selectExpr("concat('http://a.com/', id) as url")
    spark.conf.unset(limit)
    features.with_features(df)
    assert int(spark.conf.get(limit)) == 8000
    spark.conf.set(limit, 60000)
    try:
        features.with_features(df)
        assert int(spark.conf.get(limit)) == 60000
    finally:
        spark.conf.unset(limit)


def test_an_outcome_sample_sorts_nothing(spark):
    """Also without some outcomes; the same rows as ranking all of them gives."""
    rows = spark.range(4000).selectExpr("id as row", "cast(id % 3 = 0 as int) as label", "case when id % 2 = 0 then 0.9 else 0.1 end as probability")
    found = sampling.outcome_sample(rows, "row", 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan and "Sort " not in plan
    best = {}
    for i in range(4000):
        said = ("T" if (i % 3 == 0) == (i % 2 == 0) else "F") + ("P" if i % 2 == 0 else "N")
        best.setdefault(said, []).append((hashlib.sha256(f"42|{i}".encode()).hexdigest(), i))
    want = sorted((n, i) for n, all_rows in best.items() for _, i in sorted(all_rows)[:3])
    assert sorted((r["outcome"], r["row"]) for r in found.collect()) == want
    assert {r["outcome"] for r in sampling.outcome_sample(rows.where("row % 2 = 0"), "row", 3).collect()} == {"TP", "FP"}


def test_eligible_rows_shuffle_bytes_not_digits(spark):
    keys = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(3)]
    rows = spark.createDataFrame([(1, keys[0], 0, ""), (2, keys[0], 1, ""), (3, keys[1], 1, ""), (4, keys[1], 1, ""),
                                  (5, keys[2], 0, ""), (6, "", 0, "empty_url"), (7, "", 1, "empty_url")],
                                 "source_row int, url_key string, label int, reason string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = prepare.eligible(rows)
        plan = found.select("source_row")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(packed_key" in plan and "hashpartitioning(url_key" not in plan
    assert sorted(r["source_row"] for r in found.collect()) == [3, 4, 5]
    assert [r["url_key"] for r in prepare.conflicting_keys(rows).collect()] == keys[:1]


def test_written_intermediates_pack_digests(spark):
    """Digests as hex text take about half of their digits on disk."""
    made = ordered.cut(spark.range(0, 20_000, 1, 1).selectExpr("sha2(cast(id as string), 256) as digest"))
    size = sum(pathlib.Path(f.removeprefix("file://")).stat().st_size for f in made.inputFiles())
    assert made.count() == 20_000 and size < 20_000 * 45


def test_the_featured_table_is_not_packed_tightly(spark, sf_dir):
    """Tasks are cut by bytes on disk: tightly packed rows would make the learners' tasks larger in memory."""
    assert all(f.endswith(".snappy.parquet") for f in learning_queries.table(spark, sf_dir).inputFiles())


def test_contributions_sort_only_what_they_return(spark):
    """Titles, display values and directions of every term were built and sorted for rows that don't return them."""
    rows = spark.createDataFrame([(1, 30, 0.25), (2, 7, float("nan")), (3, None, float("inf")), (4, 1 << 30, 1e-7)],
                                 "i int, url_length int, entropy double")
    model = explain.Additive(["url_length", "entropy"], {"url_length": [10.0], "entropy": [0.5]}, [
        (("url_length",), np.array([-1.0, 2.0])), (("url_length", "entropy"), np.array([[0.5, 1.5], [-3.0, 0.25]]))], 0.0)
    found = explain.contributions(rows, model, ["i"])
    assert "Raises" not in found._jdf.queryExecution().analyzed().toString()
    whole = explain.explained(rows, model).select("i", F.posexplode("contributions").alias("p", "e")).select(
        "i", "e.term", F.col("p") + 1, "e.contribution", F.lit(0.0), "e.feature_values")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        map(tuple, whole.collect()), key=str)
    told = rows.select(*[cards.value_cell(names).alias(str(i)) for i, names in enumerate((["url_length"], ["url_length", "entropy"]))],
                       *[F.to_json(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.col(n).cast("double") for n in names])))
                         for names in (["url_length"], ["url_length", "entropy"])]).collect()
    assert all(r[0] == r[2] and r[1] == r[3] for r in told)


def test_numbers_as_text_without_a_formatter(spark):
    """Texts put together from whole numbers are those of the formatter and of floating numbers."""
    rng = np.random.default_rng(3)
    values = [0.0, -0.0, 0.00005, 0.99995, 2.5, 999_999.99995, 1e6, 1e12, -1.25, float("nan"), float("inf"), None, *rng.random(3000).tolist(),
              *(rng.random(1000) * 1e6).tolist(), *(rng.integers(0, 20001, 3000) / 20000).tolist()]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (1, 4):
        old = F.format_string(f"%.{digits}f", numbers.exact_round(F.col("v"), digits))
        assert rows.where(~numbers.fixed_text(F.col("v"), digits).eqNullSafe(old)).count() == 0
    counts = spark.createDataFrame([(v,) for v in (0, 7, 9_999_999, 10_000_000, 2_000_000_000, -3, None)], "url_length int")
    told = [r[0] for r in counts.select(cards.value_cell(["url_length"])).collect()]
    assert told == ['{"url_length":%s}' % t for t in ("0.0", "7.0", "9999999.0", "1.0E7", "2.0E9", "-3.0", "null")]


def test_contributions_are_ordered_without_sorting_structs(spark):
    df = spark.createDataFrame([("http://a.com/x-1",), ("https://bücher.example/" + "z" * 50,), ("",)], "url string")
    rows = explain.score_urls(df, learning_queries.FIXED)
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert "sort_array(array(struct(o" not in plan
    for r in rows.where("valid").collect():
        sizes = [-abs(c["contribution"]) for c in r["model_contributions"]]
        assert sizes == sorted(sizes) and len(sizes) == len(learning_queries.FIXED.terms)
        ties = [(s, [learning_queries.FIXED.name(i) for i in range(len(sizes))].index(c["term"])) for s, c in zip(sizes, r["model_contributions"])]
        assert ties == sorted(ties)


def test_distinct_urls_are_dealt_out(spark, sf_dir):
    """Adaptive execution joined the distinct URLs into few tasks by their bytes, and most threads waited for the last ones."""
    rows = inputs.every_url(spark, sf_dir)
    assert rows.rdd.getNumPartitions() >= 32 and rows.count() == rows.distinct().count()
