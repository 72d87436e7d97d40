"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the data, BENCH_CPUS the local threads. Every query is run to
its last row into a sink that discards it. A query that isn't timed is run before, so that the first
figure doesn't hold the session's start. The models' own fit seconds, and the seconds of a round of the
boosted ones, are given apart from the queries that prepare their inputs.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from urlgauge import catalog
from urlgauge.catalog import learning_queries

HEADLINE = [
    "x01_flagship", "c00_all_features", "b05_reject_reason", "b06_url_key", "b15_choose_split",
    "b23_highlight", "e03_keep_first", "e07_preparation_summary", "f02_output_row_number",
    "f03_duplicates", "d05_cross_source_anti", "e08_split_statistics", "e12_binary_metrics",
    "e13_curve_points", "e14_subgroups", "e19_cluster_profile", "e22_silhouette",
    "f01_split_row_number", "f06_error_sample", "x02_history_windows", "g02_logistic_regression",
    "g06_additive_model", "g08_reconstruction", "g16_acceptance",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    registered, times = catalog.queries(), {}
    registered["b01_trim"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    begun = time.perf_counter()
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    fits = {name: round(learning_queries.fitted(spark, sf_dir, name).fit_seconds, 3)
            for name in ("logistic_regression", "additive")}
    print(json.dumps({"metric": "headline_total", "value": round(time.perf_counter() - begun, 3),
                      "unit": "sec", "queries": times, "fit_seconds": fits,
                      "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
