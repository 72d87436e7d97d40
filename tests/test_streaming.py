"""The stream gives what the batch gives, once, whatever the arrival pattern."""

import os
import re

import pytest
from pyspark.sql import functions as F

from urlgauge.catalog import learning_queries
from urlgauge.operators import explain, history
from urlgauge.plans import ordered
from urlgauge.sources import tables
from urlgauge.sources.batch_log import BatchLog
from urlgauge.streaming import scorer


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return learning_queries.additive(spark, sf_dir)


def requests(spark, count):
    return spark.range(count).select(
        F.concat(F.lit("r"), "id").alias("request_id"),
        F.when(F.col("id") % 7 == 0, "bad url").otherwise(
            F.concat(F.lit("https://a"), F.col("id"), F.lit(".example.com/login"))).alias("url"),
        F.timestamp_seconds(1_700_000_000 + F.col("id")).alias("ts"))


def test_stream_equals_batch(spark, model, tmp_path):
    rows = requests(spark, 40)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows.write.mode("append").json(source)
    rows.where("request_id < 'r2'").write.mode("append").json(source)  # repeats
    stream = tables.read_requests(spark, source, streaming=True)
    scorer.run_available(stream, model, out, str(tmp_path / "state"))
    scorer.run_available(stream, model, out, str(tmp_path / "state"))  # nothing new
    got = scorer.history_log(spark, out).read().select("url", "trust_score", "status")
    batch = explain.score_urls(rows, model, request_limit=2048)
    wanted = batch.where("valid").select(F.col("scored_url").alias("url"), "trust_score", "status")
    assert sorted(got.collect()) == sorted(wanted.collect())
    ids = [r["id"] for r in scorer.history_log(spark, out).read().collect()]
    assert len(ids) == len(set(ids))
    rejected = scorer.rejected_log(spark, out).read()
    assert rejected.count() == batch.where("not valid").count()
    assert {r["error_code"] for r in rejected.collect()} == {"WHITESPACE"}


def test_a_replayed_batch_overwrites_itself(spark, model, tmp_path):
    scored = explain.score_urls(requests(spark, 10), model)
    write = scorer.writer(str(tmp_path))
    write(scored, 3)
    first = sorted(scorer.history_log(spark, str(tmp_path)).read().collect())
    write(scored, 3)
    assert sorted(scorer.history_log(spark, str(tmp_path)).read().collect()) == first


def test_late_and_repeated_requests_are_kept_once(spark, model, tmp_path):
    rows = requests(spark, 4).withColumn("ts", F.expr("timestampadd(minute, -90 * cast(substr(request_id, 2) as int), ts)"))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in ("request_id <> 'r3'", "request_id = 'r3'", "request_id <> 'r1'"):
        rows.where(part).write.mode("append").json(source)
        scorer.run_available(tables.read_requests(spark, source, streaming=True), model, out, str(tmp_path / "state"))
    got = scorer.id_log(spark, out).read().select("request_id").collect()
    assert sorted(r[0] for r in got) == ["r0", "r1", "r2", "r3"]
    history, rejected = (log(spark, out).read().count() for log in (scorer.history_log, scorer.rejected_log))
    assert (history, rejected) == (3, 1)


def given(spark, rows):
    """Requests as (id, url, day), unscored columns filled in."""
    return spark.createDataFrame(rows, "request_id string, url string, day int").select(
        "request_id", "url", F.timestamp_seconds(1_700_000_000 + 86_400 * F.col("day")).alias("ts"))


def test_no_request_is_lost_and_none_is_answered_twice(spark, model, tmp_path):
    out, write = str(tmp_path), scorer.writer(str(tmp_path))
    rows = [("a", "http://a.com/2", 2), ("a", "http://a.com/1", 1), ("b", "http://b.com/y", 1), ("b", "http://b.com/x", 1),
            (None, "http://n.com/1", 1), (None, "http://n.com/2", 1), (None, "no url", 1), ("", "http://e.com/", 1), ("t", "http://t.com/", None)]
    for batch, part in ((0, rows), (0, list(reversed(rows))), (1, [("a", "http://a.com/3", 0), (None, "http://n.com/1", 1), ("c", "", 9)])):
        write(explain.score_urls(given(spark, part), model), batch)
    assert sorted(r["url"] for r in scorer.history_log(spark, out).read().collect()) == [
        "http://a.com/1", "http://b.com/x", "http://e.com/", "http://n.com/1", "http://n.com/1", "http://n.com/2", "http://t.com/"]
    assert sorted(r["url"] for r in scorer.rejected_log(spark, out).read().collect()) == ["", "no url"]
    assert sorted(r["request_id"] for r in scorer.id_log(spark, out).read().collect()) == ["", "a", "b", "c", "t"]


def test_a_hundred_batches_leave_few_folders(spark, model, tmp_path):
    """A few real batches around a fold; the log alone is taken over a hundred. Scratch is empty after each batch."""
    out, write = str(tmp_path / "out"), scorer.writer(str(tmp_path / "out"), keep=2)
    scratch = ordered.working_folder(spark)
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    numbers = (0, 15, 16, 17)
    for batch in numbers:
        part = given(spark, [(f"r{batch}", f"http://h{batch}.com/", batch), ("r0", "http://again.com/", batch)])
        write(explain.score_urls(part, model), batch)
        assert set(os.listdir(scratch)) == before
    assert sorted(r["request_id"] for r in scorer.id_log(spark, out).read().collect()) == sorted(f"r{n}" for n in numbers)
    newest = history.recent(scorer.history_log(spark, out).read(), 2).collect()
    assert [r["url"] for r in newest] == [f"http://h{n}.com/" for n in (17, 16)]
    assert os.listdir(out + "/requests") and (0, 16) in scorer.id_log(spark, out).spans()[0]
    plan = scorer.earlier(spark, out, 20, [3, 4])._jdf.queryExecution().toString()
    assert "bucket#" in plan and re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(3,4\)", plan)
    log = BatchLog(spark, str(tmp_path / "log"), "id long", fold=4)
    for batch in range(100):
        log.fold(batch, lambda rows, path: rows.coalesce(1).write.mode("overwrite").parquet(path))
        log.write(batch, spark.range(batch, batch + 1).coalesce(1))
        assert len(os.listdir(tmp_path / "log")) <= 4 * 4 * 2
    assert sorted(r["id"] for r in log.read().collect()) == list(range(100))
    assert sorted(r["id"] for r in log.read(before=70).collect())[-1] >= 69
    assert log.holds(63) and not log.holds(99)


def test_a_folded_batch_is_done(spark, model, tmp_path):
    out, write = str(tmp_path), scorer.writer(str(tmp_path))
    for batch in (14, 15, 16):
        write(explain.score_urls(given(spark, [(f"r{batch}", f"http://h{batch}.com/", 1)]), model), batch)
    write(explain.score_urls(given(spark, [("other", "http://other.com/", 1)]), model), 15)  # folded: nothing changes
    write(explain.score_urls(given(spark, [("r16", "http://h16.com/", 1)]), model), 16)
    assert sorted(r["url"] for r in scorer.history_log(spark, out).read().collect()) == [f"http://h{n}.com/" for n in (14, 15, 16)]


def test_record_is_consistent(spark, model):
    for row in explain.score_urls(requests(spark, 20), model).where("valid").collect():
        total = row["base_log_odds"] + sum(c["contribution"] for c in row["model_contributions"])
        assert total == pytest.approx(row["total_log_odds"])
        assert row["prediction"] == int(row["phishing_probability"] >= 0.5)
        assert row["status"] == ("Potential phishing" if row["prediction"] else "Lower predicted risk")
        sizes = [abs(c["contribution"]) for c in row["model_contributions"]]
        assert sizes == sorted(sizes, reverse=True) and len(row["top_contributions"]) <= 6
        assert "".join(p["text"] for p in row["url_parts"]) == row["scored_url"]
        assert len(row["indicators"]) == 6


def test_tree_contributions_add_up(spark, sf_dir, tmp_path):
    from urlgauge import constants as K
    from urlgauge.operators import models
    fit = learning_queries.fitted(spark, sf_dir, "boosted_trees")
    few = learning_queries.table(spark, sf_dir).orderBy("l_orderkey", "l_linenumber").limit(6)
    scored = models.score(fit, few, ["l_orderkey", "l_linenumber", *K.FEATURES])
    parts = explain.tree_contributions(
        scored, fit, ["l_orderkey", "l_linenumber", "probability"], str(tmp_path / "nodes"))
    sums = parts.groupBy("l_orderkey", "l_linenumber", "probability").agg(
        (F.sum("contribution_log_odds") + F.max("base_log_odds")).alias("z")).collect()
    assert len(sums) == 6
    for row in sums:
        assert 1 / (1 + 2.718281828459045 ** -row["z"]) == pytest.approx(row["probability"], abs=1e-9)
