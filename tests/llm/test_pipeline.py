"""The stages against plain rules on their own input."""

import corpus_pipeline
from urlgauge.llm import decontaminate, mixing, sharding, simhash
from urlgauge.llm.common import written

from .conftest import TEXTS
from .test_native import reference_jump


def test_stages_chain(spark, sf_dir, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "mixing", "sharding"]
    seen, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, now, sf_dir), "stage")
        assert out.columns[:5] == docs.columns
        seen[name], now = (now, out), out
    before, after = seen["toxicity"]
    assert 0 < after.count() <= before.count() and after.exceptAll(before).count() == 0
    before, after = seen["simhash"]
    keep = {r["component_id"] for r in simhash.near_duplicates(before).collect()}
    assert {r["doc_id"] for r in after.collect()} == keep and after.count() == len(keep)
    before, after = seen["decontamination"]
    dirty = {r["doc_id"] for r in decontaminate.contaminated(before, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert {r["doc_id"] for r in before.collect()} - dirty == {r["doc_id"] for r in after.collect()}
    before, after = seen["mixing"]
    copies = {}
    for r in after.collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    for r in mixing.mix(before).collect():
        n = copies.get(r["doc_id"], 0)
        assert n == (1 if r["size"] == 0 else int(r["taken"] / r["size"] + 0.5))
    before, after = seen["sharding"]
    assert after.count() == before.count()
    assert all(r["shard_id"] == reference_jump(r["doc_id"], 8) for r in after.collect())
    run = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(str, run.collect())) == sorted(map(str, after.collect()))


def test_stages_take_odd_rows(spark, sf_dir, odd, none):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, sf_dir)
        assert out.columns[:len(odd.columns)] == odd.columns and out.count() <= 3 * (len(TEXTS) + 1)
        assert stage(spark, none, sf_dir).count() == 0
