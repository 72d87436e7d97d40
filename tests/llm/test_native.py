"""Exact dedup, sharding, chat formatting, mixing."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from uuid import uuid4

import numpy as np
import pytest
from pyspark.sql import functions as F

from urlgauge.llm import chat, exact_dedup, mixing, queries, sharding

from .conftest import TEXTS


def cells(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple(repr(float(x)) if isinstance(x, float) else str(x) for x in r) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twin(spark, sf_dir, db, name):
    got = queries.QUERIES[name](spark, sf_dir).toPandas()
    wanted = db.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert cells(got) == cells(wanted)


def index(spark):
    return exact_dedup.ExactIndex(spark, f"test_index_{uuid4().hex[:10]}", buckets=4)


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_dedup_of_odd_rows(spark, odd, none):
    got = index(spark).add(odd).collect()
    assert len(got) == len(TEXTS) + 1
    groups = defaultdict(list)
    for i, t, *_ in TEXTS + [(None, None)]:
        groups[norm(t)].append((i, t or ""))
    best = {k: min(v, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0] for k, v in groups.items()}
    by_hash = {hashlib.sha256(k.encode()).hexdigest(): k for k in groups}
    for r in got:
        k = by_hash[r["text_sha256"]]
        assert r["group_size"] == len(groups[k]) and r["keep_id"] == best[k]
        assert r["kept"] == (r["doc_id"] == best[k])
    assert index(spark).add(none).count() == 0


def test_exact_index_persists(spark):
    schema = "doc_id bigint, text string"
    known = index(spark)
    known.add(spark.createDataFrame([(1, "a b"), (2, "c")], schema))
    again = exact_dedup.ExactIndex(spark, known.name)
    got = {r["doc_id"]: r for r in again.add(spark.createDataFrame([(5, "ab"), (6, "d"), (7, "D")], schema)).collect()}
    assert (got[5]["keep_id"], got[5]["kept"], got[5]["known"]) == (1, False, True)
    assert got[6]["kept"] and got[7]["kept"]
    assert again.table().count() == 4


def test_index_is_not_shuffled(spark):
    ix = index(spark)
    ix.add(spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id bigint, text string"))
    plan = ix.fresh(spark.createDataFrame([("x",)], "digest string"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("hashpartitioning") == 1 and "Bucketed: true" in plan


def reference_jump(key, shards):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    keys = [*range(300), -1, -(1 << 63), (1 << 63) - 1, 1 << 40]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for n in (1, 2, 8, 9, 33):
        got = {r[0]: r[1] for r in df.select("k", sharding.jump_hash(F.col("k"), n)).collect()}
        assert got == {k: reference_jump(k, n) for k in keys}


def check_shards(rows, wanted):
    assert len(rows) == wanted
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8) and r["law"] == "key"
        assert r["shard"] == reference_jump(r["doc_id"] or 0, 8)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_sharding(spark, sf_dir, texts, odd, none):
    rows = queries.op3_sharding(spark, sf_dir).collect()
    check_shards(rows, len(texts))
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    check_shards(sharding.shard_documents(odd, 8, blocks=3).collect(), len(TEXTS) + 1)
    assert sharding.shard_documents(none).count() == 0
    assert sharding.placed_documents(odd).count() == len(TEXTS) + 1


def test_shards_are_written(spark, odd, tmp_path):
    placed = sharding.placed_documents(odd)
    sharding.write_shards(placed, str(tmp_path / "shards"))
    again = spark.read.schema(placed.schema).parquet(str(tmp_path / "shards"))
    assert sorted(map(str, again.select(placed.columns).collect())) == sorted(map(str, placed.collect()))
    folders = {p.name for p in (tmp_path / "shards").iterdir() if p.is_dir()}
    assert folders == {f"shard_id={r[0] if r[0] is not None else '__HIVE_DEFAULT_PARTITION__'}" for r in placed.select("shard_id").distinct().collect()}


def plain_fold(events):
    """Events (msg, reset, text) in order: messages as [msg, text], by begin."""
    live, seen = [], set()
    for msg, reset, text in events:
        at = next((i for i, m in enumerate(live) if m[0] == msg), None)
        if msg not in seen:
            seen.add(msg)
            live.append([msg, text])
        elif at is not None and reset:
            live[at:] = [[msg, text]]
        elif at is not None:
            live[at][1] += text
    return [t for _, t in live]


def test_events_of_dropped_messages_change_nothing(spark):
    named = {1: [("q1", 0, "q1"), ("a1", 0, "a1"), ("q1", 1, "q1b"), ("a2", 0, "a2"), ("a1", 1, "late"), ("q2", 0, "q2")]}
    rng = np.random.default_rng(4)
    for conv in range(2, 60):
        named[conv] = [(f"m{rng.integers(0, 5)}", int(rng.random() < 0.4), f"<{i}>") for i in range(rng.integers(1, 14))]
    rows = [(conv, i, "edit" if reset else "delta", msg, "user", text) for conv, events in named.items()
            for i, (msg, reset, text) in enumerate(events)]
    log = spark.createDataFrame(rows, "conv_id bigint, seq bigint, kind string, msg string, role string, text string")
    got = defaultdict(list)
    for r in chat.fold_events(log).orderBy("conv_id", "seq").collect():
        got[r["conv_id"]].append(r["text"])
    assert got[1] == ["q1b", "a2", "q2"]
    assert got == {conv: plain_fold(events) for conv, events in named.items()}
    long = [(9, i, "delta", "m", "user", "word " * 20_000) for i in range(3)]
    wide = spark.createDataFrame(long, log.schema).withColumns({n: F.lit(1) for n in ("_at", "_begin", "_live", "formatted")})
    assert chat.fold_events(wide).first()["text"] == "word " * 60_000


def test_a_named_batch_can_be_added_again(spark):
    known, schema = index(spark), "doc_id bigint, text string"
    known.add(spark.createDataFrame([(1, "a")], schema), batch="first")
    batch = spark.createDataFrame([(2, "a"), (3, "b"), (4, " b"), (None, "c")], schema)
    told = [sorted(map(str, known.add(batch, batch="second").collect())) for _ in range(2)]
    assert told[0] == told[1] and sum("kept=True" in r for r in told[0]) == 2
    assert known.table().count() == 3
    again = known.compact()
    assert again.table().count() == 3 and sorted(map(str, again.add(batch, batch="second").collect())) == told[0]
    assert not any(r["kept"] for r in again.add(batch, batch="third").collect())


def test_rows_without_an_id_are_mixed_in_many_blocks(spark):
    rows = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("w "), "id").alias("text"), F.lit("s").alias("source"))
    assert mixing.mix(rows).agg(F.sum("taken")).first()[0] == 6000


LOG = [
    (1, 1, "message", "m1", "user", "Hi"), (1, 2, "delta", "m2", "assistant", "Hel"), (1, 3, "delta", "m2", "assistant", "lo"),
    (1, 4, "message", "m3", "user", "again?"), (1, 5, "edit", "m1", "user", "Hi <b> & </turn>\n"),
    (1, 6, "delta", "m4", "assistant", "A"), (1, 7, "delta", "m4", "assistant", "B"),
    (1, 8, "regenerate", "m4", "assistant", ""), (1, 9, "delta", "m4", "assistant", "C"),
    (2, 1, None, None, None, None), (2, 2, "message", "x", "user>", "&lt;&amp;lt;"), (None, 1, "message", "y", "user", "z"),
]


def test_chat_folds_and_reads_back(spark):
    log = spark.createDataFrame(LOG, "conv_id bigint, seq bigint, kind string, msg string, role string, text string")
    out = {r["conv_id"]: r for r in chat.render(chat.fold_events(log)).select(
        "*", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("lost")).collect()}
    # The edit drops what followed the edited message; the regeneration drops the first answer.
    assert [tuple(t) for t in out[1]["turns"]] == [("user", "Hi <b> & </turn>\n"), ("assistant", "C")]
    assert out[1]["lost"] == "C"
    assert [tuple(t) for t in out[2]["turns"]] == [("", ""), ("user>", "&lt;&amp;lt;")]
    assert [tuple(t) for t in out[None]["turns"]] == [("user", "z")]
    assert chat.digests(chat.render(chat.fold_events(log.limit(0)))).count() == 0


def test_equal_chat_rows_are_messages_of_their_own(spark):
    rows = [(1, 1, None, None, "user", "a"), (1, 1, None, None, "user", "a"), (1, 2, None, None, "assistant", "b"),
            (1, 2, "message", None, "assistant", "b"), (1, 3, "delta", None, "assistant", "c"), (1, 3, "delta", None, "assistant", "d")]
    log = spark.createDataFrame(rows, "conv_id bigint, seq bigint, kind string, msg string, role string, text string")
    turns = chat.render(chat.fold_events(log)).select(chat.read_turns(F.col("formatted")).alias("t")).first()["t"]
    assert [tuple(t) for t in turns] == [("user", "a"), ("user", "a"), ("assistant", "b"), ("assistant", "b"), ("assistant", "cd")]


def test_chat_query(spark, sf_dir):
    rows = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        rows[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    rows[-7] = [(0, "user", "\\### Assistant: </turn> ok"), (1, "assistant", "\\### Assistant: </turn> ok")]
    got = queries.op5_chat_format(spark, sf_dir).collect()
    assert {r["conv_id"] for r in got} == set(rows)
    for r in got:
        turns = sorted(rows[r["conv_id"]])
        lost = "".join(t for _, role, t in turns if role == "assistant")
        digest = hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in turns).encode()).hexdigest()
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"]) == (len(turns), digest, len(lost))
        assert r["loss_sha256"] == hashlib.sha256(lost.encode()).hexdigest()


def fill(sizes, weights, epochs=3):
    """Targets by clamping one source at a time."""
    left, open_, target = float(sum(sizes)), set(range(len(sizes))), {}
    while open_:
        level = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if epochs * sizes[i] <= level * weights[i]]
        if not over:
            return {**target, **{i: level * weights[i] for i in open_}}
        for i in over:
            target[i] = epochs * sizes[i]
            left -= target[i]
            open_.discard(i)
    return target


@pytest.mark.parametrize("sizes,weights", [
    ([100, 10, 1], [5, 2, 1]), ([1, 1, 1000], [5, 2, 1]), ([0, 0], [5, 2]), ([7], [5]), ([0, 5], [5, 2]),
    ([3, 900, 2, 40, 11], [5, 2, 1, 5, 2])])
def test_water_fill(spark, sizes, weights):
    sources = spark.createDataFrame([(i, w, s) for i, (s, w) in enumerate(zip(sizes, weights))],
                                    "i int, weight bigint, source_size bigint")
    got = {r["i"]: r["target"] for r in mixing.water_fill(sources, sum(sizes)).collect()}
    for i, t in fill(sizes, weights).items():
        assert got[i] == pytest.approx(t, rel=1e-9, abs=1e-9)
    assert sum(got.values()) == pytest.approx(sum(sizes))


def test_mixing_of_odd_rows(odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == len(TEXTS) + 1
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items())
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(odd).collect()), key=str)
    assert mixing.mix(none).count() == 0 and mixing.repeated(none).count() == 0
    copies = mixing.repeated(odd)
    assert copies.columns == odd.columns and copies.count() > 0
