"""SimHash, decontamination, toxicity, language model, personal data, licences."""

import itertools
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from urlgauge.llm import context_tree, decontaminate, licences, pii, queries, simhash, toxicity
from urlgauge.llm.common import Hasher, text_buffer, word_spans
from urlgauge.llm.decontaminate import IS_TOKEN

from .conftest import TEXTS

SPACE = r"[^\x20\x09-\x0D]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# SimHash

def plain_fingerprint(text):
    words = re.findall(SPACE, lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(ids, fps, distance):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= distance:
            root[find(i)] = find(j)
    least = defaultdict(list)
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)].append(d)
    return [min(least[find(i)], default=None) for i in range(len(ids))]


def test_simhash_query(spark, sf_dir, texts):
    got = {r["doc_id"]: r for r in queries.op6_simhash(spark, sf_dir).collect()}
    ids = sorted(texts)
    fps = [plain_fingerprint(texts[i]) for i in ids]
    for i, f, c in zip(ids, fps, closure(ids, fps, 2)):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{f:016x}", c)


def test_simhash_of_odd_rows(odd, none):
    rows = [(i, t) for i, t, *_ in TEXTS] + [(None, None)]
    fps = [plain_fingerprint(t) for _, t in rows]
    wanted = Counter(zip((i for i, _ in rows), (f"{f:016x}" for f in fps), closure([i for i, _ in rows], fps, 2)))
    assert Counter(map(tuple, simhash.near_duplicates(odd).collect())) == wanted
    kept = simhash.distinct_documents(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted({c for *_, c in wanted if c is not None})
    assert simhash.near_duplicates(none).count() == 0 and simhash.distinct_documents(none).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_anchors_lose_no_link(spark, distance):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = set(base.tolist()) | {0, (1 << 64) - 1}
    for f in base.tolist() + [0]:
        for _ in range(6):
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                f ^= 1 << int(b)
            fps.add(f)
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), distance).collect()}
    wanted = {(a, b) for a, b in itertools.combinations(signed, 2) if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= distance}
    assert got == wanted


def test_golay_anchor_covers_everything():
    words = np.random.default_rng(1).integers(0, 1 << 23, 5000)
    row, code, weight = simhash._near(words, 3)
    assert np.array_equal(row, np.arange(5000)) and weight.max() <= 3
    assert all(bin(a ^ b).count("1") == w for a, b, w in zip(words.tolist(), code.tolist(), weight.tolist()))
    row, code, weight = simhash._near(words[:50], 5)
    every = np.unique(simhash._near(np.arange(1 << 16), 3)[1])
    assert {(r, c) for r, c in zip(row.tolist(), code.tolist())} >= {
        (i, c) for i, w in enumerate(words[:50].tolist()) for c in every.tolist() if bin(w ^ c).count("1") <= 5}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(-5, 2000)]
    got = dict(map(tuple, simhash.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}, -5: -5, 2000: -5}


# Decontamination

def test_word_hashes():
    column = pa.array(["Ab  cd", None, "", "cd", "x", "ab"]).slice(0, 6)
    data, at = text_buffer(column)
    starts, ends, row = word_spans(data, at, IS_TOKEN | (np.arange(256) < 91) & (np.arange(256) > 64))
    assert row.tolist() == [0, 0, 3, 4, 5]
    h = Hasher(data)(starts, ends)
    assert h[1] == h[2] and len(set(h.tolist())) == 4


def words_of(text, fold=lower):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text or ""))


def agrees(doc, item, window=13, similarity=0.8):
    """Whether some diagonal has a window of the item that agrees, found by trying all."""
    span = min(window, len(item))
    need = int(np.ceil(similarity * span - 1e-9))
    for d in range(-len(item) + 1, len(doc)):
        same = [0 <= d + i < len(doc) and doc[d + i] == w for i, w in enumerate(item)]
        if any(sum(same[i:i + span]) >= need for i in range(len(item) - span + 1)):
            return True
    return False


def test_decontamination_query(spark, sf_dir, texts):
    items = {r["item_id"]: words_of(r["text"], str.lower) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    got = {r["doc_id"]: r["items"] for r in queries.op9_decontaminate(spark, sf_dir).collect()}
    wanted = {}
    for i, t in texts.items():
        doc = words_of(t, str.lower)
        some = set(doc)
        hits = [k for k, w in items.items() if sum(x in some for x in w) >= 0.5 * len(w) and agrees(doc, w)]
        if hits:
            wanted[i] = sorted(hits)
    assert got == wanted and got


def test_decontamination_tolerates_substitution(spark, odd, none):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    pick = lambda n: [vocabulary[i] for i in rng.integers(0, 4000, n)]
    items = [(k, " ".join(pick(30))) for k in range(30)] + [(100, "Tiny, five word item here"), (101, None), (102, "...")]
    docs, dirty = [], set()
    for k, text in items[:30]:
        w = text.split()
        for at in rng.choice(30, 3, replace=False):  # a tenth of the words replaced
            w[at] = "other"
        docs.append((k, " ".join(pick(50) + w + pick(50)).upper()))
        dirty.add(k)
        docs.append((1000 + k, " ".join(pick(120))))
    docs += [(500, "xx tiny; five WORD item here yy"), (501, "tiny five word item"), (502, items[0][1].split(" ", 17)[0]), (503, None)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["doc_id"]: r for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), benchmark).collect()}
    assert set(got) == dirty | {500}
    assert got[500]["item_id"] == 100 and got[500]["matched"] == 5 and (got[500]["first_word"], got[500]["last_word"]) == (1, 5)
    assert decontaminate.contaminated(odd, benchmark).count() == 0
    assert decontaminate.contaminated(none, benchmark).count() == 0
    assert decontaminate.contaminated(odd, benchmark.limit(0)).count() == 0
    assert decontaminate.clean_documents(odd, benchmark).count() == len(TEXTS) + 1
    assert decontaminate.clean_documents(none, benchmark).count() == 0


def test_stages_decide_by_row(spark):
    """Rows that share an id, or have none, go or stay by their own text."""
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(None, passage), (None, "a clean text without any passage"), (5, passage), (5, "another clean text"), (6, None), (7, "kept")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = decontaminate.clean_documents(df, spark.createDataFrame([(1, passage)], "item_id bigint, text string"))
    assert Counter(map(tuple, kept.collect())) == Counter(r for r in rows if r[1] != passage)
    twice = [(1, passage), (1, "quite another text about other things"), (1, passage), (2, passage.upper()), (3, "quite another text about other things")]
    got = simhash.distinct_documents(spark.createDataFrame(twice, "doc_id bigint, text string"))
    assert Counter(map(tuple, got.collect())) == Counter(twice[:2])


def test_decontamination_of_short_items_finds_every_substitution(spark):
    """Items of 1 to 13 words: all copies with as many words replaced as the rule admits, and none with more."""
    items, docs, wanted = [], [], set()
    for n in range(1, 14):
        item = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(item)))
        free = n - int(np.ceil(0.8 * n - 1e-9))
        for k in range(min(free + 2, n + 1)):
            for left in itertools.combinations(range(n), k):
                words = [f"other{i}" if i in left else w for i, w in enumerate(item)]
                if k <= free:
                    wanted.add((len(docs), n))
                docs.append((len(docs), " ".join(["before", *words, "after"])))
        if n >= decontaminate.SHORT:  # cut off at the document's end, the missing words counted as replaced
            for k in range(1, free + 1):
                for left in itertools.combinations(range(n - k), free - k):
                    wanted |= {(len(docs), n), (len(docs) + 1, n)}
                    words = ["other" if i in left else w for i, w in enumerate(item[:n - k])]
                    ends = ["other" if i in left else w for i, w in enumerate(item[k:])]
                    docs += [(len(docs), " ".join(["before", *words])), (len(docs) + 1, " ".join([*ends, "after"]))]
    found = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                   spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == wanted


# Toxicity

def test_toxicity_separates_held_out_rows(spark):
    big = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op4_toxicity(spark, big).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{big}/labels.parquet").collect()}
    held = [(got[i]["score"], y) for i, y in labels.items() if got[i]["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    good, bad = [s for s, y in held if not y], [s for s, y in held if y]
    auc = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert auc > 0.85


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (77, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(odd, labels)
    assert model.score(odd.select("doc_id", "text")).count() == len(TEXTS) + 1
    assert toxicity.reject_toxic(odd, labels.limit(0)).count() == len(TEXTS) + 1
    assert toxicity.reject_toxic(none, labels).columns == none.columns
    column = pa.array([t for _, t, *_ in TEXTS] + [None, "you IDIOT!!! idiiiot 1d1ot"])
    made = toxicity.features(column, toxicity.Lexicon(np.zeros(0, np.uint64), np.zeros(0)))
    assert made.shape == (len(column), len(toxicity.FEATURES)) and np.isfinite(made).all()
    assert not made[[3, 4]].any()


def test_toxicity_features_do_not_depend_on_neighbours():
    lexicon = toxicity.Lexicon(Hasher(np.frombuffer(b"idiot", np.uint8))(np.array([0]), np.array([5])), np.array([5.0]))
    texts = ["you are an idiot", "", "IDIOT idiot you", "calm words only", "1d1ot", None, "an idiot here", "you you"]
    together = toxicity.features(pa.array(texts), lexicon)
    alone = np.concatenate([toxicity.features(pa.array([t], pa.string()), lexicon) for t in texts])
    assert np.allclose(together, alone)
    at = {n: i for i, n in enumerate(toxicity.FEATURES)}
    assert together[0, at["near_person"]] == pytest.approx(0.25) and together[4, at["masked_hits"]] > 0


def plain_features(text, weights):
    """The features of one text, word by word; `weights` has words, and beginnings of words with a star after them."""
    raw, text = (text or "").encode(), text or ""
    low, size = text.lower(), max(len(raw), 1)
    letters, loose = "a-zA-Z\u0080-\U0010ffff", "a-zA-Z\u0080-\U0010ffff" + "".join(toxicity.LEET)

    def weigh(word):
        data = word.encode()
        begins = [data[:k] + b"*" for k in toxicity.PREFIXES if len(data) > k]
        return max([weights.get(k, 0.0) for k in (data, *begins)])

    words = re.findall(f"[{letters}]+", low)
    found, n = [weigh(w) for w in words], max(len(words), 1)
    strong = [i for i, w in enumerate(found) if w >= 3]
    person = [i for i, w in enumerate(words) if w in toxicity.SECOND_PERSON]
    mixed = [w for w in re.findall(f"[{loose}]+", low) if set(w) & set(toxicity.LEET) and set(w) - set(toxicity.LEET)]
    masked = [w for w in mixed if weigh("".join(toxicity.LEET.get(c, c) for c in w)) >= 3]
    capital = lambda c: "A" <= c <= "Z" or "\u00c0" <= c <= "\u00de"
    shouted = [w for w in re.findall(f"[{letters}]+", text)
               if (c := sum(map(capital, w))) >= 2 and 2 * c >= len(w.encode())]
    signs = [b for b in raw if 33 <= b < 127 and not chr(b).isalnum()]
    runs = [i for i in range(2, len(raw)) if raw[i] == raw[i - 1] == raw[i - 2] and raw[i] not in b" \t\n\x0b\x0c\r"]
    return [len(strong) / n, np.log1p(len(strong)), sum(0 < w < 3 for w in found) / n, max(found, default=0.0), sum(found) / n,
            max((1 / (1 + abs(i - j)) for i in strong for j in person), default=0.0), len(person) / n,
            sum(map(capital, text)) / size, len(shouted) / n, text.count("!") / n, text.count("?") / n,
            len(signs) / size, sum(48 <= b < 58 for b in raw) / size, len(mixed) / n, np.log1p(len(masked)),
            len(runs) / size, sum(a == b for a, b in zip(words, words[1:])) / n, np.log1p(len(words)),
            sum(len(w.encode()) for w in words) / n, (strong[-1] + 1) / n if strong else 0.0]


def test_toxicity_features_by_plain_rules(texts):
    weights = {b"idiot": 5.0, b"stup*": 3.5, b"meh": 1.25, b"fool*": 2.0, b"foolishn*": 4.0, "d\u00fcmmling".encode(): 3.0}
    keys, values = [], []
    for word, weight in weights.items():
        data = np.frombuffer(word.rstrip(b"*"), np.uint8)
        key = Hasher(data)(np.array([0]), np.array([len(data)]))[0]
        kind = toxicity.PREFIXES.index(len(data)) + 1 if word.endswith(b"*") else 0
        keys.append(int(key) + kind & (1 << 64) - 1)
        values.append(weight)
    lexicon = toxicity.Lexicon(np.array(keys, np.uint64), np.array(values))
    made = ["you IDIOT!!! 1d10t, stupid stupid foolishness", "aa", "aaa", "a", "\u00dcBER D\u00dcMMLING t\u00fa? meh", None, "", "!!!", "!",
            "st\u00fcpid $tup1dity @ 33 fool foolishnessly", " \t  \n  ", "you " * 40 + "idiot", "x" * 300_000 + " idiot"]
    column = [*made, *texts.values()]
    got = toxicity.features(pa.array(column, pa.string()), lexicon)
    want = np.array([plain_features(t, weights) for t in column])
    for i, name in enumerate(toxicity.FEATURES):
        assert np.allclose(got[:, i], want[:, i], rtol=1e-5, atol=1e-7), name


def test_toxicity_sample_is_of_rows_with_a_text(spark):
    """Labels without a document don't use the sample up."""
    docs = spark.createDataFrame([(i, "you awful idiot" if i % 2 else "a calm day") for i in range(60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5_000)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, sample=60)
    assert model.share == 0.5 and model.trees is not None


# Language model

def direct_token(token, counts, depth):
    """Log10 probability of a token by the recursive definition, over all training tokens."""
    data = defaultdict(lambda: [0, 0])  # (node, context) -> counts
    parts = Counter()
    for t, n in counts.items():
        for key in context_tree.keys_of(t):
            parts[key] += n

    def path(key):
        symbol, context = key & 255, key >> 8
        nodes, bits = context_tree.decisions(np.array([symbol]))
        return [(int(nodes[0][i]), int(bits[0][i]), context) for i in range(8)]

    for key, n in parts.items():
        for node, bit, context in path(key):
            for d in range(depth + 1):
                data[d, node, context & ((1 << 8 * d) - 1)][bit] += n
    children = defaultdict(set)
    for d, node, c in data:
        if d:
            children[d - 1, node, c & ((1 << 8 * (d - 1)) - 1)].add((d, node, c))
    lkt = lambda n: float(context_tree.log_kt(np.array([n[0]]), np.array([n[1]]))[0])
    memo = {}

    def weighted(k):
        if k not in memo:
            memo[k] = lkt(data[k]) if k[0] == depth else float(
                np.log(0.5) + np.logaddexp(lkt(data[k]), sum(weighted(c) for c in children[k])))
        return memo[k]

    def mixed(d, node, bit, context, above):
        k = (d, node, context & ((1 << 8 * d) - 1))
        if sum(data.get(k, (0, 0))) == 0:
            return above
        own = (data[k][bit] + 0.5) / (sum(data[k]) + 1)
        if d == depth:
            return own
        share = np.exp(np.log(0.5) + lkt(data[k]) - weighted(k))
        return share * own + (1 - share) * mixed(d + 1, node, bit, context, own)

    return sum(log10(mixed(0, node, bit, context, 0.5)) for key in context_tree.keys_of(token) for node, bit, context in path(key))


def test_keys_of_many_tokens():
    tokens = [b"a", context_tree.END, b"abcdefghijkl", "é".encode() * 9, b"\xff\x00"]
    keys, sizes = context_tree._keys(tokens)
    assert keys.tolist() == [k for t in tokens for k in context_tree.keys_of(t)] and sizes.sum() == len(keys)
    assert [len(x) for x in context_tree._keys([])] == [0, 0]


def test_context_tree_matches_its_definition(spark):
    counts = {b"the": 9, b"then": 3, b"hen": 1, "é".encode(): 2, context_tree.END: 4, b"abcdefghijkl": 2}
    asked = [*counts, b"theft", b"zzz", b"abcdefghijklm"]
    rows = [(bytearray(t), counts.get(t, 0)) for t in asked]
    got = {bytes(r["token"]): r["logp0"] for r in context_tree.token_scores(
        spark.createDataFrame(rows, "token binary, n0 bigint"), 1).collect()}
    for t in asked:
        assert got[t] == pytest.approx(direct_token(t, counts, context_tree.DEPTH), rel=1e-5)


def test_next_byte_probabilities_sum_to_one(spark):
    counts = Counter({k: 0 for c in range(256) if c != 32 for k in context_tree.keys_of(bytes([c]))})
    for token, n in ((b"ab", 3), (b"ba", 2)):
        for k in context_tree.keys_of(token):
            counts[k] += n
    keys = {(r["key"] & 255): r["logp0"] for r in context_tree.key_scores(
        spark.createDataFrame(list(counts.items()), "key bigint, n0 bigint"), 1).collect() if r["key"] >> 8 == 0x20}
    # All first bytes but the space, which takes the rest.
    assert len(keys) == 255 and 0.9 < sum(10 ** p for p in keys.values()) < 1


def test_lm_query(spark, sf_dir, texts):
    got = {r["doc_id"]: r for r in queries.op2_lm_score(spark, sf_dir).collect()}
    assert set(got) == set(texts)
    tokens = {i: re.findall(SPACE, lower(t)) + ["\n"] for i, t in texts.items()}
    counts = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel=1e-9)
        assert r["score"] < 0
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def running(text):
    """The keys of a running text, byte by byte."""
    data = b" " + b"".join(w + b" " for w in context_tree.tokenise(text)) + context_tree.END
    return [int.from_bytes(data[max(0, i - context_tree.DEPTH):i + 1], "big") for i in range(1, len(data))]


def test_running_keys_cross_words():
    texts = ["Abc  de\tf", None, "", "é 😀", "a\nlongerwordhere b ", " x"]
    keys, row = context_tree.running_keys(pa.array(["skipped", *texts]).slice(1))
    assert keys.tolist() == [k for t in texts for k in running(t)]
    assert row.tolist() == [i for i, t in enumerate(texts) for _ in running(t)]


def test_lm_contexts_cross_words(spark, monkeypatch):
    """Scores by the recursive definition over the running text; the order of words matters."""
    train = ["the cat sat on the mat", "a cat sat", "on the cat"]
    asked = ["the cat sat on a mat", "mat a on sat cat the", "new words"]
    rows = [(i, t, i < 0) for i, t in [*zip((0, 1, 2), train), *zip((-1, -2, -3), asked)]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, held boolean")
    got = {r["doc_id"]: r["score"] for r in context_tree.score_documents(docs, F.col("held"), block_bytes=30).collect()}
    monkeypatch.setattr(context_tree, "keys_of", running)
    for i, t in zip((-1, -2, -3), asked):
        assert got[i] == pytest.approx(direct_token(t, Counter(train), context_tree.DEPTH), rel=1e-5)
    assert got[-1] > got[-2] + 1


def test_lm_of_odd_rows(odd, none):
    got = context_tree.score_documents(odd, F.col("doc_id") == 7).collect()
    assert len(got) == len(TEXTS) + 1
    assert {r["n_tokens"] for r in got if r["doc_id"] in (3, 4, 5)} == {1}
    assert context_tree.score_documents(none, F.lit(False)).count() == 0
    alone = context_tree.score_documents(odd, F.lit(True)).where("doc_id = 7").first()
    assert (alone["n_known"], alone["train_tokens"]) == (0, 0) and alone["score"] < 0


# Personal data

PATTERNS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and pii.luhn(re.sub("[^0-9]", "", m))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def plain_spans(text):
    found = [(m.start(), m.end(), kind) for kind, p, ok in PATTERNS for m in p.finditer(text) if ok(m.group())]
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_patterns(texts):
    rng = np.random.default_rng(2)
    pieces = ["a@b.c", "@", "x@y@z.de", "1.2.3.4", ".5", "256.1.1.1", "4111 1111 1111 1111", "-", "+1 (017) 555-7713", "+",
              "é", " ", "\n", "12", "a.b", "1..2", "0007.08.9.10", "4111111111111111", "_", "%", "@b.c.", "(", "9" * 25]
    made = ["".join(pieces[i] for i in rng.integers(0, len(pieces), rng.integers(1, 14))) for _ in range(4000)]
    for text in [*made, *(t or "" for t in texts.values())]:
        assert pii.base_spans(text) == plain_spans(text), text


def test_base_patterns_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "@" * 300_000, "a@b" * 100_000, "1 " * 150_000):
        pii.base_spans(text)


def test_message_passing_is_exact_on_trees():
    rng = np.random.default_rng(4)
    unary, edges = rng.normal(size=(5, 3)), np.array([[0, 1], [1, 2], [1, 3], [4, 3]])
    factors, which = rng.normal(size=(2, 3, 3)), np.array([0, 1, 1, 0])
    total = np.zeros((5, 3))
    for state in itertools.product(range(3), repeat=5):
        p = np.exp(sum(unary[i, s] for i, s in enumerate(state)) + sum(
            factors[w][state[a], state[b]] for (a, b), w in zip(edges, which)))
        for i, s in enumerate(state):
            total[i, s] += p
    total /= total.sum(1, keepdims=True)
    assert np.allclose(pii.marginals(unary, edges, factors, which, rounds=10, damping=0.0), total)


def test_pii_query(spark, sf_dir, texts):
    got = {r["doc_id"]: r for r in queries.op8_pii(spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        spans = plain_spans(t or "")
        joined = [f"{k}:{a}:{b}" for a, b, k in spans]
        assert got[i]["base_sha256"] == __import__("hashlib").sha256(",".join(joined).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in spans) for k in pii.KINDS]
        assert set(joined) <= set(got[i]["spans"].split(",") if got[i]["spans"] else [])


def test_skip_edges_carry_labels(spark):
    rows = [(i, f"call +1 ({100 + i}) 555-{1000 + i} now, or +1 ({100 + i}) 555-{1000 + i} later, and 12 of 40 things") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = pii.fit(docs)
    # Equal numbers were phones together, so a mention that the pattern misses follows its twin.
    assert model.factors[1][4, 4] > model.factors[1][0, 4]
    text = "call +1 (117) 555-1017 now, that is 555-1017 at night"
    base, spans = model.spans([text])[0]
    assert [s[2] for s in base] == ["phone"] and set(base) <= set(spans)


def test_evidence_reaches_all_mentions():
    """A chain of 200 links and a hub of 200, with evidence at one node only: exact."""
    factors = np.full((1, 2, 2), 0.0) + np.eye(2) * 8
    unary = np.zeros((201, 2))
    unary[0] = 0, 12
    chain = np.stack([np.arange(200), np.arange(1, 201)], 1)
    hub = np.stack([np.zeros(200, int), np.arange(1, 201)], 1)
    keep = np.tanh(4) ** np.arange(201)  # correlation over a number of links
    strength = np.tanh(6)
    which = np.zeros(200, np.int64)
    assert np.allclose(pii.marginals(unary, chain, factors, which)[:, 1], (1 + strength * keep) / 2, atol=1e-4)
    assert np.allclose(pii.marginals(unary, hub, factors, which)[1:, 1], (1 + strength * keep[1]) / 2, atol=1e-4)


def test_messages_end_in_loops_that_swing():
    rng = np.random.default_rng(6)
    edges = np.array(list(itertools.combinations(range(12), 2)))
    factors = -9.0 * np.eye(5)[None]
    got = pii.marginals(rng.normal(size=(12, 5)), edges, factors, np.zeros(len(edges), np.int64))
    assert np.isfinite(got).all() and np.allclose(got.sum(1), 1)


def test_digit_groups_are_linked():
    linked = lambda text: pii.skips(pii.tokens(text))
    assert linked("dial 30 123 456 or 30 123 456.") == [(0, 3), (1, 4), (2, 5)]
    assert linked("dial 30 123 456 7 times, then (30) 123 456, not 31 123 457") == [(0, 4), (1, 5), (2, 6)]
    assert linked("dial 30123456 or 30 123 456 or 30-123-456") == [(0, 1), (0, 2), (0, 3), (1, 4), (2, 4), (3, 4)]
    assert linked("1 2 of 3 4") == [] and linked("555-1017 and 555 1017") == [(0, 1), (0, 2)]


def test_spans_at_all_mentions():
    width = pii.unary_features(pii.tokens("1")).shape[1]
    model = pii.SkipChain(np.zeros((5, width)), np.zeros(5), np.zeros((5, 5)), 12 * np.eye(5))
    text = "call +30 (0) 555-123456 now" + ", or 555-123456 at night" * 40
    base, spans = model.spans([text])[0]
    assert len(base) == 1 and len(spans) == 41 and {s[2] for s in spans} == {"phone"}


def planted_mentions(i):
    """Base mentions of each kind, the same data written so that no pattern finds it, and numbers that are no personal data."""
    phone, card = f"+44 20 7{i:03d} {1000 + i}", luhn_number(f"4539{i:03d}88{i:03d}123")
    ip, mail = f"10.{i % 200}.{(7 * i) % 250}.{17 + i % 200}", f"person{i}@mail{i}.example.org"
    digits = phone.replace(" ", "").lstrip("+")
    again = [("phone", digits), ("card", "/".join(card[j:j + 4] for j in range(0, 16, 4))), ("ip", ip.replace(".", "-")),
             ("email", mail.replace(".", ","))]
    plain = [f"{48_000_000 + i}", f"2024-0{1 + i % 9}-1{i % 10}", f"{i}.{i % 7}.3", f"1,{100 + i}.50", f"room {i}b"]
    return [phone, card, ip, mail], again, plain


def luhn_number(stem):
    return next(stem + str(d) for d in range(10) if pii.luhn(stem + str(d)))


def test_pii_added_spans_on_planted_data(spark, texts):
    """Precision and recall of the spans that the field adds to the patterns'."""
    rows, wanted = [], {}
    for i, text in enumerate(t for t in texts.values() if t):
        words, (first, again, plain) = text.split(), planted_mentions(i)
        kind, second = again[i % 4]
        third, mixed = len(words) // 3, [w for p in plain for w in (p, "so")]
        parts = [*words[:third], "reach", first[i % 4], "or", *mixed, *words[third:2 * third], "as said", second, "and", *mixed, *words[2 * third:]]
        whole = " ".join(parts)
        rows.append((i, whole))
        if not any(k == kind and a < whole.index(second) + len(second) and whole.index(second) < b for a, b, k in pii.base_spans(whole)):
            wanted[i] = kind, whole.index(second), whole.index(second) + len(second)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    added = [(r["doc_id"], s["kind"], s["start"], s["end"]) for r in pii.find(docs, pii.fit(docs)).collect()
             for s in r["spans"] if s not in r["base"]]
    right = [a for a in added if wanted.get(a[0]) == a[1:]]
    assert len(wanted) > 100 and len(right) >= 0.9 * len(wanted) and len(right) >= 0.9 * len(added)


def test_pii_sample_counts_a_repeated_row_once(spark):
    one = [(1, "call +1 (212) 555-0187 or 40 12")] * 500
    more = [(i, f"call +1 ({200 + i}) 555-0187 or 40 {i}") for i in range(2, 40)]
    schema = "doc_id bigint, text string"
    repeated = pii.fit(spark.createDataFrame(one + more, schema), sample=10_000)
    single = pii.fit(spark.createDataFrame(one[:1] + more, schema), sample=10_000)
    assert np.allclose(repeated.factors, single.factors) and np.allclose(repeated.weights, single.weights, atol=1e-3)


def test_pii_of_odd_rows(odd, none):
    model = pii.fit(odd)
    assert pii.digests(pii.find(odd, model)).count() == len(TEXTS) + 1
    found = {r["doc_id"]: r for r in pii.digests(pii.find(odd, model)).collect()}
    assert [found[9_007_199_254_740_993][f"n_{k}"] for k in pii.KINDS] == [0, 1, 1, 1]
    assert pii.find(none, pii.fit(none)).count() == 0


# Licences

@pytest.mark.parametrize("text,named,always", [
    ("MIT", {"mit"}, {"mit"}), ("MIT OR Apache-2.0", {"mit", "apache-2.0"}, set()),
    ("MIT OR GPL-2.0 AND BSD", {"mit", "gpl-2.0", "bsd"}, set()),
    ("(MIT or GPL-2.0) and BSD", {"mit", "gpl-2.0", "bsd"}, {"bsd"}),
    ("(MIT or GPL-2.0 and MIT) and BSD", {"mit", "gpl-2.0", "bsd"}, {"mit", "bsd"}),
    ("GPL-2.0 WITH Classpath-exception-2.0 AND MIT", *[{"gpl-2.0 with classpath-exception-2.0", "mit"}] * 2)])
def test_expressions(text, named, always):
    assert licences.licences(text) == named and licences.required(text) == always
    # Against all subsets of the licences named: what is accepted must hold what is always required.
    for n in range(1 << len(named)):
        accepted = {x for i, x in enumerate(sorted(named)) if n >> i & 1}
        plain = text.lower()
        for x in sorted(named, key=len, reverse=True):
            plain = plain.replace(x, str(x in accepted))
        assert licences.permitted(text, accepted) == eval(plain)
        assert not licences.permitted(text, accepted) or always <= accepted


@pytest.mark.parametrize("text", ["", "MIT OR", "OR MIT", "(MIT", "MIT)", "MIT Apache", "()", "(A or B) with C"])
def test_broken_expressions(text):
    with pytest.raises(ValueError):
        licences.licences(text)


def test_expressions_have_no_limit():
    """2^40 choices, and a line with very many tags."""
    text = "SPDX-License-Identifier: " + " AND ".join(f"(L{i}a OR L{i}b)" for i in range(40))
    got = licences.scan(text, licences.automaton())
    assert got[5].split(",") == sorted(f"l{i}{x}" for i in range(40) for x in "ab") and got[6] == 1.0
    many = licences.scan("SPDX-License-Identifier MIT " * 30_000, licences.automaton())
    assert many[5:7] == ("mit", 1.0) and len(many[7]) == 30_000


def test_tags_and_notices():
    a = licences.automaton()
    scan = lambda t: licences.scan(t, a)
    assert scan("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\nx")[5:7] == ("apache-2.0,bsd-3-clause,mit", 1.0)
    assert scan("SPDX-License-Identifier: MIT and then some prose")[5:] == ("mit", 1.0, ["MIT"])
    assert scan("SPDX-License-Identifier: foo")[5:] == ("", 0.0, [])
    assert scan("SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 OR LicenseRef-Own.")[5:] == (
        "gpl-2.0-or-later with classpath-exception-2.0,licenseref-own", 1.0, ["GPL-2.0-or-later WITH Classpath-exception-2.0 OR LicenseRef-Own"])
    assert scan("SPDX-License-Identifier: MIT WITH prose")[5:] == ("mit", 1.0, ["MIT"])
    assert scan("BSD 3-Clause License; licensed under the ISC license")[5:7] == ("bsd-3-clause,isc", 0.9)
    assert scan("SPDX-License-Identifier: OR")[5:7] == ("", 0.0)
    assert scan("Released under the MIT License.")[1:7] == (1, 3, 3, "mit", "mit", 0.9)
    assert scan("mit license mit license")[1:4] == (2, 0, 2)
    assert scan(None) == (0, 0, None, None, "", "", 0.0, [])


def test_licence_query(spark, sf_dir, texts):
    got = {r["doc_id"]: r for r in queries.op10_licences(spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        words = words_of(t)
        places = [(p, label) for p in range(len(words)) for phrase, label in licences.BASE.items()
                  if words[p:p + len(phrase.split())] == phrase.split()]
        at = [p for p, _ in places]
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (
            len(words), len(at), min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))


def test_licence_query_evaluates_operators(spark, tmp_path):
    tag = "SPDX-License-Identifier: "
    texts = [tag + "MIT AND GPL-2.0", tag + "MIT OR GPL-2.0", f"{tag}ISC\n{tag}GPL-2.0 AND (MIT OR ISC)\n{tag}OR", "none", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op10_licences(spark, str(tmp_path)).collect()}
    assert got[0]["labels"] == got[1]["labels"] == "gpl-2.0,mit"
    assert [got[i]["required"] for i in range(5)] == ["gpl-2.0,mit", "", "isc;gpl-2.0", "", ""]
    assert [got[i]["permitted"] for i in range(5)] == ["false", "true", "true;false", "", ""]
    plain = {r["doc_id"]: r for r in licences.scan_documents(docs).collect()}
    assert plain[2]["required"] == ["isc", "gpl-2.0"] and plain[2]["permitted"] is None


def test_licences_of_odd_rows(odd, none):
    assert licences.scan_documents(odd).count() == len(TEXTS) + 1
    assert licences.scan_documents(none).count() == 0
