"""SimHash near-duplicates by anchor-point covering.

Fingerprint (64 bits): over the XXH64 hashes (seed 42) of all word shingles, repeats included, a bit
is 1 if more than half of the hashes have it. Two documents link when their fingerprints differ
in at most `distance` bits; a component is what links reach.

Anchors are the code words of the perfect binary Golay code of length 23 (covering radius 3), one
for each of the two lowest 23-bit blocks of a fingerprint: 4096 x 4096 anchors. A fingerprint's
home is the pair of code words within 3 bits of its blocks. If two fingerprints differ in t1
and t2 bits of the blocks, each lies within 3 + t1 and 3 + t2 bits of the other's home. So every
fingerprint is replicated to all anchors whose two distances exceed 3 by `distance` at most in sum
(about 62 of them for 2 bits), and only homes are compared with replicas at each anchor. All
64 bits decide there. Equal fingerprints are one node from the start, so copies make no pairs, and a
node has at most C(64,1) + C(64,2) = 2080 links of 2 bits, however large a group is.

Components: alternating large-star and small-star rounds over the links, written after each round.

Texts: null counts as empty; fewer words than the shingle length give one shingle of all words; no
word gives fingerprint 0, which links like any other. Rows with a null id take part in
links; a component of null ids alone has a null component_id. Equal rows repeat in the result.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import ship, written

SEED = 42
# Fixed value: generator polynomial of the binary Golay code of length 23.
GOLAY = 0b101011100011
RADIUS = 3


def fingerprint(text: str, shingle: int = 3, seed: int = SEED) -> int:
    words = text.encode().lower().split()
    return _fingerprint(words, shingle, seed)


def _fingerprint(words: list[bytes], shingle: int, seed: int) -> int:
    if not words:
        return 0
    whole, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(whole, seed)
    ends, starts, at = [], [], 0
    for w in words:
        starts.append(at)
        at += len(w)
        ends.append(at)
        at += 1
    hashes = np.fromiter((digest(whole[a:b], seed) for a, b in zip(starts, ends[shingle - 1:])),
                         "<u8", len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        block = hashes[part:part + (1 << 16)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = SEED, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp, text_hash): the fingerprint as a signed long, and a hash that tells rows of one id apart."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            # bytes.lower changes A-Z only; bytes.split cuts at [\x20\x09-\x0D] only.
            fps = np.fromiter((_fingerprint((t.as_py() or "").encode().lower().split(), shingle, seed)
                               for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), batch.column(2)], ["doc_id", "fp", "text_hash"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col)).mapInArrow(
        run, "doc_id bigint, fp bigint, text_hash bigint")


@lru_cache
def _errors(reach: int):
    """For each syndrome of the code, all error patterns of weight up to `reach`, and their weights."""
    def syndrome(word: int) -> int:
        for i in range(22, 10, -1):
            if word >> i & 1:
                word ^= GOLAY << (i - 11)
        return word

    units = [syndrome(1 << i) for i in range(23)]
    found = []
    for weight in range(reach + 1):
        for places in combinations(range(23), weight):
            s = pattern = 0
            for p in places:
                s ^= units[p]
                pattern |= 1 << p
            found.append((s, weight, pattern))
    found = np.array(sorted(found), np.int64)
    first = np.searchsorted(found[:, 0], np.arange(2049))
    low = np.array([syndrome(x) for x in range(1 << 12)], np.int64)
    high = np.array([syndrome(x << 12) for x in range(1 << 11)], np.int64)
    return found, first, low, high


def _near(block: np.ndarray, reach: int):
    """All code words within `reach` bits of 23-bit words: (row, code word, weight)."""
    found, first, low, high = _errors(reach)
    s = low[block & 0xFFF] ^ high[block >> 12]
    count = first[s + 1] - first[s]
    row = np.repeat(np.arange(len(block)), count)
    at = np.repeat(first[s] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    return row, block[row] ^ found[at, 2], found[at, 1]


def anchors(fps: np.ndarray, distance: int):
    """Replicas of uint64 fingerprints: (row, anchor, home). One home per row."""
    mask = np.uint64((1 << 23) - 1)
    r1, c1, w1 = _near((fps & mask).astype(np.int64), RADIUS + distance)
    r2, c2, w2 = _near(((fps >> np.uint64(23)) & mask).astype(np.int64), RADIUS + distance)
    over1, over2 = np.maximum(w1 - RADIUS, 0), np.maximum(w2 - RADIUS, 0)
    out = []
    # Pair the two blocks' code words by how far they are out of reach: all (e1, e2) with e1 + e2 <= distance.
    for e1 in range(distance + 1):
        a = over1 == e1
        ra, ca = r1[a], c1[a]
        for e2 in range(distance + 1 - e1):
            b = over2 == e2
            rb, cb = r2[b], c2[b]
            n = np.bincount(rb, minlength=len(fps))
            first = np.cumsum(n) - n
            count = n[ra]
            left = np.repeat(np.arange(len(ra)), count)
            at = np.repeat(first[ra] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            out.append((ra[left], ca[left] << 23 | cb[at], np.full(len(left), e1 == e2 == 0)))
    return tuple(np.concatenate(x) for x in zip(*out))


def links(nodes: DataFrame, distance: int = 2, slice_rows: int = 4096) -> DataFrame:
    """Pairs (u, v), u < v, of the distinct `fp` of `nodes` that differ in at most `distance` bits."""
    ship(nodes.sparkSession)
    if not 0 <= distance <= 4:
        raise ValueError("distance must be 0 to 4")

    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(fps), slice_rows):
                part = fps[i:i + slice_rows]
                row, anchor, home = anchors(part.view(np.uint64), distance)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part[row]), pa.array(home)], ["anchor", "fp", "home"])

    replicas = nodes.select("fp").mapInArrow(run, "anchor bigint, fp bigint, home boolean")
    homes = nodes.select("fp").mapInArrow(
        lambda batches: (b.filter(b.column(2)) for b in run(batches)), "anchor bigint, fp bigint, home boolean")
    a, b = homes.select("anchor", F.col("fp").alias("u")), replicas.select("anchor", F.col("fp").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    # Each pair is met from both ends, so one direction loses nothing.
    return a.hint("merge").join(b, "anchor").where((F.col("u") < F.col("v")) & near).select("u", "v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (u, v) with the smallest node it reaches."""

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = written(edges.select("u", "v").distinct(), "edges")
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: all larger neighbours point to the smallest neighbour (or the node itself).
        # Written, so that both sides of the join are plain shuffles and a hub's rows can be split.
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "large")
        # Small star: now u > v; the smaller neighbours and the node point to the smallest of them.
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(
            F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                             F.struct(F.col("u").alias("u"), F.col("m").alias("v")))))
        edges = written(small.where("u <> v").distinct(), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reached)."""
    marked, rooted = _rooted(docs, shingle, distance, id_col, text_col)
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = written(rooted.join(least, "root").select("fp", "component_id"), "classes")
    # Two plain shuffles of narrow rows: a fingerprint with a third of the rows is split adaptively.
    return marked.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _rooted(docs: DataFrame, shingle: int, distance: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows, and every distinct one's first id and the root of its component."""
    marked = written(fingerprints(docs, shingle, SEED, id_col, text_col), "fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    found = components(links(nodes, distance))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    return marked, written(rooted, "rooted")


def distinct_documents(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One document of each component, the one with the smallest id, columns as given.

    Unlike texts that share an id are decided each; of a component's rows with that id, the one with the smallest
    hash of its text stays, and of rows equal in id and text one. Rows with a null id can't be told apart and stay."""
    marked, rooted = _rooted(docs, shingle, distance, "doc_id", "text")
    best = marked.where("doc_id is not null").groupBy("fp").agg(F.min(F.struct("doc_id", "text_hash")).alias("best"))
    keep = written(rooted.join(best, "fp").groupBy("root").agg(F.min("best").alias("best")).select(
        F.col("best.doc_id").alias("__keep_id"), F.col("best.text_hash").alias("__keep_text")), "kept")
    own = (docs["doc_id"] == keep["__keep_id"]) & (F.xxhash64(docs["text"]) == keep["__keep_text"])
    kept = docs.join(keep, own).dropDuplicates(["__keep_id", "__keep_text"])
    return kept.select(*docs.columns).union(docs.where("doc_id is null"))
