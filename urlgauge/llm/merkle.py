"""Merkle manifest of a dataset, and inclusion proofs by a recursive climb.

A row's leaf is the SHA-256 of its fields, each `-` if null, else its length in UTF-8 bytes, a colon and
its value. The leaves of a source, ascending by doc_id, are hashed in runs of `FAN` until one node is
left, the source's subroot; the subroots, ordered by source, likewise give the root.

1. Leaves are numbered per source by sampled ranges of the whole order key, so a hot source spans
   partitions, and written. Every level is one aggregation into runs of at most `FAN` digests.
2. The levels are stored as node rows (`node`, `parent`, `place` among the parent's `children`, `digest`). A
   source's subroot is linked to the tree of sources, `TOP`.
3. `climb` is a recursive query over those rows. The leaves of one run ascend side by side, in one row: each
   step meets the parent's row, appends the siblings there (the same for all of them) and folds
   every leaf's presented digest with them, until a row has no parent. A row thus holds `FAN`
   leaves and their common path, whatever the data's size. Near the root all rows meet the same few parents: Spark
   broadcasts node rows while the table is small by its file size, and beyond that adaptive execution splits the key.

Defined cases: a null source is a source of its own, before all others. Null ids come first in their source; rows that
agree in id are ordered by leaf, and rows that agree in everything are leaves of their own. A single leaf is its
source's subroot, a single subroot is the root, and a proof without siblings is the digest of nothing. An empty table has
no root and no proofs. Columns beyond the five fields are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.ordered import number_rows
from .common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
TOP = "^"  # the tree of sources; the other trees are named "-" (null) or "=" and the source


@dataclass
class Manifest:
    """`leaves`: tree, number, doc_id, digest, claim, total. `nodes`: node, parent, place, tree, digest, children."""

    leaves: DataFrame
    nodes: DataFrame


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """The leaf of a row of documents, with some fields replaced."""
    return F.sha2(F.concat(*[_field(changed.get(f, F.col(f))) for f in FIELDS]), 256)


def _name(tree, level, number) -> Column:
    return F.concat_ws(":", tree, level.cast("string"), number.cast("string"))


def _levels(nodes: DataFrame, most: int, name: str) -> DataFrame | None:
    """All nodes above `nodes` (tree, number, digest, total in its level), whose largest tree has `most`."""
    levels, level = [], 0
    while most > 1:
        most, level = -(-most // FAN), level + 1
        run = F.array_sort(F.collect_list(F.struct("number", "digest")))
        runs = nodes.where("total > 1").groupBy("tree", F.expr(f"number div {FAN}").alias("number")).agg(
            run["digest"].alias("children"), F.expr(f"(max(total) + {FAN - 1}) div {FAN}").alias("total"))
        nodes = written(runs.select(
            "tree", F.lit(level).alias("level"), "number", "children", "total",
            F.sha2(F.concat_ws("", "children"), 256).alias("digest")), f"{name}-level")
        levels.append(nodes)
    if not levels:
        return None
    above = levels[0]
    for nodes in levels[1:]:
        above = above.unionByName(nodes)
    return above


def _linked(nodes: DataFrame, ranks: DataFrame | None) -> DataFrame:
    """`nodes` with their names and those of their parents; subroots hang in the tree of sources by rank."""
    up = F.when(F.col("total") > 1, _name(F.col("tree"), F.col("level") + 1, F.expr(f"number div {FAN}")))
    place = F.when(F.col("total") > 1, F.col("number") % FAN)
    if ranks is not None:
        nodes = nodes.join(ranks, "tree", "left")
        hung = (F.col("total") == 1) & F.col("rank").isNotNull()
        up = F.when(hung, _name(F.lit(TOP), F.lit(1), F.expr(f"rank div {FAN}"))).otherwise(up)
        place = F.when(hung, F.col("rank") % FAN).otherwise(place)
    return nodes.withColumns({
        "node": _name(F.col("tree"), F.col("level"), F.col("number")), "parent": up, "place": place.cast("int")})


def build(docs: DataFrame, presented: Column | None = None) -> Manifest:
    """The manifest of `docs`. `presented` is the digest that a row shows when it is verified; its leaf if not given."""
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    rows = docs.select(tree.alias("tree"), "doc_id", leaf_digest().alias("digest"),
                       (presented if presented is not None else F.lit(None).cast("string")).alias("claim"))
    numbered = written(number_rows(rows, [F.col("doc_id").asc_nulls_first(), "digest"], "number", within=["tree"])
                       .withColumn("number", F.col("number") - 1), "merkle-numbers")
    totals = written(numbered.groupBy("tree").agg(F.count("*").alias("total")), "merkle-totals")
    leaves = numbered.join(totals, "tree")
    most = totals.agg(F.max("total"), F.count("*")).first()
    inner = _levels(leaves.select("tree", "number", "digest", "total"), most[0] or 0, "merkle")
    lone = leaves.where("total = 1").select("tree", F.lit(0).alias("level"), "number", "digest", "total",
                                            F.array().cast("array<string>").alias("children"))
    nodes = lone if inner is None else inner.unionByName(lone)
    ranks = top = None
    if most[1] > 1:
        subroots = nodes.where("total = 1").select("tree", "digest")
        ranks = written(number_rows(subroots, ["tree"], "rank").withColumn("rank", F.col("rank") - 1), "merkle-ranks")
        top = _levels(ranks.select(F.lit(TOP).alias("tree"), F.col("rank").alias("number"), "digest",
                                   F.lit(most[1]).cast("long").alias("total")), most[1], "merkle-top")
        ranks = ranks.select("tree", "rank")
    columns = ["node", "parent", "place", "tree", "digest", "children"]
    linked = _linked(nodes, ranks).select(columns)
    if top is not None:
        linked = linked.unionByName(_linked(top, None).select(columns))
    return Manifest(leaves, written(linked, "merkle-nodes"))


#: `climb` starts with a row for each run of leaves, already folded into the run's node, or for a leaf that is a subroot.
#: The siblings it carries are bytes, half as long as the digests' text.
CLIMB = """
with recursive climb(run, folds, above, subroot, root, parent, place) as (
  select node, folds, above, subroot, digest, parent, place from {starts}
  union all
  select c.run,
         transform(c.folds, f -> sha2(concat(array_join(slice(n.children, 1, c.place), ''), f,
           array_join(slice(n.children, c.place + 2, {fan}), '')), 256)),
         concat(c.above, unhex(array_join(slice(n.children, 1, c.place), '')),
           unhex(array_join(slice(n.children, c.place + 2, {fan}), ''))),
         coalesce(c.subroot, if(n.tree = {top}, element_at(n.children, c.place + 1), cast(null as string))),
         n.digest, n.parent, n.place
  from climb c join {nodes} n on c.parent = n.node)
select run, folds, above, coalesce(subroot, root) as subroot, root from climb where parent is null"""


def _starts(manifest: Manifest) -> DataFrame:
    """Runs of leaves at their own node: `leaves` (doc_id, leaf), and `folds`, each leaf's presented digest folded into the run."""
    rows = manifest.leaves
    node = F.when(F.col("total") > 1, _name(F.col("tree"), F.lit(1), F.expr(f"number div {FAN}"))).otherwise(
        _name(F.col("tree"), F.lit(0), F.col("number")))
    packs = rows.groupBy(node.alias("node")).agg(
        F.array_sort(F.collect_list(F.struct("number", "doc_id", "digest", "claim"))).alias("run"))
    packs = packs.withColumn("own", F.col("run.digest"))

    def folded(row: Column, at: Column) -> Column:
        others = (F.concat_ws("", F.slice("own", 1, at)), F.concat_ws("", F.slice("own", at + 2, FAN)))
        shown = F.coalesce(row["claim"], row["digest"])
        return F.when(F.size("children") > 0, F.sha2(F.concat(others[0], shown, others[1]), 256)).otherwise(shown)

    met = packs.join(manifest.nodes, "node")
    leaves = F.transform("run", lambda row: F.struct(row["doc_id"].alias("doc_id"), row["digest"].alias("leaf")))
    return met.select("node", leaves.alias("leaves"), F.transform("run", folded).alias("folds"), F.lit(b"").alias("above"),
                      F.lit(None).cast("string").alias("subroot"), "digest", "parent", "place")


def climb(manifest: Manifest) -> DataFrame:
    """One row per run of leaves, at the root: its `leaves` (doc_id, leaf) and their `folds`, the siblings `above` the run
    as bytes, subroot, root."""
    spark = manifest.nodes.sparkSession
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    starts = written(_starts(manifest), "merkle-starts")
    spark.conf.set(limit, "-1")  # the climb has a row per run and level, however many there are
    try:
        at_root = written(spark.sql(CLIMB.replace("{fan}", str(FAN)).replace("{top}", f"'{TOP}'"),
                                    starts=starts, nodes=manifest.nodes), "merkle-climb")
    finally:
        spark.conf.set(limit, before)
    return at_root.join(starts.select(F.col("node").alias("run"), "leaves"), "run")


def verify(docs: DataFrame, presented: Column | None = None) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    at_root = climb(build(docs, presented)).withColumn("digests", F.col("leaves.leaf"))
    own = F.concat(F.array_join(F.slice("digests", 1, F.col("at")), ""),
                   F.array_join(F.slice("digests", F.col("at") + 2, FAN), ""))
    return at_root.select("*", F.posexplode(F.arrays_zip("leaves", "folds")).alias("at", "l")).select(
        "l.leaves.doc_id", "l.leaves.leaf", "subroot", "root",
        F.sha2(F.concat(own, F.lower(F.hex("above"))), 256).alias("proof_sha256"),
        F.col("l.folds").alias("folded_root"), (F.col("l.folds") == F.col("root")).alias("verified"))
