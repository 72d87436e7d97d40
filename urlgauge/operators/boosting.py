"""Boosting on binned features, as Spark jobs over blocks of rows.

`blocks` turns a feature table into rows of one block each: a byte per feature and example, labels and weights. Each
round is one or a few jobs: tasks add up gradients per (node, feature, bin) of their own blocks, Spark sums them with one
`groupBy`, and the driver gets at most nodes x features x bins rows, whatever the table's size. What a task lost with its
executor had, it computes again: sampling depends on seed, round and block only.

`fit_additive`: one step function per feature, and then one per pair for the pairs that gain most. `fit_trees`: trees grown
best leaf first, with shares of rows and columns per round, watched on validation rows.
Rows with missing features are not allowed; the feature tables' contract rules them out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..plans import ordered, workers

BLOCK = 1 << 16     # examples in a block
STATE_ROUNDS = 25   # rounds after which the margins of all examples are written
_BLOCKS = "block long, bins binary, label binary, weight binary, margin binary"
_SUMS = "node int, feature int, bin int, gradient double, hessian double, rows long"


def thresholds(train: DataFrame, names: list[str], bins: int) -> dict[str, list[float]]:
    """At most `bins` - 1 cuts per feature at its exact quantiles; the largest value is no cut.

    Rows are counted per value before anything is ordered, and running totals of the counts are range partitioned,
    so a feature whose values never repeat is no single task's or the driver's work."""
    cells = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(n).cast("double").alias("value")) for i, n in enumerate(names)])
    with ordered.passing(train.sparkSession):
        values = train.select(F.inline(cells)).where(F.col("value").isNotNull() & ~F.isnan("value"))
        counts = ordered.cut(values.groupBy("feature", "value").agg(F.count("*").alias("rows")))
        totals = ordered.cut(counts.groupBy("feature").agg(F.sum("rows").alias("total")))
        placed = ordered.running_totals(counts, [F.col("value")], {"upto": "rows"}, ["feature"])
        # A quantile i / bins is the first value with at least i / bins of the rows up to it.
        cut = F.expr(f"upto < total and upto * {bins} div total > (upto - rows) * {bins} div total")
        found: dict[str, list[float]] = {n: [] for n in names}
        for r in placed.join(F.broadcast(totals), "feature").where(cut).select("feature", "value").collect():
            found[names[r["feature"]]].append(float(r["value"]))
    return {n: sorted(cuts) for n, cuts in found.items()}


def blocks(df: DataFrame, names: list[str], cuts: dict[str, list[float]]) -> DataFrame:
    """The table as written blocks: a row holds up to `BLOCK` examples of one partition."""
    workers.ship(df.sparkSession)
    edges = [np.array(cuts[n]) for n in names]

    def block(parts: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        flat = [part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(edges) + 2) for part in parts]
        *values, label, weight = np.ascontiguousarray(np.concatenate(flat).T)
        bins = np.stack([np.searchsorted(e, v, "left").astype(np.uint8) for e, v in zip(edges, values)])
        return pa.RecordBatch.from_arrays(
            [pa.array([number])] + [pa.array([x.tobytes()], pa.binary()) for x in (bins, label, weight, 0 * label)],
            ["block", "bins", "label", "weight", "margin"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows, at = [], 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                parts.append(batch.slice(start, BLOCK))
                rows += parts[-1].num_rows
                if rows >= BLOCK:
                    yield block(parts, at)
                    parts, rows, at = [], 0, at + 1
        if rows:
            yield block(parts, at)

    columns = [F.col(n).cast("double") for n in names] + [F.col("label").cast("double"), F.col("weight").cast("double")]
    # One array, as Arrow takes a column each over at a third of the speed.
    made = df.select(F.array(*columns).alias("values")).mapInArrow(make, _BLOCKS)
    # Partition and place in it number a block: sampling is by this number, so it must not change; hence the write.
    return ordered.cut(made.withColumn("block", F.spark_partition_id() * (1 << 20) + F.col("block")))


@dataclass
class Tree:
    """Nodes in the order they were made; node 0 is the root. `left` is 0 for a leaf, the right child follows the left one."""

    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float, children: list[tuple[float, int]]) -> int:
        """Bins up to `cut` go left. `children` are (value, rows). Returns the left child."""
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, len(self.left), gain
        for value, rows in children:
            for column, cell in ((self.feature, 0), (self.cut, 0), (self.left, 0), (self.value, value), (self.rows, rows), (self.gain, 0.0)):
                column.append(cell)
        return self.left[node]

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node every example ends in; children have larger numbers than their parents."""
        at = np.zeros(bins.shape[1], np.int32)
        for node, left in enumerate(self.left):
            if left:
                inside = np.flatnonzero(at == node)
                at[inside] = left + (bins[self.feature[node], inside] > self.cut[node])
        return at


def _examples(batch: pa.RecordBatch, features: int) -> Iterator[tuple]:
    """Number, bins, label, weight and margin of every block."""
    for number, bins, *rest in zip(*[batch.column(i) for i in range(5)]):
        label, weight, margin = (np.frombuffer(x.as_py(), np.float64) for x in rest)
        yield number.as_py(), np.frombuffer(bins.as_py(), np.uint8).reshape(features, -1), label, weight, margin


def _logistic(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-margin))


def _summed(parts: DataFrame, features: int, bins: int, cells: int | None = None) -> dict[int, np.ndarray]:
    """Spark's sums as arrays (3, features, bins): gradients, hessians, rows, by node."""
    found: dict[int, np.ndarray] = {}
    rows = parts.groupBy("node", "feature", "bin").agg(
        F.sum("gradient").alias("g"), F.sum("hessian").alias("h"), F.sum("rows").alias("n")).toArrow()
    node, feature, at, *sums = (rows.column(i).to_numpy() for i in range(6))
    for one in np.unique(node):
        own = node == one
        table = found.setdefault(int(one), np.zeros((3, features, bins)))
        for i, s in enumerate(sums):
            table[i, feature[own], at[own]] = s[own]
    return found


def _rows_of(tables: dict[int, np.ndarray]) -> pa.RecordBatch:
    """Non-empty cells of a task's own sums."""
    parts = []
    for node, table in tables.items():
        feature, at = np.nonzero(table[2])
        parts.append((np.full(len(at), node), feature, at, *(t[feature, at] for t in table)))
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0)] * 6
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype())) for c, k in zip(columns, kinds)],
                                      ["node", "feature", "bin", "gradient", "hessian", "rows"])


def _add(table: np.ndarray, at: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> None:
    """Add the examples' numbers to the cells `at` (features, examples) of `table`."""
    for i, own in enumerate(at):
        own = np.asarray(own, np.intp)  # once, as every count would widen it for itself
        for sums, weights in zip(table, (gradient, hessian, None)):
            sums[i] += np.bincount(own, weights, table.shape[2])


# The additive model

def two_cuts(gradient, hessian, rows, least: int, penalty: float) -> np.ndarray:
    """Newton steps of the best step function with at most two cuts, per bin. A side with fewer than `least` rows is no side."""
    sums = np.cumsum([gradient, hessian, rows], axis=1)
    size = sums.shape[1]

    def part(low, high):  # bins low..high-1
        total = sums[:, high - 1] - np.where(low > 0, sums[:, np.maximum(low, 1) - 1], 0)
        return total[0], total[1], total[2]

    def gain(low, high):
        g, h, n = part(low, high)
        return np.where((n >= least) | (low == high), g * g / (h + penalty), -np.inf)

    first, second = np.triu_indices(size)
    first, second = first + 1, second + 1  # cuts 1 <= first <= second <= size; equal or at the end: fewer cuts
    whole = np.zeros_like(first)
    with np.errstate(invalid="ignore"):
        gains = gain(whole, first) + np.where(second > first, gain(first, second), 0) + np.where(
            second < size, gain(second, np.full_like(second, size)), 0)
    best = int(np.argmax(np.where(np.isnan(gains), -np.inf, gains)))
    steps = np.zeros(size)
    bounds = [0, int(first[best]), int(second[best]), size]
    for low, high in zip(bounds, bounds[1:]):
        if high > low:
            g, h, _ = part(np.array(low), np.array(high))
            steps[low:high] = -g / (h + penalty)
    return steps


def four_parts(gradient, hessian, rows, least: int, penalty: float) -> tuple[float, np.ndarray]:
    """Gain and Newton steps of the best cut of each of two features, as four parts of a grid (a x b)."""
    total = [t.sum() for t in (gradient, hessian, rows)]
    sums = [np.cumsum(np.cumsum(t, 0), 1) for t in (gradient, hessian, rows)]
    a, b = gradient.shape
    if a < 2 or b < 2:
        return 0.0, np.zeros((a, b))
    corners = []
    for s, t in zip(sums, total):
        low = s[:-1, :-1]
        left, top = s[:-1, -1:], s[-1:, :-1]
        corners.append([low, left - low, top - low, t - left - top + low])
    gains = sum(np.where(n >= least, g * g / (h + penalty), -np.inf) for g, h, n in zip(*corners))
    best = np.unravel_index(int(np.argmax(gains)), gains.shape)
    if not np.isfinite(gains[best]):
        return 0.0, np.zeros((a, b))
    steps, (i, j) = np.zeros((a, b)), best
    for number, place in enumerate(((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, b)),
                                    (slice(i + 1, a), slice(0, j + 1)), (slice(i + 1, a), slice(j + 1, b)))):
        steps[place] = -corners[0][number][best] / (corners[1][number][best] + penalty)
    return float(gains[best] - total[0] ** 2 / (total[1] + penalty)), steps


def coarse_bins(counts: np.ndarray, most: int) -> np.ndarray:
    """For each bin the number of its coarse bin: at most `most`, near equal in rows, each a run of bins."""
    before = np.cumsum(counts) - counts
    return np.unique(np.minimum((before * most / max(1, counts.sum())).astype(int), most - 1), return_inverse=True)[1]


@dataclass
class AdditiveFit:
    """Scores by feature and bin, and by pair and coarse bins; `base` is the log odds without any term."""

    base: float
    main: np.ndarray
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_scores: list[np.ndarray]

    def margins(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(bins.shape[1], self.base)
        for scores, own in zip(self.main, bins):
            total += np.take(scores, own)  # twice as fast as indexing by bytes
        for (a, b), scores in zip(self.pairs, self.pair_scores):
            total += scores[self.coarse[a][bins[a]], self.coarse[b][bins[b]]]
        return total


def _additive_sums(data: DataFrame, fit: AdditiveFit, features: int, cells: int, pairs: list[tuple[int, int]] | None):
    """Sums per (feature, bin), or per (pair, cell) of `pairs`, at the margins of `fit`. One job."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((3, features if pairs is None else len(pairs), cells))
        for batch in batches:
            for _, bins, label, weight, _ in _examples(batch, features):
                chance = _logistic(fit.margins(bins))
                gradient, hessian = weight * (chance - label), weight * chance * (1 - chance)
                _add(table, bins if pairs is None else _cells(fit, bins, pairs), gradient, hessian)
        yield _rows_of({0: table})

    return _summed(data.mapInArrow(sums, _SUMS), features if pairs is None else len(pairs), cells).get(
        0, np.zeros((3, features if pairs is None else len(pairs), cells)))


def _cells(fit: AdditiveFit, bins: np.ndarray, pairs: list[tuple[int, int]]) -> Iterator[np.ndarray]:
    for a, b in pairs:
        yield fit.coarse[a][bins[a]] * (int(fit.coarse[b].max(initial=0)) + 1) + fit.coarse[b][bins[b]]


def fit_additive(train: DataFrame, names: list[str], rounds: int = 1000, rate: float = 0.03, least: int = 20,
                 bins: int = 128, pairs: int = 10, pair_bins: int = 16, penalty: float = 1.0):
    """(cuts per feature, AdditiveFit): `rounds` of main steps, then the best `pairs` and `rounds` of their steps.

    In a round all features step from the same residuals, each by `rate` of its own best step function, so a round is one
    job instead of one per feature."""
    cuts = thresholds(train, names, bins)
    with ordered.passing(train.sparkSession):
        data = blocks(train, names, cuts)
        size = max(len(c) for c in cuts.values()) + 1
        fit = AdditiveFit(0.0, np.zeros((len(names), size)), [], [], [])
        sums = _additive_sums(data, fit, len(names), size, None)
        rows = sums[2]
        half = sums[1, 0].sum() * 4, sums[0, 0].sum()  # total weight; gradient at chance 1/2 is weight / 2 - weight of class 1
        share = min(max(0.5 - half[1] / half[0], 1e-6), 1 - 1e-6) if half[0] else 0.5
        fit.base = float(np.log(share / (1 - share)))
        used = [len(cuts[n]) + 1 for n in names]
        for _ in range(rounds):
            sums = _additive_sums(data, fit, len(names), size, None)
            for i, count in enumerate(used):
                if count > 1:
                    fit.main[i, :count] += rate * two_cuts(*sums[:, i, :count], least, penalty)
        fit.coarse = [coarse_bins(rows[i, :count], pair_bins) for i, count in enumerate(used)]
        wide = [int(c.max(initial=0)) + 1 for c in fit.coarse]
        every = [p for p in combinations(range(len(names)), 2) if min(wide[p[0]], wide[p[1]]) > 1]
        if pairs and every:
            found = _additive_sums(data, fit, len(names), max(wide) ** 2, every)
            gains = [four_parts(*(t[:wide[a] * wide[b]].reshape(wide[a], wide[b]) for t in found[:, i]), least, penalty)[0]
                     for i, (a, b) in enumerate(every)]
            chosen = [every[i] for i in sorted(range(len(every)), key=lambda i: (-gains[i], i))[:pairs]]
            fit.pairs, fit.pair_scores = chosen, [np.zeros((wide[a], wide[b])) for a, b in chosen]
            for _ in range(rounds):
                found = _additive_sums(data, fit, len(names), max(wide) ** 2, chosen)
                for i, (a, b) in enumerate(chosen):
                    fit.pair_scores[i] += rate * four_parts(
                        *(t[:wide[a] * wide[b]].reshape(wide[a], wide[b]) for t in found[:, i]), least, penalty)[1]
    return cuts, fit


# Trees

@dataclass
class TreeSettings:
    rounds: int = 1500
    rate: float = 0.05
    leaves: int = 31
    least: int = 50
    row_share: float = 0.9
    column_share: float = 0.9
    patience: int = 100
    bins: int = 255
    penalty: float = 1.0
    seed: int = 42


@dataclass
class Split:
    gain: float
    feature: int
    cut: int
    children: list[tuple[float, int]]


def best_split(table: np.ndarray, columns: np.ndarray, settings: TreeSettings) -> Split | None:
    """The split of a node that gains most; ties go to the first feature and the lowest cut."""
    left = np.cumsum(table[:, columns], axis=2)[:, :, :-1]
    total = table[:, columns[0]].sum(axis=1)
    right = total[:, None, None] - left
    score = sum(g * g / (h + settings.penalty) for g, h, _ in (left, right))
    gains = np.where((left[2] >= settings.least) & (right[2] >= settings.least),
                     score - total[0] ** 2 / (total[1] + settings.penalty), -np.inf)
    if not gains.size or not gains.max() > 1e-9:
        return None
    # Sums come in any order, so equal gains may differ in their last digits: the first within them is taken.
    feature, cut = np.unravel_index(int(np.flatnonzero(gains.ravel() >= gains.max() * (1 - 1e-9))[0]), gains.shape)
    sides = [left[:, feature, cut], right[:, feature, cut]]
    return Split(float(gains[feature, cut]), int(columns[feature]), int(cut),
                 [(float(-settings.rate * s[0] / (s[1] + settings.penalty)), int(s[2])) for s in sides])


@dataclass
class TreeFit:
    cuts: dict[str, list[float]]
    base: float
    trees: list[Tree]          # up to the best round
    losses: list[float]        # validation log loss after every round that was fitted
    best_round: int


def _with_margins(data: DataFrame, trees: list[Tree], features: int) -> DataFrame:
    """The blocks with `trees` added to their margins, written."""
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (_, bins, _, _, margin) in enumerate(_examples(batch, features)):
                margin = _moved(margin, bins, trees)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, 1) for c in range(4)] + [pa.array([margin.tobytes()], pa.binary())],
                    batch.schema.names)

    return ordered.cut(data.mapInArrow(move, data.schema))


def _moved(margin: np.ndarray, bins: np.ndarray, trees: list[Tree]) -> np.ndarray:
    for tree in trees:
        margin = margin + np.array(tree.value)[tree.leaves(bins)]
    return margin


def _node_sums(data: DataFrame, validation: DataFrame | None, features: int, size: int, trees: list[Tree], tree: Tree,
               nodes: list[int], number: int, settings: TreeSettings) -> tuple[dict[int, np.ndarray], float | None]:
    """Sums of the `nodes` of the tree that grows, and the validation loss before it. One job."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {n: np.zeros((3, features, size)) for n in nodes}
        for batch in batches:
            for block, bins, label, weight, margin in _examples(batch, features):
                chance = _logistic(_moved(margin, bins, trees))
                gradient, hessian = weight * (chance - label), weight * chance * (1 - chance)
                taken = np.random.default_rng((settings.seed, number, block)).random(len(label)) < settings.row_share
                at = np.where(taken, tree.leaves(bins), -1)
                for n, table in tables.items():
                    own = np.flatnonzero(at == n)
                    _add(table, bins[:, own], gradient[own], hessian[own])
        yield _rows_of(tables)

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, rows = 0.0, 0
        for batch in batches:
            for _, bins, label, weight, margin in _examples(batch, features):
                signed = np.where(label > 0, 1, -1) * _moved(margin, bins, trees)
                loss, rows = loss + float((weight * np.logaddexp(0, -signed)).sum()), rows + len(label)
        table = np.zeros((3, 1, 1))
        table[:, 0, 0] = loss, 0, rows
        yield _rows_of({-1: table})

    parts = data.mapInArrow(sums, _SUMS)
    if validation is not None:
        parts = parts.unionByName(validation.mapInArrow(losses, _SUMS))
    found = _summed(parts, features, size)
    held = found.pop(-1, None)
    empty = np.zeros((3, features, size))
    return {n: found.get(n, empty) for n in nodes}, None if held is None else float(held[0, 0, 0] / held[2, 0, 0])


def grow(sums: Callable[[Tree, list[int]], dict[int, np.ndarray]], columns: np.ndarray, settings: TreeSettings,
         root: np.ndarray) -> Tree:
    """A tree grown best leaf first. `sums` gives the sums of some leaves of a tree.

    The leaf with the largest gain is split until there are `leaves`. To save jobs, the sums below all leaves that may be chosen
    soon are asked for together: the tree is split there on trial, and splits that aren't chosen are left out in the end. Of two
    children only the smaller one is summed; the other is the rest of its parent."""
    trial, tree = Tree(), Tree()
    tree.rows[0] = int(root[2, columns[0]].sum())
    tables, splits = {0: root}, {0: best_split(root, columns, settings)}
    below: dict[int, int] = {}          # left child on trial
    place, open_leaves = {0: 0}, [0]    # nodes on trial and in the tree
    while len(open_leaves) < settings.leaves:
        able = sorted((n for n in open_leaves if splits[n]), key=lambda n: (-splits[n].gain, place[n]))
        if not able:
            break
        best = able[0]
        if best not in below:
            smaller = {}
            for n in [n for n in able if n not in below][:settings.leaves - len(open_leaves)]:
                s = splits[n]
                below[n] = trial.split(n, s.feature, s.cut, s.gain, s.children)
                smaller[n] = below[n] + (s.children[1][1] < s.children[0][1])
            found = sums(trial, list(smaller.values()))
            for n, small in smaller.items():
                other = 2 * below[n] + 1 - small
                tables[small], tables[other] = found[small], tables[n] - found[small]
                for child in (small, other):
                    splits[child] = best_split(tables[child], columns, settings)
        s = splits[best]
        left = tree.split(place[best], s.feature, s.cut, s.gain, s.children)
        open_leaves.remove(best)
        for i in (0, 1):
            place[below[best] + i] = left + i
            open_leaves.append(below[best] + i)
    return tree


def fit_trees(train: DataFrame, validation: DataFrame, names: list[str], settings: TreeSettings) -> TreeFit:
    """Rounds until the validation log loss hasn't improved for `patience` rounds; the ensemble ends at its best round."""
    cuts = thresholds(train, names, settings.bins)
    size, features = max(len(c) for c in cuts.values()) + 1, len(names)
    with ordered.passing(train.sparkSession):
        data = blocks(train, names, cuts)
        held = blocks(validation.withColumn("weight", F.lit(1.0)), names, cuts)
        start = _additive_sums(data, AdditiveFit(0.0, np.zeros((features, size)), [], [], []), features, size, None)
        weight = 4 * start[1, 0].sum()
        share = min(max(0.5 - start[0, 0].sum() / weight, 1e-6), 1 - 1e-6) if weight else 0.5
        base = float(np.log(share / (1 - share)))
        first = Tree()
        first.value[0] = base
        trees, recent, losses, best = [], [first], [], (float("inf"), 0)
        rng = np.random.default_rng(settings.seed)
        for number in range(settings.rounds + 1):
            columns = np.sort(rng.choice(features, max(1, round(settings.column_share * features)), replace=False))
            if len(recent) > STATE_ROUNDS:
                moved = [_with_margins(d, recent, features) for d in (data, held)]
                ordered.forget(data)
                ordered.forget(held)
                (data, held), recent = moved, []
            found, loss = _node_sums(data, held, features, size, recent, Tree(), [0], number, settings)
            if number and loss is not None:
                losses.append(loss)
                best = min(best, (loss, number))
                if number - best[1] >= settings.patience:
                    break
            if number == settings.rounds:
                break
            tree = grow(lambda t, n: _node_sums(data, None, features, size, recent, t, n, number, settings)[0],
                        columns, settings, found[0])
            trees.append(tree)
            recent.append(tree)
    kept = best[1] if losses else len(trees)
    return TreeFit(cuts, base, trees[:kept], losses, kept)
