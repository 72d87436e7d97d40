"""Boosting against plain versions on small tables; contributions against all coalitions."""

from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from urlgauge.catalog import learning_queries
from urlgauge.operators import boosting, ensembles, explain, models
from urlgauge.operators.boosting import Tree, TreeSettings

NAMES = ["a", "b", "c"]


def sample(rows=600, seed=1, flip=0.1):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 9, rows), rng.integers(0, 2, rows), np.round(rng.random(rows), 2)]).astype(float)
    y = ((x[0] > 4) ^ (x[1] > 0) ^ (rng.random(rows) < flip)).astype(float)
    return x, y, 1 + rng.integers(0, 3, rows).astype(float)


def frame(spark, x, y, w):
    return spark.createDataFrame(pd.DataFrame({**dict(zip(NAMES, x)), "label": y.astype(int), "weight": w})).repartition(3)


def binned(x, cuts):
    return np.stack([np.searchsorted(np.array(cuts[n]), v, "left") for n, v in zip(NAMES, x)])


def plain_steps(g, h, n, least, penalty):
    """The best step function of at most two cuts, by trying all of them."""
    best = (-1.0, None)
    size = len(g)
    for count in (0, 1, 2):
        for cut in combinations(range(1, size), count):
            parts = [slice(a, b) for a, b in zip((0, *cut), (*cut, size))]
            if count and min(n[p].sum() for p in parts) < least:
                continue
            gain = sum(g[p].sum() ** 2 / (h[p].sum() + penalty) for p in parts)
            if gain > best[0] * (1 + 1e-12):
                best = gain, parts
    steps = np.zeros(size)
    for p in best[1]:
        steps[p] = -g[p].sum() / (h[p].sum() + penalty)
    return best[0], steps


def test_cuts_are_exact_quantiles(spark):
    """Also beyond the rows at which a sketch begins to approximate; null and NaN are no values."""
    rng = np.random.default_rng(4)
    x = [rng.permutation(120_000).astype(float), rng.integers(0, 5, 120_000).astype(float), np.zeros(120_000)]
    x[1][:3], rows = np.nan, 120_000
    df = spark.createDataFrame(pd.DataFrame(dict(zip(NAMES, x)))).repartition(5)
    cuts = boosting.thresholds(df.unionByName(df.limit(1).withColumns({n: F.lit(None).cast("double") for n in NAMES})), NAMES, 128)
    assert cuts["a"] == [-(-i * rows // 128) - 1.0 for i in range(1, 128)]
    assert cuts["b"] == [0.0, 1.0, 2.0, 3.0] and cuts["c"] == []


def test_steps_are_the_best(spark):
    rng = np.random.default_rng(2)
    for _ in range(30):
        size = rng.integers(1, 9)
        g, h, n = rng.normal(size=size), rng.random(size) + 0.1, rng.integers(0, 30, size).astype(float)
        gain, steps = plain_steps(g, h, n, 20, 1.0)
        found = boosting.two_cuts(g, h, n, 20, 1.0)
        got = sum(g[found == v].sum() ** 2 / (h[found == v].sum() + 1.0) for v in np.unique(found))
        if n.sum() >= 20:
            assert got == pytest.approx(gain) and found == pytest.approx(steps)


def test_additive_rounds_equal_a_plain_loop(spark):
    x, y, w = sample()
    cuts, fit = boosting.fit_additive(frame(spark, x, y, w), NAMES, rounds=4, rate=0.3, least=20, bins=16, pairs=2, pair_bins=4)
    bins = binned(x, cuts)
    share = (w * y).sum() / w.sum()
    margin = np.full(len(y), np.log(share / (1 - share)))
    assert fit.base == pytest.approx(margin[0])
    main = [np.zeros(len(cuts[n]) + 1) for n in NAMES]

    def sums(cell, size):
        p = 1 / (1 + np.exp(-margin))
        return [np.bincount(cell, t, size) for t in (w * (p - y), w * p * (1 - p), np.ones_like(y))]

    for _ in range(4):
        steps = [0.3 * plain_steps(*sums(b, len(m)), 20, 1.0)[1] for b, m in zip(bins, main)]
        for m, s, b in zip(main, steps, bins):
            m += s
        margin = margin + sum(s[b] for s, b in zip(steps, bins))
    for i, m in enumerate(main):
        assert fit.main[i, :len(m)] == pytest.approx(m, abs=1e-9)
    assert fit.pairs[0] == (0, 1) and len(fit.pairs) == 2  # the label is their exclusive or
    coarse = [c[b] for c, b in zip(fit.coarse, bins)]
    assert all(c.max() < 4 for c in fit.coarse)
    gains = {}
    for a, b in combinations(range(3), 2):
        wide = coarse[b].max() + 1
        g, h, n = (t.reshape(-1, wide) for t in sums(coarse[a] * wide + coarse[b], (coarse[a].max() + 1) * wide))
        best = 0.0
        for i in range(1, g.shape[0]):
            for j in range(1, wide):
                parts = [(s, t) for s in (slice(0, i), slice(i, None)) for t in (slice(0, j), slice(j, None))]
                if min(n[p].sum() for p in parts) >= 20:
                    best = max(best, sum(g[p].sum() ** 2 / (h[p].sum() + 1) for p in parts) - g.sum() ** 2 / (h.sum() + 1))
        gains[a, b] = best
    assert fit.pairs == sorted(gains, key=lambda p: -gains[p])[:2]


def test_additive_model_serves_what_was_fitted(spark):
    x, y, w = sample()
    train = frame(spark, x, y, w)
    cuts, fit = boosting.fit_additive(train, NAMES, rounds=3, rate=0.3, bins=16, pairs=2, pair_bins=4)
    wanted = 1 / (1 + np.exp(-fit.margins(binned(x, cuts))))
    rows = spark.createDataFrame(pd.DataFrame({**dict(zip(NAMES, x)), "wanted": wanted, "weight": w}))
    model = ensembles.additive(spark, fit, [cuts[n] for n in NAMES])
    scored = models._loaded(NAMES, model).transform(rows)
    assert scored.where(F.abs(vector_to_array("probability")[1] - F.col("wanted")) > 1e-12).count() == 0
    shapes = explain.centred(explain.from_fit(models.Fitted("additive", NAMES, extra={"cuts": cuts, "fit": fit})), rows)
    terms = explain.with_terms(rows.withColumn("a", F.col("a").cast("int")), shapes)
    total = F.lit(shapes.base)
    for i in range(len(shapes.terms)):
        total = total + F.col(f"t_{i}")
    assert terms.where(F.abs(1 / (1 + F.exp(-total)) - F.col("wanted")) > 1e-9).count() == 0
    table = explain.shape_table(spark, shapes)
    assert table.count() == sum(c.size for _, c in shapes.terms)


def test_plans_do_not_grow_with_bins(spark):
    rows = spark.range(3).select(F.col("id").cast("int").alias("a"))

    def size(bins):
        model = explain.Additive(["a"], {"a": [float(i) for i in range(bins - 1)]}, [(("a",), np.arange(float(bins)))], 0.0)
        return len(explain.with_terms(rows, model)._jdf.queryExecution().toString())

    assert abs(size(4) - size(4000)) < 200


def plain_tree(bins, g, h, taken, columns, settings):
    """Best leaf first, one leaf at a time, over all rows."""
    tree, at, open_leaves = Tree(), np.where(taken, 0, -1), [0]
    tree.rows[0] = int(taken.sum())

    def best(node):
        inside = at == node
        table = np.stack([np.stack([np.bincount(b[inside], t[inside], 64) for b in bins]) for t in (g, h, np.ones_like(g))])
        return boosting.best_split(table, columns, settings)

    splits = {0: best(0)}
    while len(open_leaves) < settings.leaves:
        able = [n for n in open_leaves if splits[n]]
        if not able:
            break
        node = max(able, key=lambda n: (splits[n].gain, -n))
        s = splits[node]
        left = tree.split(node, s.feature, s.cut, s.gain, s.children)
        at = np.where(at == node, left + (bins[s.feature] > s.cut), at)
        open_leaves.remove(node)
        for child in (left, left + 1):
            open_leaves.append(child)
            splits[child] = best(child)
    return tree


def test_trees_equal_a_plain_loop(spark):
    x, y, w = sample(900, 5, 0.2)
    settings = TreeSettings(rounds=3, rate=0.3, leaves=6, least=20, row_share=1.0, column_share=1.0, bins=16, patience=5)
    train = frame(spark, x, y, w)
    fit = boosting.fit_trees(train, train, NAMES, settings)
    bins = binned(x, fit.cuts)
    margin = np.full(len(y), fit.base)
    for number, tree in enumerate(fit.trees):
        p = 1 / (1 + np.exp(-margin))
        plain = plain_tree(bins, w * (p - y), w * p * (1 - p), np.ones(len(y), bool), np.arange(3), settings)
        assert (plain.feature, plain.cut, plain.left, plain.rows) == (tree.feature, tree.cut, tree.left, tree.rows)
        assert plain.value == pytest.approx(tree.value)
        margin = margin + np.array(plain.value)[plain.leaves(bins)]
        assert fit.losses[number] == pytest.approx(np.logaddexp(0, -np.where(y > 0, 1, -1) * margin).mean())
    again = boosting.fit_trees(train, train, NAMES, settings)
    assert [t.left for t in again.trees] == [t.left for t in fit.trees]
    model = models._loaded(NAMES, ensembles.boosted(spark, fit, NAMES))
    rows = spark.createDataFrame(pd.DataFrame({**dict(zip(NAMES, x)), "wanted": 1 / (1 + np.exp(-margin))}))
    assert model.transform(rows).where(F.abs(vector_to_array("probability")[1] - F.col("wanted")) > 1e-12).count() == 0


def test_the_ensemble_ends_at_its_best_round(spark, monkeypatch):
    """Validation labels are mostly the opposite, so the loss soon rises; waiting ends after `patience` rounds."""
    monkeypatch.setattr(boosting, "STATE_ROUNDS", 2)  # margins are written on the way, too
    x, y, w = sample(600, 3, 0.05)
    valid = frame(spark, x, np.where(np.arange(len(y)) % 10 < 6, 1 - y, y), w)
    settings = TreeSettings(rounds=30, rate=0.5, leaves=4, least=20, patience=3, bins=16)
    fit = boosting.fit_trees(frame(spark, x, y, w), valid, NAMES, settings)
    assert fit.best_round == 1 + int(np.argmin(fit.losses)) == len(fit.trees)
    assert len(fit.losses) == fit.best_round + 3 < 30
    assert min(fit.losses[fit.best_round:]) >= fit.losses[fit.best_round - 1]


def test_contributions_are_shapley_values():
    """Random trees of depth three against all coalitions."""
    rng = np.random.default_rng(7)
    trees = {}
    for number in range(5):
        nodes, todo = {}, [(0, 0, 64.0)]
        while todo:
            node, depth, rows = todo.pop()
            leaf = depth == 3 or rng.random() < 0.15 and depth > 0
            first = float(rng.integers(1, int(rows))) if rows > 1 else 1.0
            leaf = leaf or rows < 2
            nodes[node] = (-1, -1, -1, 0.0, rng.normal(), rows) if leaf else (
                2 * node + 1, 2 * node + 2, int(rng.integers(0, 4)), float(rng.random()), 0.0, rows)
            if not leaf:
                todo += [(2 * node + 1, depth + 1, first), (2 * node + 2, depth + 1, rows - first)]
        trees[number] = nodes
    weights, x = [1.0, 0.5, 2.0, 1.0, 0.25], rng.random((40, 4))

    def value(nodes, row, known, node=0):
        left, right, feature, cut, prediction, rows = nodes[node]
        if left < 0:
            return prediction
        if feature in known:
            return value(nodes, row, known, left if row[feature] <= cut else right)
        return sum(nodes[c][5] / rows * value(nodes, row, known, c) for c in (left, right))

    got = explain.shapley(x, explain.paths(trees, weights))
    for row, given in zip(x, got):
        for f in range(4):
            others = [o for o in range(4) if o != f]
            wanted = sum(factorial(k) * factorial(3 - k) / factorial(4) * 2 * weights[t] * (
                value(nodes, row, {*known, f}) - value(nodes, row, set(known)))
                for t, nodes in trees.items() for k in range(4) for known in combinations(others, k))
            assert given[f] == pytest.approx(wanted, abs=1e-12)


def test_one_class_or_one_value_still_fits(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 3.0, 1, 1.0)] * 5, "a double, b double, c double, label int, weight double")
    cuts, fit = boosting.fit_additive(rows, NAMES, rounds=2)
    assert all(not c for c in cuts.values()) and fit.pairs == [] and np.isfinite(fit.base)
    trees = boosting.fit_trees(rows, rows, NAMES, TreeSettings(rounds=3, patience=2))
    assert all(len(t.left) == 1 for t in trees.trees) and np.isfinite(trees.losses).all()


def test_cells_are_found_by_column_functions_only(spark):
    """The model's arrays were joined to every row before, and copied with it by each operator."""
    rows = spark.createDataFrame([(1, 0.5, 2.0), (None, None, 1.0), (9, float("nan"), 1.0), (-3, 0.1, 4.0)], "a int, b double, weight double")
    model = explain.Additive(["a", "b"], {"a": [0.5, 2.5], "b": [0.2, 0.5, 0.7]}, [
        (("a",), np.array([-1.0, 2.0, 3.0])), (("b",), np.arange(4.0)), (("a", "b"), np.arange(12.0).reshape(3, 4))], 0.0)
    terms = explain.with_terms(rows, model)
    assert "Join" not in terms._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r)[3:] for r in terms.collect()] == [(2.0, 1.0, 5.0), (-1.0, 0.0, 0.0), (3.0, 3.0, 11.0), (-1.0, 0.0, 0.0)]
    totals = {(r["index"], r["cell"]): (r["rows"], r["weight"]) for r in explain.cell_totals(rows, model, "weight").collect()}
    assert totals == {(0, 0): (2, 5.0), (0, 1): (1, 2.0), (0, 2): (1, 1.0), (1, 0): (2, 5.0), (1, 1): (1, 2.0), (1, 3): (1, 1.0),
                      (2, 0): (2, 5.0), (2, 5): (1, 2.0), (2, 11): (1, 1.0)}
    means = {r["term"]: r["importance"] for r in explain.term_importance(rows, model).collect()}
    assert means == {"a": (2 * 2 + 3 + 5) / 8, "b": (2 + 3) / 8, "a & b": (2 * 5 + 11) / 8}
    assert explain.centred(model, rows).base == pytest.approx((2 * 2 + 3 - 5) / 8 + 5 / 8 + 21 / 8)
    assert [r["rows"] for r in explain.shape_rows(rows.limit(0), model).collect()] == [0] * 19


def test_models_with_the_same_inputs_share_their_vector(spark, sf_dir):
    """An assembler made a row's vector anew for every model."""
    fits = [learning_queries.fixed_fit(spark, n) for n in ("full", "without_https", "hyphens")]
    rows = learning_queries.url_rows(spark, sf_dir).limit(500)
    scored = models.score_all(fits, rows, ["l_orderkey"])
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("UDF(struct(") == 1
    alone = [models.score(f, rows, ["l_orderkey"]) for f in fits]
    assert sorted(map(tuple, scored.collect())) == sorted(tuple(r) for a in alone for r in a.collect())


def test_a_round_trip_shuffles_no_rows(spark, sf_dir):
    """Scores of a row were long rows, grouped by five columns again, once per model."""
    plan = learning_queries.a09(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" not in plan and plan.count("FileScan") == 1


def test_learners_read_written_vectors(spark):
    rows = spark.createDataFrame([(0, 1.0, 3, 0.5), (1, 2.0, 0, 0.0)], "label int, weight double, a int, b double")
    held = models._vectors(rows, ["a", "b"])
    assert "FileScan" in held._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r["inputs"].toArray()) for r in held.collect()) == [(0.0, 0.0), (3.0, 0.5)]
    for odd in (None, float("nan")):
        with pytest.raises(Exception, match="missing"):
            models._vectors(rows.withColumn("b", F.lit(odd).cast("double")), ["a", "b"])
