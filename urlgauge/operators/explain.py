"""The additive model as a table of step functions, and exact local contributions.

Cells are found in Arrow functions that carry every term's scores and every feature's steps, so plans don't grow with
bins or rounds and no row carries the model. A row's log odds are the base value plus one looked-up number per term. What
is said of all rows of a table depends on the rows and weights per cell only, which tasks count and Spark adds up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import constants as K
from ..functions import cards, features, urls
from ..plans import workers
from . import ensembles, models

#: Whole-number features find their cell in a table by value up to this threshold; others search the steps.
LOOKED_UP = 1 << 16


@dataclass
class Additive:
    """Thresholds per feature; per term its features and a grid of centred scores."""

    features: list[str]
    thresholds: dict[str, list[float]]
    terms: list[tuple[tuple[str, ...], np.ndarray]]
    base: float
    pair_thresholds: dict[str, list[float]] | None = None  # of terms with two features, if they are others

    def name(self, index: int) -> str:
        return " & ".join(self.terms[index][0])

    def edges(self, key: tuple[str, ...]) -> list[list[float]]:
        """The thresholds of each axis of a term's grid."""
        steps = self.thresholds if len(key) == 1 or self.pair_thresholds is None else self.pair_thresholds
        return [list(steps.get(n, [])) for n in key]


def from_fit(fitted: models.Fitted) -> Additive:
    """Shapes of a model just fitted, not centred yet. Features with a single bin have no term."""
    cuts, fit, names = fitted.extra["cuts"], fitted.extra["fit"], fitted.features
    terms = [((n,), fit.main[i, :len(cuts[n]) + 1]) for i, n in enumerate(names) if cuts[n]]
    terms += [((names[a], names[b]), s) for (a, b), s in zip(fit.pairs, fit.pair_scores)]
    coarse = {n: [cuts[n][b] for b in ensembles.ends(fit.coarse[i])] for i, n in enumerate(names)}
    return Additive(list(names), cuts, terms, fit.base, coarse)


def _axes(model: Additive) -> list[tuple[str, bool]]:
    """Every (feature, in a pair) that some term uses; both kinds are one if they have the same thresholds."""
    return sorted({(n, len(key) > 1 and model.pair_thresholds is not None) for key, _ in model.terms for n in key},
                  key=lambda a: (model.features.index(a[0]), a[1]))


def _steps(model: Additive, name: str, pair: bool) -> list[float]:
    return [float(t) for t in (model.pair_thresholds if pair else model.thresholds)[name]]


def _by_value(steps: list[float]) -> bool:
    return bool(steps) and 0 <= steps[0] and steps[-1] < LOOKED_UP


def _finder(df: DataFrame, model: Additive) -> tuple[Column, Callable]:
    """The features that the terms use as one array, which Arrow takes over much faster than a column each, and a function
    from such arrays to the cell of every row, by term. A cell is the number of steps below the value; a null has the first."""
    axes = _axes(model)
    names = list(dict.fromkeys(n for n, _ in axes))
    whole = {f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)}
    steps = [np.array(_steps(model, *axis)) for axis in axes]
    places = [np.searchsorted(s, np.arange(int(s[-1]) + 2), "left") if n in whole and _by_value(list(s)) else None
              for s, (n, _) in zip(steps, axes)]
    sources = [names.index(n) for n, _ in axes]
    terms = [([axes.index((n, len(key) > 1 and model.pair_thresholds is not None)) for n in key], cells.shape)
             for key, cells in model.terms]

    def find(rows: pa.Array) -> list[np.ndarray]:
        flat = rows.flatten()
        missing = np.asarray(flat.is_null()).reshape(-1, len(names)).T if flat.null_count else None
        values = np.ascontiguousarray(flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, len(names)).T)
        found = []
        for source, own, table in zip(sources, steps, places):
            if table is not None:
                at = np.take(table, np.clip(values[source], 0, len(table) - 1).astype(np.intp))
            else:
                at = np.searchsorted(own, values[source], "left")
            found.append(at if missing is None else np.where(missing[source], 0, at))
        cells = []
        for own, shape in terms:
            at = found[own[0]]
            for axis, size in zip(own[1:], shape[1:]):
                at = at * size + found[axis]
            cells.append(at)
        return cells

    return F.array(*[F.col(n).cast("double") for n in names]), find


def with_terms(df: DataFrame, model: Additive, order: str | None = None) -> DataFrame:
    """Add one double column t_<i> per term, and under the name `order` the terms' numbers, largest scores first."""
    if not model.terms:
        return df
    urls.compiled(df.sparkSession)
    given, find = _finder(df, model)
    scores = [np.array(cells, float).ravel() for _, cells in model.terms]

    def look(rows: pa.Array) -> pa.Array:
        found = np.stack([np.take(s, at) for s, at in zip(scores, find(rows))], axis=1)
        ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(scores))
        lists = [pa.ListArray.from_arrays(ends, pa.array(found.ravel()))]
        if order:
            ranked = np.argsort(-np.abs(found), axis=1, kind="stable").astype(np.int32)
            lists.append(pa.ListArray.from_arrays(ends, pa.array(ranked.ravel())))
        return pa.StructArray.from_arrays(lists, ["scores", "ranked"][:len(lists)])

    # Not deterministic to the optimizer only: else it copies the function and all features into filters on a score, per term.
    kind = "scores array<double>" + (", ranked array<int>" if order else "")
    looked = df.withColumn("_terms", F.arrow_udf(look, kind).asNondeterministic()(given))
    terms = {f"t_{i}": F.get("_terms.scores", F.lit(i)) for i in range(len(scores))}
    return looked.withColumns({**terms, **({order: F.col("_terms.ranked")} if order else {})}).drop("_terms")


def _in_order(df: DataFrame, entries: str, order: str, size: int) -> DataFrame:
    """Put an array of entries into the given order. Sorting structs was half of the time of a score record."""
    return df.withColumn(entries, F.array(*[F.get(entries, F.get(order, F.lit(i))) for i in range(size)]))


def cell_totals(df: DataFrame, model: Additive, weight: str | None = None) -> DataFrame:
    """Rows of `df` and their weight (1 each without a column) by term and cell, where there are any."""
    given, find = _finder(df, model)
    sizes = [cells.size for _, cells in model.terms]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, weights = ([np.zeros(n, kind) for n in sizes] for kind in (np.int64, np.float64))
        for batch in batches:
            weight = batch.column(1).fill_null(0.0).to_numpy(zero_copy_only=False)
            for n, w, at in zip(rows, weights, find(batch.column(0))):
                n += np.bincount(at, minlength=len(n))
                w += np.bincount(at, weight, len(w))
        held = [np.flatnonzero(n) for n in rows]
        columns = [np.repeat(np.arange(len(sizes)), [len(h) for h in held])] + [
            np.concatenate([x[h] for x, h in zip(own, held)] or [[]]) for own in ([np.arange(n) for n in sizes], rows, weights)]
        kinds = (np.int32, np.int32, np.int64, np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(columns, kinds)], ["index", "cell", "rows", "weight"])

    own = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    parts = df.select(given.alias("given"), own.alias("own")).mapInArrow(count, "index int, cell int, rows long, weight double")
    return parts.groupBy("index", "cell").agg(F.sum("rows").alias("rows"), F.sum("weight").alias("weight"))


def centred(model: Additive, train: DataFrame) -> Additive:
    """Move every term's weighted training mean into the base value. At most a row per cell of the model is collected."""
    sums, totals = np.zeros(len(model.terms)), np.zeros(len(model.terms))
    for r in cell_totals(train, model, "weight").orderBy("index", "cell").collect():
        sums[r["index"]] += r["weight"] * float(model.terms[r["index"]][1].ravel()[r["cell"]])
        totals[r["index"]] += r["weight"]
    means = [float(s / t) for s, t in zip(sums, totals)]
    terms = [(key, cells - m) for (key, cells), m in zip(model.terms, means)]
    return Additive(model.features, model.thresholds, terms, model.base + sum(means), model.pair_thresholds)


def build(fitted: models.Fitted, train: DataFrame) -> Additive:
    """Shape tables of an additive model just fitted, centred on its weighted training rows."""
    return centred(from_fit(fitted), train)


_SAVED = "kind string, place int, names array<string>, numbers array<double>"


def save(spark, model: Additive, path: str) -> None:
    """Write thresholds, grids and base, so that the model can serve without its training rows."""
    rows = [("base", 0, list(model.features), [float(model.base)])]
    rows += [("thresholds", i, [n], [float(t) for t in model.thresholds.get(n, [])]) for i, n in enumerate(model.features)]
    if model.pair_thresholds is not None:
        rows += [("pair thresholds", i, [n], [float(t) for t in model.pair_thresholds.get(n, [])])
                 for i, n in enumerate(model.features)]
    rows += [("term", i, list(key), [float(c) for c in cells.ravel()]) for i, (key, cells) in enumerate(model.terms)]
    spark.createDataFrame(rows, _SAVED).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark, path: str, expected: list[str] | None = None) -> Additive:
    """The saved model; its size is set by its rounds, not by any data. Other inputs are an error."""
    rows = sorted(spark.read.schema(_SAVED).parquet(path).collect(), key=lambda r: r["place"])
    base = next(r for r in rows if r["kind"] == "base")
    if expected is not None and base["names"] != list(expected):
        raise ValueError("The saved feature order does not match.")
    grid = {r["names"][0]: list(r["numbers"]) for r in rows if r["kind"] == "thresholds"}
    pairs = {r["names"][0]: list(r["numbers"]) for r in rows if r["kind"] == "pair thresholds"} or None
    model = Additive(base["names"], grid, [], base["numbers"][0], pairs)
    model.terms = [(tuple(r["names"]), np.array(r["numbers"]).reshape([len(e) + 1 for e in model.edges(tuple(r["names"]))]))
                   for r in rows if r["kind"] == "term"]
    return model


def shape_table(spark, model: Additive) -> DataFrame:
    """One row per (term, cell): the interval of each feature and the score."""
    terms = spark.createDataFrame(
        [(i, model.name(i), list(key), [len(e) + 1 for e in model.edges(key)], model.edges(key), cells.ravel().tolist())
         for i, (key, cells) in enumerate(model.terms)],
        "index int, term string, names array<string>, sizes array<int>, edges array<array<double>>, scores array<double>")
    rows = terms.select("*", F.posexplode("scores").alias("cell", "score"))

    def interval(name: Column, axis: Column) -> Column:
        below = F.aggregate(F.slice("sizes", axis + 2, F.size("sizes")), F.lit(1), lambda a, n: a * n)
        at = F.floor(F.col("cell") / below).cast("int") % F.get("sizes", axis)
        edges = F.get("edges", axis)
        return F.struct(name.alias("feature"), F.coalesce(F.get(edges, at - 1), F.lit(float("-inf"))).alias("above"),
                        F.coalesce(F.get(edges, at), F.lit(float("inf"))).alias("up_to"))

    return rows.select("index", "term", "cell", F.transform("names", interval).alias("intervals"), "score")


def shape_rows(df: DataFrame, model: Additive) -> DataFrame:
    """The shape table with the number of rows of `df` in each cell."""
    counts = cell_totals(df, model).select("index", "cell", "rows")
    return shape_table(df.sparkSession, model).join(counts, ["index", "cell"], "left").withColumn(
        "rows", F.coalesce("rows", F.lit(0)))


def term_importance(df: DataFrame, model: Additive) -> DataFrame:
    """Mean absolute contribution per term over the weighted rows, largest first."""
    terms = df.sparkSession.createDataFrame(
        [(i, model.name(i), np.abs(cells).ravel().tolist()) for i, (_, cells) in enumerate(model.terms)],
        "index int, term string, sizes array<double>")
    mean = F.sum(F.col("weight") * F.get("sizes", F.col("cell"))) / F.sum("weight")
    return terms.join(cell_totals(df, model, "weight"), "index", "left").groupBy("index", "term").agg(
        mean.alias("importance")).drop("index").orderBy(F.col("importance").desc(), "term")


def explained(df: DataFrame, model: Additive, check: bool = False) -> DataFrame:
    """Add base_log_odds, total_log_odds, probability and contributions (largest first); with `check` also
    contribution_sum, their sum taken over the array of contributions."""
    own, names = df.columns, list(dict.fromkeys(n for key, _ in model.terms for n in key))
    rows = with_terms(df, model, "_ranked")
    # A feature's texts are made once, whatever the terms it is in.
    rows = rows.withColumns({**{"_shown_" + n: F.concat(F.lit(K.FEATURE_TITLES[n] + ": "), cards.display_value(n)) for n in names},
                             **{"_cell_" + n: cards.value_entry(n) for n in names}})
    entries = []
    for index, (key, _) in enumerate(model.terms):
        value = F.col(f"t_{index}")
        entries.append(F.struct(
            F.lit(model.name(index)).alias("term"),
            F.lit(" + ".join(K.FEATURE_TITLES[n] for n in key)).alias("title"),
            F.concat_ws("; ", *["_shown_" + n for n in key]).alias("values"),
            cards.value_cell(list(key), "_cell_").alias("feature_values"),
            F.lit(len(key) > 1).alias("interaction"), value.alias("contribution"),
            F.when(value > 0, "Raises the phishing score")
            .when(value < 0, "Lowers the phishing score").otherwise("No contribution")
            .alias("direction")))
    total = F.lit(model.base)
    for index in range(len(model.terms)):
        total = total + F.col(f"t_{index}")
    rows = _in_order(rows.withColumns({"contributions": F.array(*entries), "total_log_odds": total}), "contributions", "_ranked", len(entries))
    rows = rows.withColumns({
        "base_log_odds": F.lit(model.base), "probability": cards.sigmoid(F.col("total_log_odds"))})
    told = F.aggregate(F.array(*[F.col(f"t_{i}") for i in range(len(model.terms))]), F.lit(0.0), lambda a, t: a + t)
    return rows.select(*own, "base_log_odds", "total_log_odds", "probability", "contributions",
                       *([told.alias("contribution_sum")] if check else []))


def contributions(df: DataFrame, model: Additive, keep: list[str]) -> DataFrame:
    """One row per (example, term), ranked by absolute contribution. Only what is returned goes through the sort."""
    texts = list(dict.fromkeys(n for key, _ in model.terms for n in key))
    rows = with_terms(df, model, "_ranked").withColumns({"_cell_" + n: cards.value_entry(n) for n in texts})
    entries = [F.struct(F.lit(i).alias("i"), F.col(f"t_{i}").alias("contribution"),
                        cards.value_cell(list(key), "_cell_").alias("feature_values")) for i, (key, _) in enumerate(model.terms)]
    names = F.array(*[F.lit(model.name(i)) for i in range(len(model.terms))])
    rows = _in_order(rows.withColumn("_entries", F.array(*entries)), "_entries", "_ranked", len(entries))
    rows = rows.select(*keep, F.posexplode_outer("_entries").alias("_p", "e"))
    return rows.select(
        *keep, F.get(names, F.col("e.i")).alias("term"), (F.col("_p") + 1).alias("absolute_contribution_rank"),
        F.col("e.contribution").alias("contribution_log_odds"), F.lit(model.base).alias("base_log_odds"),
        F.col("e.feature_values").alias("feature_values"))


def unreconstructed(df: DataFrame, model: Additive, fitted: models.Fitted,
                    tolerance: float = 1e-8) -> DataFrame:
    """Rows whose contributions do not give back the model's own probability."""
    scored = fitted.pipeline.transform(df).select(
        *df.columns, models.vector_to_array("probability")[1].alias("_model"))
    rows = explained(scored, model)
    return rows.where(F.abs(F.col("probability") - F.col("_model")) > tolerance)


def score_urls(df: DataFrame, model: Additive, url: str = "url", model_name: str = "Additive model",
               request_limit: int | None = None) -> DataFrame:
    """Full score record per URL; rejected URLs keep their error and have no score."""
    # A valid URL has no white space inside, so the parts that were checked are those that have features.
    checked = urls.validate(df, url, request_limit=request_limit, keep_parts=True).withColumnRenamed("_url", "_given")
    featured = features.with_features(checked, "_given", parts="_v_").drop(*[c for c in checked.columns if c.startswith("_v_")])
    rows = explained(featured, model, check=True)
    rows = cards.with_highlight(rows, "_given", "_parts")
    # A score that isn't a number from 0 to 1, or that its contributions don't give back, is an error of that row alone.
    gap = F.abs(cards.sigmoid(F.col("base_log_odds") + F.col("contribution_sum")) - F.col("probability"))
    sound = F.coalesce(F.col("probability").between(0, 1) & (gap <= 1e-10 + 1e-8 * F.col("probability")), F.lit(False))
    rows = rows.withColumns({"_sound": sound | ~F.col("valid")}).withColumns({
        "valid": F.col("valid") & F.col("_sound"),
        "error_code": F.when(~F.col("_sound"), "SCORE").otherwise(F.col("error_code")),
        "error_message": F.when(~F.col("_sound"), K.SCORE_MESSAGE).otherwise(F.col("error_message"))})
    p = F.when(F.col("valid"), F.col("probability"))
    ok = F.col("valid")
    top = F.slice("contributions", 1, 6)
    raw = F.map_from_arrays(F.array(*map(F.lit, K.FEATURES)),
                            F.array(*[F.col(n).cast("double") for n in K.FEATURES]))
    return rows.select(
        *df.columns, "valid", "error_code", "error_message",
        F.when(ok, F.col("_given")).alias("scored_url"), F.lit(model_name).alias("model_name"),
        cards.trust_score(p).alias("trust_score"), p.alias("phishing_probability"),
        cards.risk_percent(p).alias("risk_percent"), cards.prediction(p).alias("prediction"),
        F.when(ok, cards.status(p)).alias("status"),
        F.when(ok, cards.status_style(p)).alias("status_style"),
        F.lit(K.THRESHOLD).alias("threshold"),
        F.when(ok, F.transform(top, lambda e: F.concat(e["title"], F.lit(": "), F.lower(e["direction"]))))
        .alias("top_signals"),
        F.when(ok, top).alias("top_contributions"),
        F.when(ok, F.col("contributions")).alias("model_contributions"),
        "base_log_odds", F.when(ok, F.col("total_log_odds")).alias("total_log_odds"),
        F.when(ok, raw).alias("raw_features"), F.when(ok, cards.indicators()).alias("indicators"),
        F.when(ok, F.col("_parts")).alias("url_parts"))


def score_urls_older(df: DataFrame, forest: models.Fitted, url: str = "url") -> DataFrame:
    """The older record: forest score, three-way status, four cards, worded reasons. All NULL for an unusable URL."""
    weights = dict(models.importances(forest))
    # Unusable URLs keep their row: a stand-in goes through the forest and its results are blanked.
    parts = urls.with_parts(df.withColumn("__given", urls.strip(F.col(url))), "__given", "__v_")
    checked = parts.select(*df.columns, ((F.col("__v_host") != "") & ~urls.bad_authority("__v_")).alias("__usable"))
    rows = features.with_features(checked.withColumn(
        "__scored", F.when(F.col("__usable"), F.col(url)).otherwise("http://unusable.invalid/")), "__scored")
    scored = forest.pipeline.transform(rows).withColumn("_p", models.vector_to_array("probability")[1])
    trust = cards.trust_score(F.col("_p"))
    results = {"trust_score": trust, "phishing_probability": F.round("_p", 4),
               "risk_percent": cards.risk_percent(F.col("_p")), "status": cards.status3(trust),
               "cards": cards.signal_cards(), "top_signals": cards.reasons(weights)}
    return scored.select(*df.columns, *[F.when(F.col("__usable"), c).alias(n) for n, c in results.items()])


@dataclass
class Paths:
    """All leaves whose paths test the same number of features, as arrays (leaves, features)."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray  # of the training rows that follow the path at this feature's splits
    value: np.ndarray


def paths(trees: dict[int, dict[int, tuple]], weights: list[float]) -> list[Paths]:
    """Nodes are (left, right, feature, threshold, prediction, rows), children by number; -1 is no child."""
    found: dict[int, list] = {}
    for number, nodes in trees.items():
        stack = [(0, {})]
        while stack:
            node, seen = stack.pop()
            left, right, feature, cut, value, rows = nodes[node]
            if left < 0:
                found.setdefault(len(seen), []).append((seen, 2.0 * weights[number] * value))
                continue
            low, high, share = seen.get(feature, (-np.inf, np.inf, 1.0))
            for child, bounds in ((left, (low, min(high, cut))), (right, (max(low, cut), high))):
                stack.append((child, {**seen, feature: (*bounds, share * nodes[child][5] / rows)}))
    return [Paths(np.array([list(seen) for seen, _ in leaves], int).reshape(len(leaves), size),
                  *(np.array([[seen[f][i] for f in seen] for seen, _ in leaves]).reshape(len(leaves), size) for i in range(3)),
                  np.array([value for _, value in leaves])) for size, leaves in sorted(found.items())]


def shapley(rows: np.ndarray, leaves: list[Paths]) -> np.ndarray:
    """Contributions (rows, features). A path of d features is the polynomial of the products of (share + hit * z), which
    coalitions of each size add to; every feature's own factor is divided out again, for all rows and leaves at once."""
    out = np.zeros(rows.shape)
    for p in leaves:
        count, size = p.feature.shape
        if not size:
            continue
        step = max(1, (1 << 21) // (count * (size + 1)))  # rows at once, so that arrays stay small
        sizes = np.array([factorial(k) * factorial(size - k - 1) / factorial(size) for k in range(size)])
        places = [np.eye(rows.shape[1])[p.feature[:, i]] for i in range(size)]
        for start in range(0, len(rows), step):
            x = rows[start:start + step][:, p.feature]
            hit = ((p.low < x) & (x <= p.high)).astype(float)
            whole = np.zeros((*x.shape[:2], size + 1))
            whole[..., 0] = 1
            for i in range(size):
                whole[..., 1:] = whole[..., 1:] * p.share[:, i, None] + whole[..., :-1] * hit[..., i, None]
                whole[..., 0] *= p.share[:, i]
            for i in range(size):
                total, above = 0.0, 0.0
                for k in range(size - 1, -1, -1):
                    # Without the factor: from the top if the feature is hit, else every coefficient by the share.
                    above = np.where(hit[..., i] > 0, whole[..., k + 1] - p.share[:, i] * above, whole[..., k] / p.share[:, i])
                    total = total + above * sizes[k]
                out[start:start + step] += ((hit[..., i] - p.share[:, i]) * p.value * total) @ places[i]
    return out


def tree_contributions(df: DataFrame, fitted: models.Fitted, keep: list[str], folder: str) -> DataFrame:
    """Path-dependent contributions of boosted trees, long form: one row per (row of `df`, feature).

    The trees travel as small arrays. Each feature's share is its Shapley value over the game in which an
    unknown split is averaged by the children's training rows."""
    spark = df.sparkSession
    workers.ship(spark)
    fitted.pipeline.stages[-1].write().overwrite().save(folder)
    weights = [float(w) for w in fitted.pipeline.stages[-1].treeWeights]
    trees: dict[int, dict] = {}
    for r in spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*").collect():
        split = r["split"]
        trees.setdefault(r["treeID"], {})[r["id"]] = (
            r["leftChild"], r["rightChild"], split["featureIndex"],
            split["leftCategoriesOrThreshold"][0] if r["leftChild"] >= 0 else 0.0, r["prediction"], float(r["rawCount"]))
    leaves, names, keep_names = paths(trees, weights), list(fitted.features), list(keep)
    base = float(sum((p.value * p.share.prod(axis=1)).sum() for p in leaves))

    def explain_rows(batches):
        for batch in batches:
            given = shapley(batch[names].to_numpy(float), leaves)
            order = np.argsort(-np.abs(given), axis=1, kind="stable")
            long = batch[keep_names].loc[batch.index.repeat(len(names))].reset_index(drop=True)
            long["term"] = np.array(names, object)[order].ravel()
            long["absolute_contribution_rank"] = np.tile(np.arange(1, len(names) + 1, dtype=np.int32), len(batch))
            long["contribution_log_odds"] = np.take_along_axis(given, order, 1).ravel()
            long["base_log_odds"] = base
            yield long

    schema = df.select(*keep).schema
    for name, kind in (("term", "string"), ("absolute_contribution_rank", "integer"),
                       ("contribution_log_odds", "double"), ("base_log_odds", "double")):
        schema = schema.add(name, kind)
    return df.select(*keep, *[n for n in names if n not in keep]).mapInPandas(explain_rows, schema)
