"""Toxicity scores: gradient-boosted trees over dense features of the text, calibrated isotonically.

Features of a text: densities of words from a learned lexicon, how near second-person words stand to
them, capitals, punctuation, obfuscation (letters mixed with digits or signs, and lexicon words that
appear only once such signs are read as letters), repetition and length.

The lexicon is mined from labelled texts: whole words and word beginnings of 4 to 8 bytes whose
document frequency in toxic texts is significantly raised (log odds over their standard error), the
`LEXICON` best of them. The classifier is fitted on a bounded sample: the `sample` labelled rows
that come first by a hash of doc_id; half of them gives the lexicon, a third the trees, a sixth
the calibration, so neither later step sees rows that the step before was fitted to.

Only text enters a score. Null and empty texts have all-zero features and get a score like any other.
Labelled rows without a text row, without a label, or with a null id teach nothing; several labels
of one document count as toxic if one is. If the sample has one class only, every score is that class's
share. Rows that repeat, and null ids, are scored each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from .common import IS_SPACE, Hasher, chunks, ship, text_buffer, word_spans, written

SAMPLE = 40_000
LEXICON = 4_096
PREFIXES = (4, 5, 6, 7, 8)
MIN_DOCUMENTS, MIN_Z = 4, 2.7

# Second-person words of English, German, French and Spanish.
SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine deiner ihr euch euer "
                 "tu te toi ton ta tes vous votre vos usted ustedes tú ti tuyo vosotros").split()
# Signs that stand for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

FEATURES = ["strong_density", "strong_count", "mild_density", "best_weight", "weight_density", "near_person",
            "person_density", "capital_share", "shouted_share", "exclaim_density", "question_density",
            "punctuation_share", "digit_share", "mixed_share", "masked_hits", "run_share", "repeat_share",
            "words", "word_length", "strong_near_end"]

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOOSE = _LETTER.copy()  # letters and the signs that stand for them
_LOOSE[[ord(c) for c in LEET]] = True
_UNMASK = np.arange(256, dtype=np.uint8)
for _sign, _letter in LEET.items():
    _UNMASK[ord(_sign)] = ord(_letter)
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _keys(data, starts, ends, hasher=None):
    """Hashes of each word and of its beginnings (words x kinds), zero where the word is too short."""
    hasher = hasher or Hasher(data)
    out = np.zeros((len(PREFIXES) + 1, len(starts)), np.uint64)
    if len(starts):
        out[0] = hasher(starts, ends)
        for i, k in enumerate(PREFIXES, 1):
            long = np.flatnonzero(ends - starts > k)
            out[i, long] = hasher(starts[long], starts[long] + k) + np.uint64(i)
    return out


class Lexicon:
    """Hash to weight, with a small bit table in front."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.weights = keys[order].astype(np.uint64), weights[order].astype(np.float32)
        self.table = np.zeros(1 << 18, bool)
        self.table[self.keys >> np.uint64(46)] = True

    def weigh(self, keys: np.ndarray) -> np.ndarray:
        """The largest weight among each word's keys (kinds x words), 0 without any."""
        out = np.zeros(keys.shape[1], np.float32)
        if not len(self.keys):
            return out
        kind, at = np.nonzero(self.table[keys >> np.uint64(46)])
        found = keys[kind, at]
        place = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        hit = self.keys[place] == found
        np.maximum.at(out, at[hit], self.weights[place[hit]])
        return out


_PERSON = None


def _person_keys() -> np.ndarray:
    global _PERSON
    if _PERSON is None:
        data, at = text_buffer(pa.array(SECOND_PERSON))
        _PERSON = np.sort(Hasher(data)(at[:-1], at[1:]))
    return _PERSON


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """Rows x FEATURES (float32) of a string array."""
    parts = [_features(part, lexicon) for part in chunks(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)), np.float32)


def _sums(values, at) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[at[1:]] - total[at[:-1]]


def _features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    n = len(column)
    raw, at = text_buffer(column)
    size = np.maximum(at[1:] - at[:-1], 1)
    out = np.zeros((n, len(FEATURES)), np.float64)
    if not len(raw):
        return out.astype(np.float32)
    low, low_at = text_buffer(pc.utf8_lower(pc.fill_null(column, "")))
    starts, ends, row = word_spans(low, low_at, _LETTER)
    weight = lexicon.weigh(_keys(low, starts, ends))
    # The same after signs are read as letters; only words with such signs inside differ.
    plain = _UNMASK[low]
    s2, e2, r2 = word_spans(low, low_at, _LOOSE)
    signs = np.concatenate([[0], np.cumsum(plain != low)])
    letters = np.concatenate([[0], np.cumsum(_LETTER[low])])
    mixed = (signs[e2] > signs[s2]) & (letters[e2] > letters[s2])
    s2, e2, r2 = s2[mixed], e2[mixed], r2[mixed]
    masked = lexicon.weigh(_keys(plain, s2, e2)) if len(s2) else np.zeros(0, np.float32)

    count = np.bincount(row, minlength=n)
    words = np.maximum(count, 1)
    by_row = lambda values: np.bincount(row, weights=values, minlength=n)
    strong, mild = weight >= 3, (weight > 0) & (weight < 3)
    hashes = Hasher(low)(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    person = np.isin(hashes, _person_keys())
    out[:, 0] = by_row(strong) / words
    out[:, 1] = np.log1p(by_row(strong))
    out[:, 2] = by_row(mild) / words
    best = np.zeros(n)
    np.maximum.at(best, row, weight)
    out[:, 3] = best
    out[:, 4] = by_row(weight) / words
    if strong.any() and person.any():
        out[:, 5] = _nearness(np.flatnonzero(strong), np.flatnonzero(person), row, n)
    out[:, 6] = by_row(person) / words
    # Capitals: A-Z, and the two-byte capitals of Latin-1.
    capital = (raw >= 65) & (raw <= 90)
    after = np.zeros(len(raw), bool)
    after[1:] = raw[:-1] == 0xC3
    capital |= after & (raw >= 0x80) & (raw <= 0x9E)
    out[:, 7] = _sums(capital, at) / size
    caps = np.concatenate([[0], np.cumsum(capital)])
    s0, e0, r0 = word_spans(raw, at, _LETTER)
    shouted = (caps[e0] - caps[s0] >= 2) & (2 * (caps[e0] - caps[s0]) >= e0 - s0)
    out[:, 8] = np.bincount(r0, weights=shouted, minlength=n) / words
    out[:, 9] = _sums(raw == ord("!"), at) / words
    out[:, 10] = _sums(raw == ord("?"), at) / words
    out[:, 11] = _sums(_PUNCT[raw], at) / size
    out[:, 12] = _sums((raw >= 48) & (raw <= 57), at) / size
    out[:, 13] = np.bincount(r2, minlength=n) / words
    out[:, 14] = np.log1p(np.bincount(r2, weights=masked >= 3, minlength=n))
    run = np.zeros(len(raw), bool)
    run[2:] = (raw[2:] == raw[1:-1]) & (raw[2:] == raw[:-2]) & ~IS_SPACE[raw[2:]]
    for place in (0, 1):  # runs end with their text
        run[at[:-1][at[1:] - at[:-1] > place] + place] = False
    out[:, 15] = _sums(run, at) / size
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    out[:, 16] = by_row(same) / words
    out[:, 17] = np.log1p(count)
    out[:, 18] = by_row(ends - starts) / words
    last = np.zeros(n)
    np.maximum.at(last, row[strong], np.flatnonzero(strong) - np.searchsorted(row, row[strong]) + 1)
    out[:, 19] = last / words
    return out.astype(np.float32)


def _nearness(a: np.ndarray, b: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Per row, 1 / (1 + words between the nearest a and b), 0 without a pair."""
    out = np.zeros(n)
    place = np.searchsorted(b, a)
    for other in (np.maximum(place - 1, 0), np.minimum(place, len(b) - 1)):
        own = row[b[other]] == row[a]
        np.maximum.at(out, row[a[own]], 1 / (1.0 + np.abs(b[other][own] - a[own])))
    return out


def _mine(rows: DataFrame, size: int) -> Lexicon:
    """The lexicon of (text, toxic) rows; counts are combined per batch and then over the cluster."""
    def run(batches):
        for batch in batches:
            toxic, done = batch.column(1).to_numpy(zero_copy_only=False).astype(bool), 0
            for part in chunks(batch.column(0)):
                low, at = text_buffer(pc.utf8_lower(pc.fill_null(part, "")))
                starts, ends, row = word_spans(low, at, _LETTER)
                keys = _keys(low, starts, ends)
                own = np.broadcast_to(row, keys.shape)
                real = keys != 0
                once = np.unique(np.stack([keys[real], own[real].astype(np.uint64)]), axis=1) if real.any() \
                    else np.zeros((2, 0), np.uint64)
                key, where = np.unique(once[0], return_inverse=True)
                bad = np.bincount(where, weights=toxic[done + once[1].astype(np.int64)], minlength=len(key))
                total = np.bincount(where, minlength=len(key))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(bad.astype(np.int64)), pa.array(total.astype(np.int64))],
                    ["key", "bad", "total"])
                done += len(part)

    sums = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    n_bad, n_good = sums[1], sums[0] - sums[1]
    counts = rows.select("text", "toxic").mapInArrow(run, "key bigint, bad bigint, total bigint").groupBy("key").agg(
        F.sum("bad").alias("bad"), F.sum("total").alias("total"))
    bad, good = F.col("bad") + 0.5, F.col("total") - F.col("bad") + 0.5
    odds = F.log(bad / (n_bad + 1.0 - bad + 0.5)) - F.log(good / (n_good + 1.0 - good + 0.5))
    best = counts.where(F.col("bad") >= MIN_DOCUMENTS).withColumns(
        {"odds": odds, "z": odds / F.sqrt(1 / bad + 1 / good)}).where(F.col("z") >= MIN_Z)
    top = best.orderBy(F.desc("z"), "key").limit(size).select("key", "odds").toArrow()  # at most `size` rows
    return Lexicon(top["key"].to_numpy().view(np.uint64), top["odds"].to_numpy())


class ToxicityModel:
    def __init__(self, lexicon: Lexicon, trees: GBTClassificationModel | None,
                 calibration: IsotonicRegressionModel | None, share: float):
        self.lexicon, self.trees, self.calibration, self.share = lexicon, trees, calibration, share

    def _margin(self, rows: DataFrame, text: Column) -> DataFrame:
        """Add `__tox_margin`, the trees' raw score."""
        ship(rows.sparkSession)
        lexicon = self.lexicon

        @F.arrow_udf("array<float>")
        def vector(column: pa.Array) -> pa.Array:
            made = features(column, lexicon)
            return pa.ListArray.from_arrays(
                pa.array(np.arange(len(made) + 1) * made.shape[1], pa.int32()), pa.array(made.ravel(), pa.float32()))

        rows = rows.withColumn("__tox_features", array_to_vector(vector(text)))
        trees = self.trees.copy().setFeaturesCol("__tox_features").setRawPredictionCol("__tox_raw")
        trees = trees.setProbabilityCol("").setPredictionCol("")
        return trees.transform(rows).withColumn("__tox_margin", vector_to_array("__tox_raw")[1]).drop("__tox_features", "__tox_raw")

    def score(self, docs: DataFrame, text_col: str = "text", name: str = "score") -> DataFrame:
        """Add the score, 0 to 1. Columns named `__tox_features`, `__tox_raw` and `__tox_margin` are reserved."""
        if self.trees is None:
            return docs.withColumn(name, F.lit(float(self.share)))
        scored = self._margin(docs, F.col(text_col))
        model = self.calibration.copy().setFeaturesCol("__tox_margin").setPredictionCol(name)
        return model.transform(scored).drop("__tox_margin").withColumn(
            name, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(name))))


def fit(docs: DataFrame, labels: DataFrame, learns: Column | None = None, sample: int = SAMPLE,
        size: int = LEXICON, trees: int = 24, depth: int = 4, seed: int = 7) -> ToxicityModel:
    """Fit on labels (doc_id, toxic) of the rows for which `learns` (over doc_id) holds."""
    ship(docs.sparkSession)
    known = labels.where("doc_id is not null and toxic is not null")
    known = known.where(learns) if learns is not None else known
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.join(docs.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi")
    # At most `sample` rows of (id, label): a proven bound for the broadcast below.
    chosen = known.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id")).orderBy("_h", "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id"), "text").join(
        F.broadcast(written(chosen, "sample")), "doc_id").dropDuplicates(["doc_id"])
    rows = written(rows, "sample-texts")
    part = F.pmod("_h", F.lit(6))
    lexicon = _mine(rows.where(part < 3), size)
    model = ToxicityModel(lexicon, None, None, 0.0)
    sums = rows.agg(F.count("*"), F.sum("toxic"),
                    *[F.count_distinct(F.when(w, F.col("toxic"))) for w in (part.isin(3, 4), part == 5)]).first()
    model.share = sums[1] / sums[0] if sums[0] else 0.0
    if sums[2] < 2:
        return model

    @F.arrow_udf("array<float>")
    def vector(column: pa.Array) -> pa.Array:
        made = features(column, lexicon)
        return pa.ListArray.from_arrays(
            pa.array(np.arange(len(made) + 1) * made.shape[1], pa.int32()), pa.array(made.ravel(), pa.float32()))

    table = written(rows.select(
        "_h", F.col("toxic").cast("double").alias("label"), vector("text").alias("v")).coalesce(6), "features")
    table = table.withColumn("__tox_features", array_to_vector("v"))
    model.trees = GBTClassifier(
        featuresCol="__tox_features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.25, maxBins=64,
        minInstancesPerNode=5, subsamplingRate=0.9, seed=seed).fit(table.where(part.isin(3, 4)))
    held = table.where(part == 5) if sums[3] == 2 else table.where(part.isin(3, 4))
    raw = model.trees.copy().setFeaturesCol("__tox_features").setRawPredictionCol("__tox_raw").setProbabilityCol("").setPredictionCol("")
    margins = raw.transform(held).select("label", vector_to_array("__tox_raw")[1].alias("__tox_margin"))
    model.calibration = IsotonicRegression(featuresCol="__tox_margin", labelCol="label", predictionCol="score").fit(margins)
    return model


def reject_toxic(docs: DataFrame, labels: DataFrame, learns: Column | None = None, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, with the columns given."""
    scored = fit(docs, labels, learns).score(docs, name="__tox_score")
    return scored.where(F.col("__tox_score") < threshold).select(*docs.columns)
