"""Personal data: patterns, and a skip-chain conditional random field that adds to them.

Patterns (email, ip, card, phone) find the base spans. The random field labels the tokens that hold a
digit or an @, with the labels none, email, ip, card and phone. Its factors:
 - a unary one from the token's shape and its neighbours' (multinomial logistic regression),
 - a chain factor between tokens that follow each other, and
 - a skip factor between distant tokens of one document that are equal or similar (equal once signs
   and letter case are dropped), which lets evidence at one mention reach the others. Digit groups next
   to each other are one mention, too, so numbers written with spaces are linked group by group.
The factors are trained piece by piece on the base spans of a bounded sample of documents: the unary
factor by regression, the other two as smoothed log ratios of label pairs to chance. Tokens that no pattern finds but
that are linked with one that a pattern finds are left out of all three, as their label isn't known. So that mentions agree
where the sample has few that repeat, skip factors start from `CONSISTENCY` pairs of equal labels for each label. Marginals come from loopy message passing, in
damped rounds over all documents of a batch at once, until no message changes by more than `TOLERANCE`. A round
works on the messages that can still change, so evidence reaches the last of many mentions without all
messages being computed again. Where loops keep messages swinging, a message's step is halved whenever it has
turned back `PATIENCE` times, which ends that. Equal tokens are linked to their next mention
only, so a token that repeats n times has n - 1 skip factors.

A run of tokens with one label whose marginals all reach `SURE` becomes a span unless it meets a
base span. Offsets are code points, ends exclusive.

A null text is empty and has no spans. Rows that repeat, and null ids, are scanned each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from .common import ship, written

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["none", *KINDS]
SAMPLE = 20_000
TOLERANCE, PATIENCE, DAMPING, SURE = 1e-6, 20, 0.3, 0.95
CONSISTENCY = 1_000  # pairs of equal labels that skip factors are taken to have seen of each label beforehand
LONGEST = 19  # digits of a mention of several groups

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is entered at its start only and never given back: elsewhere no match could begin.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?\"'()[]{}<>|"
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), sorted by start, then kind as listed."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end(), "email"))
            free = m.end()
        # Text before an @ can't be part of a later match's local part.
        free = max(free, at + 1)
        at = text.find("@", free)
    if any(d in text for d in "0123456789"):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                    found.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            digits = _only_digits(m.group()) if m.end() - m.start() >= 14 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_only_digits(m.group())) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


@dataclass
class Tokens:
    """Candidate tokens of one document."""

    start: list
    end: list
    follows: list  # the token before is a candidate, too, and next to this one
    key: list
    digits: list  # the digits of a token of digits and signs alone, else none
    shape: list


def tokens(text: str) -> Tokens:
    """Tokens with a digit or an @, without signs at their edges, and their features."""
    out = Tokens([], [], [], [], [], [])
    if "@" not in text and not _DIGITS.search(text):
        return out
    last = -2
    for i, m in enumerate(_TOKEN.finditer(text)):
        word = m.group()
        if "@" not in word and not _DIGITS.search(word):
            continue
        left = len(word) - len(word.lstrip(_EDGE))
        body = word.strip(_EDGE)
        if not body:
            continue
        out.start.append(m.start() + left)
        out.end.append(m.start() + left + len(body))
        out.follows.append(last == i - 1)
        last = i
        digits = _only_digits(body)
        out.key.append("#" + digits if len(digits) >= 4 and 2 * len(digits) >= len(body)
                       else re.sub(r"[^a-z0-9@]", "", body.lower()))
        out.digits.append("" if "@" in body or any(c.isalpha() for c in body) else digits)
        out.shape.append(_shape(body, digits, word))
    return out


def _shape(body: str, digits: str, word: str) -> list[float]:
    n, d = len(body), len(digits)
    letters = sum(c.isalpha() for c in body)
    groups = len(_DIGITS.findall(body))
    dots, hyphens = body.count("."), body.count("-")
    return [float(x) for x in (
        "@" in body, body.count("@") == 1 and "." in body.split("@")[-1], body[:1] == "+", word[:1] == "(",
        d == n, letters == 0, d == 0, d == 1, 2 <= d <= 3, 4 <= d <= 6, d == 7, 8 <= d <= 9, 10 <= d <= 13,
        14 <= d <= 19, d > 19, dots == 0, dots == 3 and groups == 4, dots not in (0, 3), hyphens == 1, hyphens > 1,
        14 <= d <= 19 and d == n and luhn(digits), letters > 0 and d > 0, min(n, 40) / 40,
        dots == 3 and groups == 4 and all(int(x) <= 255 for x in _DIGITS.findall(body) if len(x) < 4))]


def unary_features(t: Tokens) -> np.ndarray:
    """Own shape, and the shapes of the tokens before and after where they are candidates."""
    own = np.array(t.shape, np.float32).reshape(len(t.shape), -1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    if len(own) > 1:
        linked = np.array(t.follows[1:])[:, None]
        before[1:] = own[:-1] * linked
        after[:-1] = own[1:] * linked
    return np.hstack([own, before, after])


def gold(t: Tokens, spans: list) -> np.ndarray:
    """Label number of each token: that of the base span that covers its start, the first kind listed."""
    out = np.zeros(len(t.start), np.int64)
    for start, end, kind in reversed(spans):
        a = np.searchsorted(t.start, start)
        b = np.searchsorted(t.start, end)
        out[a:b] = KINDS.index(kind) + 1
        if a and t.end[a - 1] > start:
            out[a - 1] = KINDS.index(kind) + 1
    return out


def mentions(t: Tokens):
    """(key, first token, end) of tokens, and of digit groups that follow each other, with keys of 4 characters or more."""
    for i, key in enumerate(t.key):
        if len(key) >= 4:
            yield key, i, i + 1
        digits, j = t.digits[i], i + 1
        while digits and j < len(t.key) and t.follows[j] and t.digits[j]:
            digits += t.digits[j]
            j += 1
            if len(digits) > LONGEST:
                break
            if len(digits) >= 4:
                yield "#" + digits, i, j


def skips(t: Tokens) -> list[tuple[int, int]]:
    """Each token with the next mention of its key, part by part; of the mentions that a token is in, the one
    of most characters that has been there before counts. Neighbours are left to the chain."""
    last, best = {}, {}
    for key, start, end in mentions(t):
        before, until = last.get(key, (start, start))
        if until > start:  # it overlaps itself
            continue
        last[key] = start, end
        n, m = until - before, end - start
        if not n:
            continue
        found = {}
        for part in range(max(n, m)):
            found.setdefault(start + min(part, m - 1), []).append(before + min(part, n - 1))
        for b, sources in found.items():
            if len(key) > best.get(b, (0,))[0]:
                best[b] = len(key), sources
    return sorted((a, b) for b, (_, sources) in best.items() for a in sources)


def told(labels: np.ndarray, linked: list[tuple[int, int]]) -> np.ndarray:
    """Whether the base spans tell each token's label: that no pattern finds a further mention of personal data
    doesn't make it none, nor the mentions linked with that one."""
    known, moved = np.ones(len(labels), bool), True
    while moved:
        moved = False
        for a, b in linked:
            for x, y in ((a, b), (b, a)):
                if known[x] and not labels[x] and (labels[y] or not known[y]):
                    known[x], moved = False, True
    return known


def _ratios(pairs: np.ndarray, labels: np.ndarray, same: float = 0.0) -> np.ndarray:
    """Log ratio of label pairs to what the labels' own shares would give; all counts plus one, and `same` more
    for each pair of equal labels."""
    pairs = pairs + same * np.eye(len(pairs))
    joint = (pairs + 1.0) / (pairs + 1.0).sum()
    share = (labels + 1.0) / (labels + 1.0).sum()
    return np.log(joint / np.outer(share, share))


def marginals(unary: np.ndarray, edges: np.ndarray, factors: np.ndarray, which: np.ndarray,
              rounds: int | None = None, damping: float = DAMPING, tolerance: float = TOLERANCE) -> np.ndarray:
    """Loopy sum-product. unary: nodes x labels, log; edges: (a, b) pairs; factors[which[e]][label of
    a, label of b], log. Runs until the messages settle, or for `rounds` at most. Exact on trees."""
    n, k = unary.shape
    if not len(edges):
        return _softmax(unary)
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    m = len(edges)
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    kind = np.concatenate([which, which + len(factors)])
    table = np.concatenate([factors, factors.transpose(0, 2, 1)])
    leaving = np.argsort(source, kind="stable")
    first = np.searchsorted(source[leaving], np.arange(n + 1))
    messages, belief = np.zeros((2 * m, k)), unary.astype(np.float64)
    latest, turns = np.zeros((2 * m, k)), np.zeros(2 * m, np.int64)
    active, done = np.arange(2 * m), 0
    while len(active) and (rounds is None or done < rounds):
        done += 1
        cavity = belief[source[active]] - messages[back[active]]
        scores = cavity[:, :, None] + table[kind[active]]
        top = scores.max(1, keepdims=True)
        new = np.log(np.exp(scores - top).sum(1)) + top[:, 0]
        new -= new.max(1, keepdims=True)
        step = (1 - damping) * 0.5 ** (turns[active] // PATIENCE)
        change = step[:, None] * (new - messages[active])
        messages[active] += change
        np.add.at(belief, target[active], change)
        turns[active] += (change * latest[active] < 0).any(1)
        latest[active] = change
        moved = active[np.abs(change).max(1) > tolerance]
        # What moved may move on, and so may the messages that leave its targets.
        at = np.unique(target[moved])
        sizes = first[at + 1] - first[at]
        out = np.repeat(first[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        active = np.unique(np.concatenate([moved, leaving[out]]))
    return _softmax(belief)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class SkipChain:
    """The trained field: unary weights (labels x features), bias, chain and skip factors."""

    def __init__(self, weights, bias, chain, skip):
        self.weights, self.bias = np.asarray(weights, np.float64), np.asarray(bias, np.float64)
        self.factors = np.stack([chain, skip])

    def spans(self, texts: list[str]) -> list[tuple[list, list]]:
        """(base spans, all spans) of each text."""
        found, base_of, offset, feats, edges, which = [], [], 0, [], [], []
        for text in texts:
            t = tokens(text)
            base_of.append(base_spans(text) if "@" in text or t.start else [])
            found.append((offset, t))
            if t.start:
                n = len(t.start)
                feats.append(unary_features(t))
                chain = [(offset + i - 1, offset + i) for i in range(1, n) if t.follows[i]]
                skip = [(offset + a, offset + b) for a, b in skips(t) if not (b == a + 1 and t.follows[b])]
                edges += chain + skip
                which += [0] * len(chain) + [1] * len(skip)
                offset += n
        if not offset:
            return [(b, b) for b in base_of]
        unary = np.concatenate(feats) @ self.weights.T + self.bias
        # Base spans are facts: their tokens keep their label.
        known = np.zeros(offset, np.int64)
        for (at, t), base in zip(found, base_of):
            if base and t.start:
                known[at:at + len(t.start)] = gold(t, base)
        fixed = np.flatnonzero(known)
        unary[fixed] = -30.0
        unary[fixed, known[fixed]] = 0.0
        belief = marginals(unary, np.array(edges, np.int64).reshape(-1, 2), self.factors, np.array(which, np.int64))
        best, sure = belief.argmax(1), belief.max(1)
        out = []
        for (at, t), base in zip(found, base_of):
            added, i, n = [], 0, len(t.start)
            while i < n:
                label = best[at + i]
                if not label or sure[at + i] < SURE:
                    i += 1
                    continue
                j = i + 1
                while j < n and t.follows[j] and best[at + j] == label and sure[at + j] >= SURE and label == 4:
                    j += 1
                start, end = t.start[i], t.end[j - 1]
                if not _meets(base, start, end):
                    added.append((start, end, KINDS[label - 1]))
                i = j
            out.append((base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))))
        return out


def _meets(spans: list, start: int, end: int) -> bool:
    return any(a < end and start < b for a, b, _ in spans)


def fit(docs: DataFrame, sample: int = SAMPLE, seed: int = 11, id_col: str = "doc_id",
        text_col: str = "text") -> SkipChain:
    """Train on the base spans of at most `sample` documents with candidate tokens, chosen by a hash."""
    ship(docs.sparkSession)
    def run(batches):
        for batch in batches:
            rows, labels, pairs, kinds = [], [], [], []
            for text in batch.column(0):
                text = text.as_py() or ""
                t = tokens(text)
                if not t.start:
                    continue
                y = gold(t, base_spans(text))
                x = unary_features(t)
                linked = skips(t)
                known = told(y, linked)
                for i in np.flatnonzero(known):
                    rows.append(x[i].tolist())
                    labels.append(float(y[i]))
                    pairs.append(int(y[i - 1] * 5 + y[i]) if i and t.follows[i] and known[i - 1] else -1)
                    kinds.append(0)
                for a, b in linked:
                    if not (known[a] and known[b]):
                        continue
                    rows.append(None)
                    labels.append(None)
                    pairs.append(int(y[a] * 5 + y[b]))
                    kinds.append(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float32())), pa.array(labels, pa.float64()),
                 pa.array(pairs, pa.int32()), pa.array(kinds, pa.int32())], ["x", "label", "pair", "kind"])

    chosen = docs.select(F.col(text_col).alias("text"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias(
        "_h")).where("text rlike '[0-9@]'")
    total = chosen.count()
    # The share that leaves about `sample` rows; a hash range needs no sort of whole texts.
    bound = min((1 << 63) - 1, int(-(1 << 63) + min(1.0, sample / max(total, 1)) * (1 << 64)))
    # A row that repeats teaches once, so that the sample keeps its size however often it does.
    rows = written(chosen.where(F.col("_h") <= bound).dropDuplicates(["_h"]).select("text").mapInArrow(
        run, "x array<float>, label double, pair int, kind int"), "pii-tokens")
    counts = np.zeros((2, 25))
    for r in rows.where("pair >= 0").groupBy("kind", "pair").count().collect():  # 50 rows at most
        counts[r["kind"], r["pair"]] = r["count"]
    counts = counts.reshape(2, 5, 5)
    counts = counts + counts.transpose(0, 2, 1)
    labels = np.zeros(5)
    for r in rows.where("label is not null").groupBy("label").count().collect():
        labels[int(r["label"])] = r["count"]
    width = 3 * len(_shape("0", "0", "0"))
    weights, bias = np.zeros((5, width)), np.array([4.0, 0, 0, 0, 0])
    table = rows.where("x is not null").select(array_to_vector("x").alias("features"), "label").coalesce(6)
    if table.select("label").distinct().count() > 1:
        model = LogisticRegression(maxIter=40, regParam=1e-3, family="multinomial", standardization=False).fit(table)
        k = model.numClasses
        weights[:k] = model.coefficientMatrix.toArray()
        bias[:] = -20.0
        bias[:k] = model.interceptVector.toArray()
    return SkipChain(weights, bias, _ratios(counts[0], labels), _ratios(counts[1], labels, CONSISTENCY))


def find(docs: DataFrame, model: SkipChain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base and spans as arrays of (start, end, kind)."""
    ship(docs.sparkSession)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                result = model.spans([x.as_py() or "" for x in part.column(1)])
                as_array = lambda which: pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in r[which]]
                                                   for r in result], pa.list_(span))
                yield pa.RecordBatch.from_arrays([part.column(0), as_array(0), as_array(1)], ["doc_id", "base", "spans"])

    kind = "array<struct<start:bigint,end:bigint,kind:string>>"
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id bigint, base {kind}, spans {kind}")


def digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select("doc_id", *[of_kind(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
