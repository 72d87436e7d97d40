"""Benchmark decontamination by spaced-seed hashing.

Words are runs of letters and digits (lower-cased; any non-ASCII character counts as one), so
case and punctuation don't matter. A fixed mask hashes some of the words in a window and ignores the
others; windows of a benchmark item and of a document that agree in the masked words get the
same seed although other words were replaced. An item shorter than `window` gets further masks of its
length: it is cut into two blocks more than words may be replaced, and each mask leaves out as many blocks as
words may be replaced, so that some mask avoids the replaced words wherever they are. From SHORT words on these masks
begin and end with a kept word, so that a copy cut off at the document's start or end, with the missing
words counted as replaced, has a seed, too; a shorter item must lie in the document with all its length.

1. The seeds of all items, with their places, are written. Two bit tables of 2^24 bits (2 MB each, a
   fixed size whatever the benchmark) say which seeds may occur.
2. One pass over the documents hashes every window and keeps, only for documents with a seed that
   both tables admit, the seeds' places and the word hashes.
3. The places are joined with the items' seeds on the whole 64-bit seed; each match names an item and
   a diagonal. Along the diagonal all words are compared, and a document counts as contaminated if
   some `window` consecutive words of the item (the whole item if it is shorter) agree in at least
   `similarity` of them.

Items of equal words are one item with the smallest item_id; items without words, or null, match
nothing. A null text has no words. Rows that repeat are reported each. Null ids stay null.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import Hasher, chunks, mix64, ship, text_buffer, word_spans, written

MASKS = ("110100111", "1100101011", "1110010011")
SHORT = 9
BITS = 24
IS_TOKEN = np.zeros(256, bool)
IS_TOKEN[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def hashed_words(column: pa.Array):
    """Word hashes (uint64) of all rows of a string array, and each row's first word (rows + 1)."""
    data, at = text_buffer(pc.utf8_lower(pc.fill_null(column, "")))
    starts, ends, row = word_spans(data, at, IS_TOKEN)
    hashes = Hasher(data)(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return hashes, np.searchsorted(row, np.arange(len(column) + 1))


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """Seed of the window that begins at each word; windows may run over row ends, see `inside`."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(int(mask, 2) * 2 + 1))
    for i, kept in enumerate(mask):
        if kept == "1":
            h = h * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n]
    return mix64(h)


def needed(span: int, similarity: float) -> int:
    """How many of `span` words have to agree."""
    return int(np.ceil(similarity * span - 1e-9))


def masks_of_length(n: int, similarity: float) -> list[tuple[str, int]]:
    """Masks for an item of n words, and the word at which each begins: whichever words the rule lets differ, one
    of them keeps none of these."""
    free = min(n - needed(n, similarity), n - 1)
    blocks = np.array_split(np.arange(n), min(n, free + 2))
    out = []
    for left_out in combinations(range(len(blocks)), free):
        kept = [i for b, block in enumerate(blocks) if b not in left_out for i in block.tolist()]
        first, last = (min(kept), max(kept)) if n >= SHORT else (0, n - 1)
        out.append(("".join("01"[i in kept] for i in range(first, last + 1)), first))
    return out


def inside(first: np.ndarray, span: int, n: int) -> np.ndarray:
    """Which of n windows of `span` words lie in one row."""
    good = np.ones(n + span, bool)
    for back in range(1, span):
        bad = first[1:-1] - back
        good[bad[bad >= 0]] = False
    return good[:n]


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            words, first = hashed_words(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(words.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["item_id", "words"])

    items = benchmark.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "item_id bigint, words array<bigint>")
    return items.where(F.size("words") > 0).groupBy("words").agg(F.min("item_id").alias("item_id")).withColumn(
        "n", F.size("words"))


def _item_seeds(items: DataFrame, masks: tuple, own: dict[int, list[tuple[str, int]]]) -> DataFrame:
    """Seeds of all windows under `masks`, and under the masks that `own` gives for an item's length."""
    def run(batches):
        for batch in batches:
            out = []
            for item, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = np.array(words.values.to_numpy(zero_copy_only=False)).view(np.uint64)
                for mask in masks:
                    out += [(s, item, i, len(words)) for i, s in enumerate(seeds(words, mask).view(np.int64).tolist())]
                for mask, i in own.get(len(words), ()):
                    out.append((int(seeds(words[i:i + len(mask)], mask).view(np.int64)[0]), item, i, len(words)))
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())], ["seed", "item_id", "at", "n"])

    return items.select("item_id", "words").mapInArrow(run, "seed bigint, item_id bigint, at int, n int")


def _bit_tables(item_seeds: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bit tables over the top and the low 24 bits of the seeds; 2^18 longs each at most come here."""
    tables = []
    for part in (F.shiftrightunsigned("seed", 64 - BITS), F.col("seed").bitwiseAND((1 << BITS) - 1)):
        rows = item_seeds.select(part.alias("b")).groupBy(F.shiftright("b", 6).alias("i")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits")).toArrow()
        table = np.zeros(1 << (BITS - 6), np.int64)
        table[rows["i"].to_numpy()] = rows["bits"].to_numpy()
        tables.append(table.view(np.uint8))
    return tables[0], tables[1]


def _admits(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _candidates(docs: DataFrame, masks: list[str], tables) -> DataFrame:
    """Documents with admitted seeds: row, doc_id, words, seeds, places."""
    top, low = tables

    def run(batches):
        for batch in batches:
            done = 0
            for part in chunks(batch.column(2)):
                words, first = hashed_words(part)
                found = []
                for mask in masks:
                    h = seeds(words, mask)
                    hit = np.flatnonzero(_admits(top, h >> np.uint64(64 - BITS)))
                    hit = hit[_admits(low, h[hit] & np.uint64((1 << BITS) - 1))]
                    hit = hit[inside(first, len(mask), len(h))[hit]] if len(hit) else hit
                    found.append((hit, h[hit]))
                place, seed = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(place, kind="stable")
                place, seed = place[order], seed[order]
                own = np.searchsorted(first, place, "right") - 1
                rows, begin = np.unique(own, return_index=True)
                if len(rows):
                    ends = np.append(begin[1:], len(own))
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(done, len(part)).take(pa.array(rows)),
                        batch.column(1).slice(done, len(part)).take(pa.array(rows)),
                        pa.array([words[first[r]:first[r + 1]].view(np.int64) for r in rows], pa.list_(pa.int64())),
                        pa.array([seed[a:b].view(np.int64) for a, b in zip(begin, ends)], pa.list_(pa.int64())),
                        pa.array([place[a:b] - first[r] for a, b, r in zip(begin, ends, rows)], pa.list_(pa.int64())),
                    ], ["row", "doc_id", "words", "seeds", "places"])
                done += len(part)

    return docs.mapInArrow(
        run, "row bigint, doc_id bigint, words array<bigint>, seeds array<bigint>, places array<bigint>")


def _verified(pairs: DataFrame, window: int, similarity: float) -> DataFrame:
    """Keep aligned (doc words, item words) with a window that agrees; add matched and the span."""
    def run(batches):
        for batch in batches:
            keep, matched, begin, end = [], [], [], []
            for i in range(batch.num_rows):
                doc = batch.column("part")[i].values.to_numpy(zero_copy_only=False)
                item = batch.column("words")[i].values.to_numpy(zero_copy_only=False)
                diagonal = batch.column("diagonal")[i].as_py()
                skip = max(0, -diagonal)
                same = np.zeros(len(item), np.int64)
                size = min(len(doc), len(item) - skip)
                same[skip:skip + size] = doc[:size] == item[skip:skip + size]
                span = min(window, len(item))
                total = np.concatenate([[0], np.cumsum(same)])
                good = np.flatnonzero(total[span:] - total[:-span] >= needed(span, similarity))
                if len(good):
                    inside_any = np.flatnonzero(same[good[0]:good[-1] + span]) + good[0]
                    keep.append(i)
                    matched.append(len(inside_any))
                    begin.append(diagonal + int(inside_any[0]))
                    end.append(diagonal + int(inside_any[-1]))
            kept = batch.select(["row", "doc_id", "item_id", "n"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(matched, pa.int64()), pa.array(begin, pa.int64()), pa.array(end, pa.int64())],
                ["row", "doc_id", "item_id", "n", "matched", "first_word", "last_word"])

    return pairs.mapInArrow(run, "row bigint, doc_id bigint, item_id bigint, n int, matched bigint, "
                                 "first_word bigint, last_word bigint")


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 13, similarity: float = 0.8,
             masks: tuple = MASKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every (document row, item) that overlaps: row, doc_id, item_id, n, matched, first_word, last_word.

    The words are counted from 0 in the document; `matched` counts agreeing words in the span."""
    ship(docs.sparkSession)
    items = written(_items(benchmark, "item_id", "text"), "items")
    # Lengths below the window or the longest mask: a handful at most.
    short = F.col("n") < max(window, *map(len, masks))
    lengths = [r[0] for r in items.where(short).select("n").distinct().collect()]
    own = {n: masks_of_length(n, similarity) for n in sorted(lengths)}
    item_seeds = written(_item_seeds(items, masks, own), "seeds")
    masks = list(dict.fromkeys([*masks, *(mask for n in own for mask, _ in own[n])]))
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    candidates = written(_candidates(rows, masks, _bit_tables(item_seeds)), "candidates")
    hits = candidates.select("row", F.explode(F.arrays_zip("seeds", "places")).alias("h")).select(
        "row", F.col("h.seeds").alias("seed"), F.col("h.places").alias("place"))
    diagonals = hits.join(item_seeds, "seed").select(
        "row", "item_id", "n", (F.col("place") - F.col("at")).alias("diagonal")).distinct()
    aligned = candidates.select("row", "doc_id", F.col("words").alias("doc_words")).join(diagonals, "row").select(
        "row", "doc_id", "item_id", "diagonal",
        F.expr("slice(doc_words, cast(greatest(diagonal, 0) as int) + 1, n)").alias("part"))
    pairs = aligned.join(items.select("item_id", "words", "n"), "item_id")
    found = _verified(pairs, window, similarity)
    return found.groupBy("row", "doc_id", "item_id", "n").agg(
        F.max("matched").alias("matched"), F.min("first_word").alias("first_word"),
        F.max("last_word").alias("last_word"))


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per contaminated document row: doc_id, n_items, items (sorted), the item with the most
    agreeing words (then the smallest id) as item_id, matched, item_words, and the words' span."""
    best = F.struct(-F.col("matched"), F.col("item_id"))
    return overlaps(docs, benchmark, **options).groupBy("row", "doc_id").agg(
        F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("items"),
        F.min_by("item_id", best).alias("item_id"), F.min_by("matched", best).alias("matched"),
        F.min_by("n", best).alias("item_words"), F.min("first_word").alias("first_word"),
        F.max("last_word").alias("last_word")).drop("row")


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that aren't contaminated, all columns as given. Each row goes or stays by its own text, whatever
    rows share its id; rows are told apart by a 64-bit hash of id and text."""
    row = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    marked = docs.select(row.alias("doc_id"), "text")
    dirty = written(contaminated(marked, benchmark, **options).select(F.col("doc_id").alias("__dirty")).distinct(), "dirty")
    return docs.join(dirty, row == F.col("__dirty"), "left_anti")
