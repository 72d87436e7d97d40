"""What the operators share: written intermediates, skew-safe lookups, words of Arrow text."""

from __future__ import annotations

import atexit
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Deletes of a set of characters: the white space of every contract, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CHUNK = 4 << 20  # bytes of text handled at once; one longer text is handled alone

_roots: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the library to the Python workers, as --py-files would, once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp(prefix="urlgauge-py-")) / "urlgauge.zip"
        with zipfile.ZipFile(path, "w") as bundle:
            for file in sorted(package.rglob("*.py")):
                bundle.write(file, file.relative_to(package.parent))
        sc.addPyFile(str(path))
        _shipped.add(sc.applicationId)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001 - the session may be gone; the shared folder's owner cleans up then
        pass


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application inside `spark.checkpoint.dir`, removed at exit.

    A local session without that setting falls back on a temporary folder; a cluster may not."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise RuntimeError("Set spark.checkpoint.dir to a folder all executors can reach.")
            base = tempfile.mkdtemp(prefix="urlgauge-llm-")
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(base)
        _roots[app] = f"{base}/llm-{app}-{uuid4().hex[:8]}"
        atexit.register(_remove, spark, _roots[app])
    return _roots[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back: a cut in the lineage that
    survives lost executors and keeps column pruning and statistics."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a table made by `written`, once everything made from it is written, too."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        _remove(df.sparkSession, path)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (rows + 1, from 0) of a string array; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[pa.Array]:
    """Slices of whole rows with about `limit` bytes of text each."""
    _, at = text_buffer(column)
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
        yield column.slice(start, end - start)
        start = end


def word_spans(data: np.ndarray, at: np.ndarray, is_word: np.ndarray):
    """Starts and ends (bytes) and row of every maximal run of word bytes; rows are never joined."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = is_word[data]
    full = at[1:] > at[:-1]
    before = np.empty(len(data), bool)
    before[1:] = word[:-1]
    before[at[:-1][full]] = False
    after = np.empty(len(data), bool)
    after[:-1] = word[1:]
    after[at[1:][full] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (uint64), so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hasher:
    """64-bit hashes of byte ranges of one buffer, from one running polynomial sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        powers = np.full(n + 1, _BASE, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=self.total[1:])
        back = np.full(n + 1, _INVERSE, np.uint64)
        back[0] = 1
        self.back = np.cumprod(back, out=back)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.total[ends] - self.total[starts]) * self.back[starts]
        return mix64(h ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))
