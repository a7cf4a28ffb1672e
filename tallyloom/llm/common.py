"""What several operators share: tables, shared files, hashed words."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import checked_broadcast, open_store, shared_root

GOLDEN = np.uint64(0x9E3779B97F4A7C15)

#: A column name that no table is expected to have.
KEY = "__corpus_key__"
#: Bytes of rows that Spark hands a Python worker at once.
BATCH_BYTES = 4_000_000
#: Ids are broadcast up to this number (8 MB of ids), and joined by a shuffle beyond it.
MOST_BROADCAST_IDS = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(column: str) -> Column:
    """The text column as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without_ids(df: DataFrame, id_column: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose id (null included) is not among those of the one-column frame ``ids``, all columns as they are."""
    some = checked_broadcast(ids.toDF(KEY).distinct(), MOST_BROADCAST_IDS)
    return df.join(some, F.col(id_column).eqNullSafe(F.col(KEY)), "left_anti")


def small_batches(spark: SparkSession) -> None:
    """Hand Python workers few bytes at once: a batch is there in Spark, in Arrow and in Python, for every task of an executor."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


# --- files in the shared folder -----------------------------------------------------------


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that all executors share."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_whole(folder: str, name: str, data) -> str:
    """Write a file under a name no other attempt of the task uses, and return its URI.

    A task that is run again writes another file; readers only follow the names that a
    successful task has returned, so files of lost attempts are never read.
    """
    uri = f"{folder}/{name}-{uuid.uuid4().hex[:12]}"
    store, path = open_store(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(path) as out:
        out.write(data)
    return uri


def read_range(uri: str, start: int = 0, length: int | None = None) -> bytes:
    store, path = open_store(uri)
    with store.open_input_file(path) as file:
        if length is None:
            return file.read()
        file.seek(start)
        return file.read(length)


# --- inside tasks -------------------------------------------------------------------------


def process_memo(name: str, make):
    """An object that a Python worker keeps from task to task, until another operator keeps one there."""
    kept = sys.modules.setdefault("_process_memo", types.ModuleType("_process_memo")).__dict__.setdefault("kept", {})
    if name not in kept:
        kept.clear()
        kept[name] = make()
    return kept[name]


def forget_memos() -> None:
    """Let go what other operators have kept in this worker."""
    if "_process_memo" in sys.modules:
        sys.modules["_process_memo"].__dict__.get("kept", {}).clear()
        pa.default_memory_pool().release_unused()


class BoundedMemo(dict):
    """A dictionary that works out missing entries and keeps at most ``most`` of them.

    When half as many are held they become the older ones, which the next half replaces;
    entries that are asked for meanwhile are taken over, so frequent ones stay.
    """

    def __init__(self, work, most: int):
        super().__init__()
        self.work, self.half, self.older = work, max(most // 2, 1), {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.work(key)
        if len(self) >= self.half:
            self.older = dict(self)
            super().clear()
        self[key] = value
        return value

    def clear(self) -> None:
        super().clear()
        self.older = {}


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


def hashed_words(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words (runs without white space) of all texts, and where each text starts."""
    memo = process_memo("word_hash", lambda: BoundedMemo(word_hash, 400_000))
    look, parts, starts, total = memo.__getitem__, [], [0], 0
    for text in texts:
        words = text.lower().split()
        parts.append(np.fromiter(map(look, words), np.uint64, len(words)))
        total += len(words)
        starts.append(total)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.array(starts, np.int64)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well-mixed 64-bit permutation of each value, another one for each seed."""
    with np.errstate(over="ignore"):
        z = values + GOLDEN * np.uint64(2 * seed + 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def shingle_hashes(words: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words in each text; a shorter, non-empty text is one shingle.

    Returns the hashes of all texts in order and where each text starts.
    """
    lengths = np.diff(starts)
    counts = np.where(lengths >= size, lengths - size + 1, (lengths > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    owner = np.repeat(np.arange(len(lengths)), counts)
    at = np.arange(first[-1]) - first[owner] + starts[owner] if len(owner) else np.zeros(0, np.int64)
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            here = at + i
            inside = here < starts[owner + 1] if len(owner) else np.zeros(0, bool)
            value = np.where(inside, words[np.minimum(here, max(len(words) - 1, 0))] if len(words) else 0, 0)
            out = (out ^ value.astype(np.uint64)) * np.uint64(0x9FB21C651E98DF25)
            out ^= out >> np.uint64(32)
    return out, first


def slices(batch, column: str, most_bytes: int = 16_000_000):
    """An Arrow batch in runs of rows whose texts hold about ``most_bytes`` at most (one row at least).

    What Arrow took for a run is given back to the system before the next one.
    """
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(sizes):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + most_bytes, "right")))
        yield batch.slice(start, stop - start)
        pa.default_memory_pool().release_unused()
        start = stop
