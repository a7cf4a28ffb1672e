"""Token ids in word-aligned Simple-8b files (operator 8).

A file holds the ids of a run of documents: a head, 64-bit words in blocks of
``BLOCK`` ids, the offset of each block, and the documents' ids and lengths. The top four
bits of a word select how many values of how many bits it packs; selector 0 says that the
next word is one value of up to 64 bits.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import documents, read_range, shared_folder, slices, text_or_empty, write_whole
from tallyloom.llm.tokens import encoder
from tallyloom.session import stage

#: Values per word for each bit width of a selector (fixed values of the format).
WIDTH_COUNTS = ((1, 60), (2, 30), (3, 20), (4, 15), (5, 12), (6, 10), (7, 8), (8, 7), (10, 6), (12, 5), (15, 4), (20, 3), (30, 2), (60, 1))
ESCAPE = 0
BLOCK = 4096
MAGIC = b"S8B-IDS1"
HEAD = "<8sQQQQ"  # magic, ids, words, blocks, documents
HEAD_BYTES = struct.calcsize(HEAD)
IDS_PER_FILE = 4_000_000


def choose(values: np.ndarray, block: int) -> np.ndarray:
    """For each place the count that a word starting there would pack, within its block; 0 for an escape."""
    n = len(values)
    room = np.minimum(block - np.arange(n) % block, n - np.arange(n))
    room = np.minimum(room, 255).astype(np.uint8)
    best = np.zeros(n, np.uint8)
    for width, count in reversed(WIDTH_COUNTS):  # rising counts
        if count > n:
            break
        # run[i]: the next ``have`` values fit
        run, have = values < np.uint64(1 << width), 1
        while have < count:
            step = min(have, count - have)
            run = np.concatenate([run[: n - step] & run[step:], np.zeros(step, bool)])
            have += step
        run &= room >= count
        np.maximum(best, run.view(np.uint8) * np.uint8(count), out=best)
    return best


def encode_blocks(values: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    counts = choose(values, block).tobytes()
    starts, at, n = [], 0, len(values)
    while at < n:
        starts.append(at)
        at += counts[at] or 1
    starts = np.array(starts, np.int64)
    kinds = np.frombuffer(counts, np.uint8)[starts]
    places = np.concatenate([[0], np.cumsum(1 + (kinds == 0))]).astype(np.int64)
    words = np.zeros(places[-1], np.uint64)
    for selector, (width, count) in enumerate(WIDTH_COUNTS, 1):
        chosen = np.flatnonzero(kinds == count)
        if not len(chosen):
            continue
        word, first = np.full(len(chosen), selector << 60, np.uint64), starts[chosen]
        for i in range(count):
            word |= values[first + i] << np.uint64(i * width)
        words[places[chosen]] = word
    escaped = np.flatnonzero(kinds == 0)
    words[places[escaped] + 1] = values[starts[escaped]]
    return words, places[np.searchsorted(starts, np.arange(0, n, block))]


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The words of ``values``, and for each block the number of words before it."""
    values = values.astype(np.uint64)
    words, offsets, before = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for start in range(0, len(values), 8 * block):  # a few blocks at a time stay in the processor's cache
        some, places = encode_blocks(values[start : start + 8 * block], block)
        words.append(some)
        offsets.append(places + before)
        before += len(some)
    return np.concatenate(words), np.concatenate(offsets).astype(np.uint64)


def decode(words: np.ndarray) -> np.ndarray:
    """The values of whole blocks, all words of a selector at once."""
    selectors = (words >> np.uint64(60)).astype(np.uint8)
    raw = np.zeros(len(words), bool)
    if (selectors == ESCAPE).any():  # the word after an escape is a value, whatever its top bits are
        at = 0
        candidates = np.flatnonzero(selectors == ESCAPE)
        for place in candidates:
            if place >= at:
                raw[place + 1] = True
                at = place + 2
    counts = np.array([1, *(c for _, c in WIDTH_COUNTS), 0], np.int64)[selectors]
    counts[raw] = 0
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for selector, (width, count) in enumerate(WIDTH_COUNTS, 1):
        chosen = np.flatnonzero((selectors == selector) & ~raw)
        first, word = ends[chosen] - count, words[chosen]
        for i in range(count):
            out[first + i] = (word >> np.uint64(i * width)) & np.uint64((1 << width) - 1)
    escapes = np.flatnonzero((selectors == ESCAPE) & ~raw)
    out[ends[escapes] - 1] = words[escapes + 1]
    return out


def file_bytes(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    words, offsets = encode(ids)
    return b"".join((
        struct.pack(HEAD, MAGIC, len(ids), len(words), len(offsets), len(doc_ids)),
        words.astype("<u8").tobytes(), offsets.astype("<u8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.array(lengths, "<u8").tobytes(),
    ))


def read_file(uri: str) -> tuple[np.ndarray, list[int | None], np.ndarray]:
    """Ids of all documents of a file, the documents' ids, and their lengths."""
    data = read_range(uri)
    magic, n_ids, n_words, n_blocks, n_docs = struct.unpack_from(HEAD, data)
    if magic != MAGIC:
        raise ValueError(f"{uri} is no id file")
    at = HEAD_BYTES
    words = np.frombuffer(data, "<u8", n_words, at)
    at += 8 * (n_words + n_blocks)
    keys, at = np.frombuffer(data, "<i8", n_docs, at), at + 8 * n_docs
    nulls, at = np.frombuffer(data, np.uint8, n_docs, at), at + n_docs
    lengths = np.frombuffer(data, "<u8", n_docs, at).astype(np.int64)
    ids = decode(words)
    if len(ids) != n_ids:
        raise ValueError(f"{uri} holds {len(ids)} ids instead of {n_ids}")
    return ids, [None if null else key for key, null in zip(keys.tolist(), nulls.tolist())], lengths


def read_block(uri: str, block: int) -> np.ndarray:
    """The ids of one block, by two range reads."""
    _, n_ids, n_words, n_blocks, _ = struct.unpack(HEAD, read_range(uri, 0, HEAD_BYTES))
    at = HEAD_BYTES + 8 * n_words
    ends = np.frombuffer(read_range(uri, at + 8 * block, 16 if block + 1 < n_blocks else 8), "<u8").tolist()
    first, last = ends[0], ends[1] if len(ends) > 1 else n_words
    return decode(np.frombuffer(read_range(uri, HEAD_BYTES + 8 * first, 8 * (last - first)), "<u8"))


def write_ids(
    df: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Write the ids of all texts in ascending order of the id, and return the written files.

    ``part, file, uri, documents, ids, first_id``: ``first_id`` counts the ids in all
    files before. Rows are ordered by ranges of the id, so each task writes files that
    follow one another; nulls come first, and rows with the same id follow one another in
    the order of their texts. A file holds about ``IDS_PER_FILE`` ids, or one document.
    """
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def write(batches):
        part, number = TaskContext.get().partitionId(), 0
        parts, docs, lengths, held = [], [], [], 0

        def flush():
            ids = np.frombuffer(b"".join(parts), "<u4")
            uri = write_whole(folder, f"ids-{part:06d}-{number:04d}", file_bytes(ids, docs, lengths))
            return pa.RecordBatch.from_pylist([{"part": part, "file": number, "uri": uri, "documents": len(docs), "ids": len(ids)}], MADE)

        for whole in batches:
            for batch in slices(whole, "text"):
                for key, ids in zip(batch.column("doc_id").to_pylist(), encoder(tokenizer).encode_all(batch.column("text"))):
                    parts.append(ids + end)
                    docs.append(key)
                    lengths.append(len(parts[-1]) // 4)
                    held += lengths[-1]
                    if held >= IDS_PER_FILE:
                        yield flush()
                        number, held = number + 1, 0
                        parts, docs, lengths = [], [], []
        if docs:
            yield flush()

    MADE = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("uri", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])
    files = stage(rows.mapInArrow(write, "part int, file int, uri string, documents long, ids long"))
    # One row a part in the window without a key, then the files of a part.
    parts = files.groupBy("part").agg(F.sum("ids").alias("n")).withColumn("_b", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = F.coalesce(F.sum("ids").over(Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.join(parts.select("part", "_b"), "part").withColumn("first_id", F.col("_b") + before).drop("_b")


def read_documents(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the written files (``ids``: unsigned 32-bit)."""

    def read(batches):
        for batch in batches:
            for uri, first in zip(batch.column("uri").to_pylist(), batch.column("first_id").to_pylist()):
                ids, docs, lengths = read_file(uri)
                ends = np.cumsum(lengths)
                flat = ids.astype("<u4")
                for at in range(0, len(docs), 2000):
                    some = slice(at, at + 2000)
                    yield pa.record_batch({
                        "doc_id": pa.array(docs[some], pa.int64()),
                        "start": pa.array(first + ends[some] - lengths[some], pa.int64()),
                        "n_tokens": pa.array(lengths[some], pa.int64()),
                        "ids": pa.array([flat[e - n : e].tobytes() for e, n in zip(ends[some].tolist(), lengths[some].tolist())], pa.binary()),
                    })

    spread = files.select("uri", "first_id").repartition(max(1, files.sparkSession.sparkContext.defaultParallelism * 4), "uri")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def with_crc(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_simple8b_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = write_ids(documents(spark, sf_dir), shared_folder(spark, "ids"), public_tokenizers.path("byte_bpe_50k.json"))
    return with_crc(read_documents(files))
