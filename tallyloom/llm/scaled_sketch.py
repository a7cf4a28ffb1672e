"""Threshold-scaled sketches of documents (operator 7)."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import KEY, documents, mixed, shuffle_partitions, text_or_empty
from tallyloom.session import stage

SHINGLE = 16
#: One in so many shingle hashes lies below the threshold.
SCALE = 64
#: So many of the smallest hashes stay even above the threshold, for short texts.
FLOOR = 32
DIGITS = 12


def sketch(text: str, scale: int = SCALE, shingle: int = SHINGLE, floor: int = FLOOR) -> np.ndarray:
    """The sorted 48-bit hashes of all runs of ``shingle`` code points that lie below the threshold, and the ``floor`` smallest.

    A shorter text is one shingle; an empty one has none.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(points):
        return points
    count = max(1, len(points) - shingle + 1)
    rolled = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(shingle, len(points))):
            rolled = rolled * np.uint64(0x9FB21C651E98DF25) + points[i : i + count]
    hashes = mixed(rolled) >> np.uint64(64 - 4 * DIGITS)
    below = np.unique(hashes[hashes < np.uint64((1 << 4 * DIGITS) // scale)])
    if len(below) >= floor:
        return below
    return np.unique(hashes)[:floor]


def as_text(hashes: np.ndarray) -> str:
    raw = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - DIGITS // 2 :]
    return raw.tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(-1, DIGITS // 2)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 8 - DIGITS // 2 :] = raw
    return wide.view(">u8").ravel().astype(np.uint64)


def merge(one: np.ndarray, two: np.ndarray, scale: int = SCALE, floor: int = FLOOR) -> np.ndarray:
    """The sketch of both shingle sets together."""
    both = np.union1d(one, two)
    below = both[both < np.uint64((1 << 4 * DIGITS) // scale)]
    return below if len(below) >= floor else both[:floor]


def containment(one: np.ndarray, two: np.ndarray, scale: int = SCALE, floor: int = FLOOR) -> float:
    """The estimated share of the smaller text's shingles that the other one has too.

    Hashes are compared up to the limit below which both sketches are complete: the
    threshold, or the last hash of a sketch that was filled up to its floor. Two empty
    texts are alike, an empty and another are not.
    """
    if not len(one) or not len(two):
        return float(len(one) == len(two))
    limit = np.uint64(1 << 4 * DIGITS)
    for hashes in (one, two):
        if len(hashes) >= floor:  # a shorter one holds all hashes of its text
            limit = min(limit, max(np.uint64((1 << 4 * DIGITS) // scale) - np.uint64(1), hashes[-1]))
    one, two = one[one <= limit], two[two <= limit]
    least = min(len(one), len(two))
    if not least:
        return 0.0
    return len(np.intersect1d(one, two, assume_unique=True)) / least


def in_ranges(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_range``, the number of the range of ids that a row is in; nulls are in the first."""
    wanted = 2 * shuffle_partitions(rows.sparkSession)
    cuts = rows.agg(F.percentile_approx("doc_id", [i / wanted for i in range(1, wanted)], 20 * wanted).alias("c")).first()["c"]
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), np.int32)
        out[known] = np.searchsorted(cuts, ids[known].to_numpy().astype(np.int64), "left")
        return pd.Series(out)

    # As text, ids keep all their digits beside nulls.
    return rows.withColumn("_range", place(F.col("doc_id").cast("string")))


def with_neighbour_heads(rows: DataFrame) -> DataFrame:
    """``rows`` by ranges of ids, and at the end of each range a copy of the first row of the next one (after the last: of the first).

    There is one head a range, so the frames that are joined and broadcast here are as
    small as the number of ranges.
    """
    ranged = in_ranges(rows)
    least = stage(ranged.groupBy("_range").agg(F.min(F.struct("doc_id")).alias("m"))).select("_range", F.col("m.doc_id").alias(KEY))
    heads = rows.join(F.broadcast(least), F.col("doc_id").eqNullSafe(F.col(KEY)))
    heads = stage(heads.groupBy("_range").agg(F.min(F.struct("doc_id", "text")).alias("head")))
    order, all_ranges = Window.orderBy("_range"), Window.partitionBy()
    moved = heads.select(
        F.coalesce(F.lag("_range").over(order), F.max("_range").over(all_ranges)).alias("_range"), "head.doc_id", "head.text"
    ).withColumn("_guest", F.lit(True))
    return ranged.withColumn("_guest", F.lit(False)).unionByName(moved.select("doc_id", "text", "_range", "_guest"))


def fingerprint_edits(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next document's are.

    The edited text loses its last quarter (rounded down) of code points and gets as many
    from the start of the next document, or all if that is shorter. Documents follow one
    another by id, then by text (a null id comes first); after the last comes the first.
    A null text counts as empty, a single document follows itself.
    """
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    partitions = shuffle_partitions(df.sparkSession)
    ordered = with_neighbour_heads(rows).repartition(partitions, "_range").sortWithinPartitions("_range", "_guest", "doc_id", "text")

    def compare(batches):
        before = None  # key, text, sketch and range of the row before
        for batch in batches:
            out = []
            for key, text, place, guest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "_range", "_guest"))):
                own = sketch(text)
                if before is not None:
                    old, old_text, old_sketch, _ = before
                    count = len(old_text) // 4
                    edited = old_text[: len(old_text) - count] + text[:count]
                    other = sketch(edited)
                    out.append({
                        "doc_id": old, "n_chars": len(old_text), "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        "fingerprint": as_text(old_sketch), "edited_fingerprint": as_text(other),
                        "near_edited": containment(old_sketch, other), "near_next": containment(old_sketch, own),
                    })
                before = None if guest else (key, text, own, place)
            yield pa.RecordBatch.from_pylist(out, made)

    made = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])
    columns = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(compare, columns)


def op7_scaled_sketch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(documents(spark, sf_dir))
