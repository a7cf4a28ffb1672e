"""Exact copies by exchange of Golomb-coded fingerprints (operator 5)."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import KEY, MOST_BROADCAST_IDS, documents, shuffle_partitions, slices, text_or_empty, without_ids
from tallyloom.session import checked_broadcast, stage

#: ASCII capitals to small letters, nothing else.
FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
ROWS_PER_LIST = 1_000_000
HASHES_PER_OWNER = 500_000


def folded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(FOLD)


# --- Golomb-Rice coding of sorted hashes ----------------------------------------------------


def golomb(sorted_hashes: np.ndarray) -> tuple[int, bytes, bytes]:
    """The shift, the unary quotients and the remainders of the gaps between sorted, distinct 64-bit hashes."""
    gaps = np.diff(sorted_hashes, prepend=np.uint64(0))
    mean = int(sorted_hashes[-1]) // len(gaps) if len(gaps) else 1
    shift = max(0, mean.bit_length() - 1)
    quotients = (gaps >> np.uint64(shift)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends] = 1
    bits = np.unpackbits(gaps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - shift :]
    return shift, np.packbits(unary).tobytes(), np.packbits(bits).tobytes()


def from_golomb(count: int, shift: int, unary: bytes, remainders: bytes) -> np.ndarray:
    if not count:
        return np.zeros(0, np.uint64)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:count]
    quotients = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    bits = np.unpackbits(np.frombuffer(remainders, np.uint8), count=count * shift).reshape(count, shift)
    wide = np.zeros((count, 64), np.uint8)
    wide[:, 64 - shift :] = bits
    low = np.packbits(wide, axis=1).view(">u8").ravel().astype(np.uint64)
    return np.cumsum((quotients << np.uint64(shift)) | low, dtype=np.uint64)


# --- the exchange ---------------------------------------------------------------------------


def hashed(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``row, doc_id, digest``: the SHA-256 of each row's folded text, staged so that row numbers stay."""
    rows = df.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))

    def digest(batches):
        for whole in batches:
            for batch in slices(whole, "text", 4_000_000):
                found = [hashlib.sha256(folded(t)).digest() for t in batch.column("text").to_pylist()]
                yield pa.record_batch({"doc_id": batch.column("doc_id"), "digest": pa.array(found, pa.binary())})

    kind = rows.schema["doc_id"].dataType.simpleString()
    return stage(rows.mapInArrow(digest, f"doc_id {kind}, digest binary").withColumn("row", F.monotonically_increasing_id()))


def send_lists(rows: DataFrame, owners: int) -> DataFrame:
    """From each partition to each owner the sorted, coded fingerprints of its share of the hash space.

    A fingerprint is the first eight bytes of the digest. Each list keeps, for its
    sender, how often each fingerprint occurs there and in which rows.
    """
    width = -(-(1 << 64) // owners)

    def send(batches):
        part, number, held = TaskContext.get().partitionId(), 0, []

        def lists(frames):
            table = pa.Table.from_batches(frames)
            marks = np.frombuffer(b"".join(d[:8] for d in table.column("digest").to_pylist()), ">u8").astype(np.uint64)
            order = np.argsort(marks, kind="stable")
            marks, places = marks[order], table.column("row").to_numpy()[order].astype("<i8")
            owner = (marks // np.uint64(width)).astype(np.int64) if owners > 1 else np.zeros(len(marks), np.int64)
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            for start, stop in zip(starts, [*starts[1:], len(owner)]):
                distinct, counts = np.unique(marks[start:stop], return_counts=True)
                shift, unary, rest = golomb(distinct - np.uint64(int(owner[start]) * width))
                yield {
                    "sender": f"{part}-{number}", "owner": int(owner[start]), "n": len(distinct), "shift": shift, "unary": unary, "rest": rest,
                    "counts": counts.astype("<u4").tobytes(), "rows": places[start:stop].tobytes(),
                }

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= ROWS_PER_LIST:
                yield pa.RecordBatch.from_pylist(list(lists(held)), LISTS)
                number, held = number + 1, []
        if sum(b.num_rows for b in held):
            yield pa.RecordBatch.from_pylist(list(lists(held)), LISTS)

    LISTS = pa.schema([("sender", pa.string()), ("owner", pa.int64()), ("n", pa.int64()), ("shift", pa.int32()), ("unary", pa.binary()), ("rest", pa.binary()), ("counts", pa.binary()), ("rows", pa.binary())])
    return rows.mapInArrow(send, "sender string, owner long, n long, shift int, unary binary, rest binary, counts binary, rows binary")


def reply(lists: DataFrame) -> DataFrame:
    """``sender, owner, shared``: for each list a bitmap of the fingerprints that another list holds too."""

    def shared(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        found = [from_golomb(n, s, u, r) for n, s, u, r in zip(held["n"], held["shift"], held["unary"], held["rest"])]
        marks, counts = np.unique(np.concatenate(found), return_counts=True)
        repeated = marks[counts > 1]
        return pd.DataFrame({"sender": held["sender"], "owner": held["owner"], "shared": [np.packbits(np.isin(f, repeated)).tobytes() for f in found]})

    sent = lists.select("owner", "sender", "n", "shift", "unary", "rest")
    return sent.groupBy("owner").applyInPandas(shared, "sender string, owner long, shared binary")


def suspect_rows(lists: DataFrame, replies: DataFrame) -> DataFrame:
    """The rows whose fingerprint occurs in another list, or more than once in their own."""

    def pick(batches):
        for batch in batches:
            for n, shared, counts, rows in zip(*(batch.column(c).to_pylist() for c in ("n", "shared", "counts", "rows"))):
                counts = np.frombuffer(counts, "<u4")
                flags = np.unpackbits(np.frombuffer(shared, np.uint8), count=n).astype(bool) | (counts > 1)
                yield pa.record_batch({"row": pa.array(np.frombuffer(rows, "<i8")[np.repeat(flags, counts)])})

    kept = lists.select("sender", "owner", "n", "counts", "rows").join(replies, ["sender", "owner"])
    return kept.mapInArrow(pick, "row long")


def texts_of(df: DataFrame, ids: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``digest, body`` of the rows that have one of the ids; the ids are broadcast only if they are few."""
    rows = df.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    some = checked_broadcast(ids.select(F.col("doc_id").alias(KEY)).distinct(), MOST_BROADCAST_IDS)

    def fold(batches):
        for batch in batches:
            bodies = [folded(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"digest": pa.array([hashlib.sha256(b).digest() for b in bodies], pa.binary()), "body": pa.array(bodies, pa.binary())})

    return rows.join(some, F.col("doc_id").eqNullSafe(F.col(KEY)), "left_semi").mapInArrow(fold, "digest binary, body binary")


def find_copies(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty.
    The row with the largest id of each group stays; a null id is the smallest, and of
    rows with the same id and text one stays. Partitions send their sorted fingerprints,
    Golomb-coded, to the owners of the hash ranges and get back which of them others hold
    too; only the rows of those suspects are grouped, and only their texts move to be
    compared byte by byte. Two different texts with one SHA-256 would stop the job.
    """
    spark = df.sparkSession
    rows = hashed(df, id_column, text_column)
    owners = max(shuffle_partitions(spark), math.ceil(rows.count() / HASHES_PER_OWNER))
    lists = stage(send_lists(rows, owners))
    suspects = stage(rows.join(suspect_rows(lists, reply(lists)), "row"))
    groups = suspects.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("top")).where("n > 1")
    bodies = texts_of(df, suspects, id_column, text_column).groupBy("digest", "body").agg(F.count("*").alias("_n"))
    bodies = bodies.groupBy("digest").agg(F.count("*").alias("variants"))
    one = F.when(F.col("variants") == 1, F.col("n")).otherwise(F.raise_error(F.lit("different texts have one SHA-256")).cast("long"))
    verified = groups.join(bodies, "digest").select("digest", F.col("top.doc_id").alias("keep_id"), F.col("top.row").alias("_keep"), one.alias("n"))
    alone = F.col("n").isNull()
    return rows.join(verified, "digest", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("_keep"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.

    Ids of which all rows go are left out by an anti join. Where an id has rows that stay
    and rows that go, those rows are told apart by their texts, and of equal ones one stays.
    """
    found = stage(find_copies(df, id_column, text_column))
    per_id = found.groupBy("doc_id").agg(F.count("*").alias("_n"), F.sum(F.col("kept").cast("long")).alias("_k")).where("_k < _n")
    per_id = stage(per_id.select(F.col("doc_id").alias(KEY), "_k"))
    out = without_ids(df, id_column, per_id.select(KEY))
    mixed = per_id.where("_k > 0").select(KEY)
    if mixed.isEmpty():
        return out
    same = F.col("doc_id").eqNullSafe(F.col(KEY))
    wanted = found.where("kept").join(mixed, same, "left_semi").select(F.col("doc_id").alias(KEY), F.col("text_sha256").alias("_digest"))
    capitals = F.translate(text_or_empty(text_column), bytes(range(65, 91)).decode(), bytes(range(97, 123)).decode())
    some = df.select(F.col(id_column).alias("doc_id"), F.sha2(F.encode(capitals, "UTF-8"), 256).alias("digest"), F.struct("*").alias("whole"))
    some = some.join(mixed, same, "left_semi").join(wanted, same & (F.col("digest") == F.col("_digest")), "left_semi")
    return out.unionByName(some.dropDuplicates(["doc_id", "digest"]).select("whole.*"))


def op5_golomb_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(documents(spark, sf_dir))


#: SQL has A-Z lower-casing as a translation; DuckDB's max of ids picks the row that stays.
SQL = """
WITH t AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
