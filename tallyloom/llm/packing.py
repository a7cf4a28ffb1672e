"""Packing token pieces into sequences, with certified lower bounds (operator 3)."""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import documents, slices, text_or_empty
from tallyloom.llm.tokens import encoder
from tallyloom.session import stage

ITEMS_PER_GROUP = 4000


def token_pieces(
    df: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, keep_ids: bool = False,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of each row's token ids, cut every ``capacity`` ids.

    A row's ids are those of its whole text and then ``end_id``; a null text counts as
    empty, so every row has a piece.
    """
    rows = df.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        for whole in batches:
            for batch in slices(whole, "text", 2_000_000):
                owner, piece, length, crc, kept = [], [], [], [], []
                for row, ids in enumerate(encoder(tokenizer).encode_all(batch.column("text"))):
                    view = memoryview(ids + end)
                    for at in range(0, len(view), 4 * capacity):
                        part = view[at : at + 4 * capacity]
                        owner.append(row)
                        piece.append(at // (4 * capacity))
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if keep_ids:
                            kept.append(bytes(part))
                columns = {
                    "doc_id": batch.column("doc_id").take(pa.array(owner, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array([p * capacity for p in piece], pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
                yield pa.record_batch(columns | ({"ids": pa.array(kept, pa.binary())} if keep_ids else {}))

    return rows.mapInArrow(cut, schema)


def bin_bound(sizes: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """A lower bound on the bins that hold ``sizes`` (each ``counts`` times), from two families of dual feasible functions.

    The first drops sizes below a threshold and rounds those that leave less than the
    threshold up to a whole bin; the second rounds a size down to steps of 1/k, except
    where k + 1 of it are whole bins.
    """
    if not len(sizes):
        return 0
    order = np.argsort(sizes, kind="stable")
    ordered = sizes[order].astype(np.int64)
    counts = np.ones(len(sizes), np.int64) if counts is None else counts[order].astype(np.int64)
    sums, many = np.concatenate([[0], np.cumsum(ordered * counts)]), np.concatenate([[0], np.cumsum(counts)])
    least = np.unique(np.concatenate([[0], ordered[ordered <= capacity // 2]]))
    low, high = np.searchsorted(ordered, least), np.searchsorted(ordered, capacity - least, "right")
    weight = int((sums[high] - sums[low] + capacity * (many[-1] - many[high])).max())
    best = -(-weight // capacity)
    for k in range(1, 21):
        times = (k + 1) * ordered
        # k * capacity times the function: size * k where exact, else floor(times / capacity) * capacity
        weight = int((np.where(times % capacity == 0, ordered * k, times // capacity * capacity) * counts).sum())
        best = max(best, -(-weight // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Each item's bin and its place there, and the number of bins."""
    bins, places = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    open_bins: list[tuple[int, int]] = []  # (room, bin), by room
    used = 0
    for item in np.argsort(-sizes, kind="stable"):
        size = int(sizes[item])
        at = bisect_left(open_bins, (size, -1))
        if at < len(open_bins):
            room, number = open_bins.pop(at)
        else:
            room, number, used = capacity, used, used + 1
        bins[item], places[item] = number, capacity - room
        if room > size:
            insort(open_bins, (room - size, number))
    return bins, places, used


def pack(pieces: DataFrame, capacity: int = 4096, slack: int = 8) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) with ``sequence_id``, ``offset`` and ``certified``.

    Pieces are dealt to groups of a bounded size, each packed by best-fit decreasing in a
    task. A group is certified when its bins are as few as its lower bound, and stays as it
    is. Of the others, bins that are filled up to ``slack`` stay; the pieces of the rest are
    exchanged, that is, dealt anew to fewer groups together with those of other groups, until
    all groups are certified or a round saves no bin. Full pieces are sequences by themselves.
    An empty input gives an empty result; repeated rows are packed each. Columns of any
    name but those of the result stay.
    """
    columns = [f"`{c}`" for c in pieces.columns if c not in ("sequence_id", "offset", "certified")]
    whole = F.struct(*columns).alias("piece")
    staged = stage(pieces.select(whole, F.col("length"), F.monotonically_increasing_id().alias("row")))
    result = ["piece.*", "sequence_id", "offset", "certified"]
    full = staged.where(F.col("length") >= capacity)
    done = [full.select("piece", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified")).select(result)]
    # Only rows' numbers and lengths go through the rounds.
    left = staged.where(F.col("length") < capacity).select("row", "length")
    held, bins, number = None, None, 0
    placed = []
    while True:
        groups = max(1, math.ceil(left.count() / ITEMS_PER_GROUP))
        dealt = left.withColumn("group", F.pmod(F.xxhash64("row", F.lit(number)), F.lit(groups)))
        tried = stage(dealt.groupBy("group").applyInPandas(packer(number, capacity, slack), PACKED))
        used = tried.where("offset = 0").count()
        if bins is not None and used >= bins:
            placed.append(held)
            break
        placed.append(tried.where("NOT loose"))
        held = tried.where("loose")
        bins = held.where("offset = 0").count()
        if not bins:
            break
        left, number = held.select("row", "length"), number + 1
    every = placed[0]
    for frame in placed[1:]:
        every = every.unionByName(frame)
    packed = staged.join(every.select("row", "sequence_id", "offset", "certified"), "row").select(result)
    return done[0].unionByName(packed)


PACKED = "row long, length long, sequence_id long, offset long, certified boolean, loose boolean"


def packer(number: int, capacity: int, slack: int):
    """Packs a group; ``loose`` are the pieces of unfilled bins of a group that is not certified."""

    def packed(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        # In an order of their own, so that a task that is run again packs alike.
        items = items.sort_values("row", ignore_index=True)
        sizes = items["length"].to_numpy()
        bins, places, used = best_fit_decreasing(sizes, capacity)
        filled = np.bincount(bins, weights=sizes, minlength=used)
        certified = bool(used == bin_bound(sizes, capacity))
        return pd.DataFrame({
            "row": items["row"], "length": sizes, "sequence_id": (((number << 36) + int(key[0])) << 20) + bins, "offset": places,
            "certified": certified, "loose": (filled[bins] < capacity - slack) & (not certified),
        })

    return packed


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, lengths`` of a packing made with ``keep_ids``; a sequence holds at most ``capacity`` ids."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return packed.groupBy("sequence_id").agg(placed.alias("_p")).select(
        "sequence_id",
        F.expr("aggregate(_p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"),
        F.col("_p.doc_id").alias("doc_ids"),
        F.col("_p.length").alias("lengths"),
    )


def certificate(packed: DataFrame, capacity: int = 4096) -> DataFrame:
    """One row: ``sequences``, and ``bound``, below which no packing of these pieces can go.

    Gathered from the counts of the at most ``capacity`` different lengths.
    """
    counts = packed.groupBy("length").agg(F.count("*").alias("n"))
    # One row, also of an empty packing.
    one = counts.agg(F.sort_array(F.collect_list(F.struct("length", "n"))).alias("counts"))
    sequences_ = packed.where("offset = 0").agg(F.count("*").alias("sequences")).first()["sequences"]

    def bound(batches):
        for rows in batches:
            for held in rows["counts"]:
                sizes, times = ([int(r[k]) for r in held] for k in ("length", "n"))
                found = bin_bound(np.array(sizes, np.int64), capacity, np.array(times, np.int64)) if sizes else 0
                yield pd.DataFrame({"sequences": [sequences_], "bound": [found]})

    return one.mapInPandas(bound, "sequences long, bound long")


def op3_bound_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = token_pieces(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pack(pieces)
