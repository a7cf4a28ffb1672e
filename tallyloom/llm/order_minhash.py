"""Near copies by Order MinHash (operator 1).

The similarity of two texts is that of their sequences of five-word shingles, each
labelled with how often it occurred before: with m shingles in common in the same order,
m / (n + n' - m). It is a similarity by edits: n + n' - 2m shingles are put in or left
out, which is a metric.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import KEY, MOST_BROADCAST_IDS, documents, hashed_words, mixed, shingle_hashes, slices, text_or_empty, without_ids
from tallyloom.llm.components import components
from tallyloom.session import checked_broadcast, stage

WORDS = 5
SIMILARITY = 0.8
#: A sketch has HASHES tuples of PICKED shingles; texts of similarity 0.8 share one with a probability over 0.9999.
HASHES, PICKED = 14, 3
BLOCK_TEXTS, BLOCK_SHINGLES = 800, 1_000_000


def labelled(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's shingles with their occurrence numbers, and where each text starts."""
    shingles, first = shingle_hashes(words, starts, WORDS)
    owner = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    own = mixed(shingles ^ mixed(owner, 1))  # apart for each text
    order = np.argsort(own, kind="stable")
    new = np.ones(len(own), bool)
    new[1:] = own[order][1:] != own[order][:-1]
    run = np.arange(len(own)) - np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
    times = np.zeros(len(own), np.uint64)
    times[order] = run
    return mixed(shingles ^ mixed(times, 2)), first


def order_sketches(labels: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text and hash function the PICKED shingles of least hash, in the order of the text, as one number.

    A text of fewer shingles gives all it has; one without any has no use of its row.
    """
    counts = np.diff(first)
    out = np.zeros((len(counts), HASHES), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    at, owner = first[:-1][full], np.repeat(np.arange(len(full)), counts[full])
    places = np.arange(len(labels))
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    for h in range(HASHES):
        values = mixed(labels, 10 + h)
        picked = []
        for _ in range(PICKED):
            least = np.minimum.reduceat(values, at)
            hit = np.flatnonzero((values == least[owner]) & (values != top))
            place = np.full(len(full), len(labels))
            place[owner[hit][::-1]] = places[hit][::-1]
            picked.append(place)
            values[hit] = top
        ordered = np.sort(np.stack(picked, 1), axis=1)
        known = np.append(labels, np.uint64(0))
        total = np.full(len(full), h, np.uint64)
        for i in range(PICKED):
            total = mixed(total ^ known[ordered[:, i]], 3)
        out[full, h] = total
    return out


def band(n: int, m: int, threshold: float = SIMILARITY) -> float:
    """Shingles that may be put in or left out between texts of that similarity; none is moved further."""
    return (1 - threshold) / (1 + threshold) * (n + m)


def distance(one: np.ndarray, two: np.ndarray, width: float) -> int:
    """Shingles put in or left out in the best alignment with no shift beyond ``width``; above ``width`` only a lower bound, over it.

    Labelled shingles occur once in a text, so the longest common subsequence is the
    longest rising run of places among the common ones.
    """
    least = abs(len(one) - len(two))
    if least > width:
        return least
    common, here, there = np.intersect1d(one, two, assume_unique=True, return_indices=True)
    order = np.argsort(here)
    here, there = here[order], there[order]
    ends: list[int] = []
    for place in there[np.abs(here - there) <= width].tolist():
        at = bisect_left(ends, place)
        if at == len(ends):
            ends.append(place)
        else:
            ends[at] = place
    found = len(one) + len(two) - 2 * len(ends)
    return found if found <= width else int(width) + 1


def sketched(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, row, mark, n, keys``: a hash of each row's words, its shingles, and its sketch; staged."""
    rows = df.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def sketch(batches):
        for whole in batches:
            for batch in slices(whole, "text", 4_000_000):
                words, starts = hashed_words(batch.column("text").to_pylist())
                labels, first = labelled(words, starts)
                keys = order_sketches(labels, first).astype("<u8")
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id"), "mark": pa.array([xxhash.xxh3_128_digest(words[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:])], pa.binary()),
                    "n": pa.array(np.diff(first)), "keys": pa.ListArray.from_arrays(
                        pa.array(np.arange(len(keys) + 1, dtype=np.int32) * HASHES), pa.array(keys.ravel().view(np.int64))),
                })

    found = rows.mapInArrow(sketch, f"doc_id {kind}, mark binary, n long, keys array<long>")
    return stage(found.withColumn("row", F.monotonically_increasing_id()))


def sequences(df: DataFrame, rows: DataFrame, marks: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``mark, seq``: the labelled shingles (32 bits each) of the texts with one of the marks; staged."""
    wanted = checked_broadcast(rows.join(marks, "mark", "left_semi").select(F.col("doc_id").alias(KEY)).distinct(), MOST_BROADCAST_IDS)
    texts = df.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col(KEY)), "left_semi").select("text")

    def shingles(batches):
        for whole in batches:
            for batch in slices(whole, "text", 4_000_000):
                words, starts = hashed_words(batch.column("text").to_pylist())
                labels, first = labelled(words, starts)
                labels = (labels >> np.uint64(32)).astype("<u4")
                found = {}
                for i in range(len(starts) - 1):
                    found.setdefault(xxhash.xxh3_128_digest(words[starts[i] : starts[i + 1]].tobytes()), labels[first[i] : first[i + 1]].tobytes())
                yield pa.record_batch({"mark": pa.array(list(found), pa.binary()), "seq": pa.array(list(found.values()), pa.binary())})

    found = texts.mapInArrow(shingles, "mark binary, seq binary")
    return stage(found.groupBy("mark").agg(F.first("seq").alias("seq")))


def stars(texts: DataFrame) -> DataFrame:
    """``a, b``: in each bucket of a shared sketch tuple every text with the bucket's centre; staged.

    The centre is the text whose buckets are the largest altogether: of texts edited from
    one source, the one that is nearest to all.
    """
    keyed = texts.where("n > 0").select("mark", F.posexplode("keys").alias("h", "key"))
    sizes = keyed.groupBy("h", "key").agg(F.count("*").alias("size")).where("size > 1")
    held = stage(keyed.join(sizes, ["h", "key"]))
    known = held.groupBy("mark").agg(F.sum("size").alias("weight"))
    weighed = held.select("h", "key", "mark").join(known, "mark")
    centres = weighed.groupBy("h", "key").agg(F.max(F.struct("weight", "mark")).alias("top")).select("h", "key", F.col("top.mark").alias("a"))
    return stage(held.select("h", "key", F.col("mark").alias("b")).join(centres, ["h", "key"]).select("a", "b").where("a <> b").distinct())


def measured(pairs: DataFrame, seqs: DataFrame) -> DataFrame:
    """``a, b, n_a, n_b, d``: the distance of each pair, exact up to three times what a link allows; staged."""
    one, two = seqs.toDF("a", "seq_a"), seqs.toDF("b", "seq_b")

    def align(batches):
        for batch in batches:
            found = []
            for left, right in zip(batch.column("seq_a").to_pylist(), batch.column("seq_b").to_pylist()):
                left, right = np.frombuffer(left, "<u4"), np.frombuffer(right, "<u4")
                found.append((len(left), len(right), distance(left, right, 3 * band(len(left), len(right)))))
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")} | {k: pa.array(c, pa.int64()) for k, c in zip(("n_a", "n_b", "d"), columns)})

    return stage(pairs.join(two, "b").join(one, "a").select("a", "b", "seq_a", "seq_b").mapInArrow(align, "a binary, b binary, n_a long, n_b long, d long"))


def unsettled(compared: DataFrame) -> DataFrame:
    """``a, b, n_b``: of each star the texts that may be linked to one another though not both to the centre.

    By the triangle inequality a text b that is linked to the centre a has no link to any
    c that isn't if d(a,b) + t n_b < d(a,c) - t n_c, t being the share of shingles that a
    link allows. Stars whose texts are all linked, or of one unlinked text that is far, are settled.
    """
    share = band(1, 0)
    linked = F.col("d") <= share * (F.col("n_a") + F.col("n_b"))
    away = F.when(~linked, F.col("d") - share * F.col("n_b"))
    reach = compared.groupBy("a").agg(F.min(away).alias("far"), F.count(away).alias("out"))
    # One row a star; broadcast while they are few, so that a large star's texts stay spread.
    open_rows = compared.join(checked_broadcast(reach.where("out > 0"), MOST_BROADCAST_IDS), "a").where(~linked | (F.col("d") + share * F.col("n_b") >= F.col("far")))
    many = open_rows.groupBy("a").agg(F.count("*").alias("size"), F.sum("n_b").alias("shingles")).where("size > 1")
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK_TEXTS, F.col("shingles") / BLOCK_SHINGLES))
    blocks = checked_broadcast(many.select("a", blocks.cast("int").alias("blocks")), MOST_BROADCAST_IDS)
    return open_rows.select("a", "b", linked.alias("near")).join(blocks, "a")


def links_among(rows: DataFrame, seqs: DataFrame) -> DataFrame:
    """``a, b``: links among the unsettled texts of each star, enough to connect what is linked.

    A star's texts are dealt to blocks of a bounded size; a task compares two blocks (or
    one with itself) by counting common shingles, and aligns those that have enough.
    Nothing is emitted for pairs that aren't linked.
    """
    block = F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.select(F.col("a").alias("star"), "b", "near", block.alias("own"), other.alias("other"))
    dealt = dealt.select("star", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "near", F.col("b").alias("mark"))
    kind = "a binary, b binary"

    def compare(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        found = linked_pairs([np.frombuffer(s, "<u4") for s in held["seq"]], held["own"].to_numpy(), held["near"].to_numpy(), key[1] == key[2])
        marks = held["mark"].to_numpy()
        return pd.DataFrame([(marks[i], marks[j]) for i, j in found], columns=["a", "b"])

    return dealt.join(seqs, "mark").groupBy("star", "x", "y").applyInPandas(compare, kind)


def linked_pairs(seqs: list[np.ndarray], own: np.ndarray, near: np.ndarray, same_block: bool) -> list[tuple[int, int]]:
    """Places of linked texts: a spanning forest. Texts that are both near the star's centre are connected already."""
    n = len(seqs)
    sizes = np.array([len(s) for s in seqs])
    flat, owner = np.concatenate(seqs), np.repeat(np.arange(n), sizes)
    values, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.cumsum(counts > 1) - 1
    useful = counts[column] > 1
    column, owner = rank[column[useful]], owner[useful]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((n, n), np.float32)
    width = max(1, 8_000_000 // max(n, 1))
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        some = slice(*np.searchsorted(column, [start, start + width]))
        table = np.zeros((n, min(width, int(column[-1]) + 1 - start)), np.float32)
        table[owner[some], column[some] - start] = 1
        common += table @ table.T
    enough = common * 2 >= (sizes[:, None] + sizes[None, :]) * (2 * SIMILARITY / (1 + SIMILARITY)) - 1e-3
    enough &= ~(near[:, None] & near[None, :])
    if not same_block:
        enough &= own[:, None] != own[None, :]
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in zip(*np.nonzero(np.triu(enough, 1))):
        if find(i) != find(j):
            limit = band(sizes[i], sizes[j])
            if distance(seqs[i], seqs[j], limit) <= limit:
                root[find(i)] = find(j)
                out.append((int(i), int(j)))
    return out


def near_copies(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, class_id, class_size, kept`` for every row.

    Rows of one class are connected by links of similarity 0.8 or more. ``class_id`` is
    the least id of the class, whose row is kept (of rows that repeat it, one). Words are
    lower-cased runs without white space; texts with the same words are one text, and
    texts without words (null too) are alike. A text of up to five words is one shingle.
    A null id comes after all others.
    """
    rows = sketched(df, id_column, text_column)
    texts = rows.groupBy("mark").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    pairs = stars(texts)
    marks = pairs.select(F.col("a").alias("mark")).unionByName(pairs.select(F.col("b").alias("mark"))).distinct()
    seqs = sequences(df, rows, marks, id_column, text_column)
    compared = measured(pairs, seqs)
    share = band(1, 0)
    links = compared.where(F.col("d") <= share * (F.col("n_a") + F.col("n_b"))).select("a", "b")
    links = links.unionByName(stage(links_among(unsettled(compared), seqs)))
    roots = components(links)
    classed = rows.join(roots.select(F.col("node").alias("mark"), "root"), "mark", "left")
    classed = classed.select("doc_id", "row", F.coalesce("root", "mark").alias("root"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least")
    groups = classed.groupBy("root").agg(least, F.count("*").alias("class_size"))
    return classed.join(groups, "root").select(
        "doc_id", F.col("least.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("least.row")).alias("kept")
    )


def drop_near_copies(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df`` whose id is the least of its class, with all their columns.

    Rows that share an id go or stay together: they stay if one of them does.
    """
    found = near_copies(df, id_column, text_column)
    gone = found.groupBy("doc_id").agg(F.max("kept").alias("stays")).where("NOT stays").select("doc_id")
    return without_ids(df, id_column, gone)


def op1_order_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(documents(spark, sf_dir))
