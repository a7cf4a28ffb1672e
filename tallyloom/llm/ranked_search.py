"""Ranked lexical search by a hybrid of term- and document-at-a-time evaluation (operator 11).

Documents are indexed in shards, where they are read: a shard holds the postings of the
items' terms over some thousand documents. Each shard answers every item: the short lists
are summed term by term into accumulators, which then count as one list with a bound, and
the document-at-a-time pass runs over it and the long lists, window by window, skipping
windows whose bounds cannot reach the k best scores so far. Only those go on.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import documents, slices, text_or_empty
from tallyloom.llm.exact_copies import folded
from tallyloom.session import stage

#: Runs of bytes that are no ASCII mark, blank or control, after lower-casing A-Z.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: A shard is closed at so many documents or term occurrences.
SHARD_DOCS, SHARD_TERMS = 16_384, 3_000_000
#: Documents in a window; lists of at most one posting for so many documents are short.
WINDOW, SHORT = 256, 64
#: Items of a block are searched in one pass, and their terms go to every task.
BLOCK_ITEMS, BLOCK_BYTES = 4_000, 8_000_000
#: Parameters of the score: thousandths per unit of weight, share of the length in percent.
UNIT, LENGTH_SHARE = 1_000_000_000, 90


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall(folded(text or ""))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# --- shards -----------------------------------------------------------------------------------

SHARD = "ids binary, known binary, lengths binary, terms binary, starts binary, places binary, counts binary, wide boolean, n_docs long, n_terms long"


class Numbers(dict):
    """Numbers of terms; -1 for all others."""

    def __missing__(self, term: bytes) -> int:
        return -1


def index_shards(docs: DataFrame, vocabulary: list[bytes], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per shard: ids and lengths of its documents, and for each term of the vocabulary its postings.

    ``places`` are 16-bit numbers of documents within the shard, ascending within a term;
    ``counts`` are the occurrences there, in one byte or (``wide``) four.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))

    def index(batches):
        numbers = Numbers({term: i for i, term in enumerate(vocabulary)})
        ids, lengths, found, held = [], [], [], 0
        for batch in batches:
            for part in slices(batch, "text", 4_000_000):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    terms = terms_of(text)
                    hits = np.fromiter(map(numbers.__getitem__, terms), np.int64, len(terms))
                    found.append((hits[hits >= 0] << 16) | len(ids))
                    ids.append(doc_id)
                    lengths.append(len(terms))
                    held += len(found[-1])
                    if len(ids) >= SHARD_DOCS or held >= SHARD_TERMS:
                        yield shard(ids, lengths, found)
                        ids, lengths, found, held = [], [], [], 0
        if ids:
            yield shard(ids, lengths, found)

    return rows.mapInArrow(index, SHARD)


def shard(ids: list, lengths: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
    keys, counts = np.unique(np.concatenate(found), return_counts=True)
    terms, starts = np.unique(keys >> 16, return_index=True)
    wide = bool(len(counts)) and int(counts.max()) > 255
    known = np.array([i is not None for i in ids])
    values = {
        "ids": np.array([i or 0 for i in ids], "<i8"), "known": np.packbits(known), "lengths": np.array(lengths, "<i8"),
        "terms": terms.astype("<i8"), "starts": np.append(starts, len(keys)).astype("<i8"),
        "places": (keys & 0xFFFF).astype("<u2"), "counts": counts.astype("<u4" if wide else "u1"),
    }
    row = {name: [value.tobytes()] for name, value in values.items()}
    total = np.array(lengths, np.int64)
    row |= {"wide": [wide], "n_docs": [int((total > 0).sum())], "n_terms": [int(total.sum())]}
    return pa.RecordBatch.from_pydict(row, pa.schema([(n, pa.binary()) for n in values] + [("wide", pa.bool_()), ("n_docs", pa.int64()), ("n_terms", pa.int64())]))


def document_counts(shards: DataFrame) -> DataFrame:
    """``term, df``: in how many documents each term of the vocabulary occurs."""

    def count(batches):
        for batch in batches:
            for terms, starts in zip(batch.column("terms").to_pylist(), batch.column("starts").to_pylist()):
                yield pa.record_batch({"term": pa.array(np.frombuffer(terms, "<i8")), "df": pa.array(np.diff(np.frombuffer(starts, "<i8")))})

    return shards.select("terms", "starts").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


# --- search in a shard --------------------------------------------------------------------------


class Best:
    """The k best documents of an item so far: higher scores first, then lesser ids, unknown ids last."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.unknown = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """The score that a document must reach."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        scores, ids, unknown = np.append(self.scores, scores), np.append(self.ids, ids), np.append(self.unknown, unknown)
        order = np.lexsort((ids, unknown, -scores))[: self.k]
        self.scores, self.ids, self.unknown = scores[order], ids[order], unknown[order]


class Postings:
    """One term's list in a shard: places, impacts, and both by windows."""

    def __init__(self, places: np.ndarray, impacts: np.ndarray, windows: int):
        self.places, self.impacts = places, impacts
        self.edges = np.searchsorted(places, np.arange(windows + 1) * WINDOW)
        self.tops = window_tops(places, impacts, windows)


def window_tops(places: np.ndarray, values: np.ndarray, windows: int) -> np.ndarray:
    """The largest value of each window, 0 where it has none."""
    tops = np.zeros(windows, np.int64)
    np.maximum.at(tops, places // WINDOW, values)
    return tops


class Shard:
    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids, self.lengths = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["lengths"], "<i8")
        self.unknown = ~np.unpackbits(np.frombuffer(row["known"], np.uint8), count=len(self.ids)).astype(bool)
        self.places = np.frombuffer(row["places"], "<u2").astype(np.int64)
        counts = np.frombuffer(row["counts"], "<u4" if row["wide"] else "u1").astype(np.int64)
        norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * self.lengths * n_docs) // max(n_terms, 1)
        self.impacts = (UNIT * counts) // (1000 * counts + 8 * norm[self.places])
        self.terms, self.starts = np.frombuffer(row["terms"], "<i8"), np.frombuffer(row["starts"], "<i8")
        self.windows, self.lists = -(-len(self.ids) // WINDOW), {}

    def postings(self, at: int) -> Postings:
        if at not in self.lists:
            part = slice(self.starts[at], self.starts[at + 1])
            self.lists[at] = Postings(self.places[part], self.impacts[part], self.windows)
        return self.lists[at]

    def accumulators(self, short: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Term at a time: the documents of the short lists, ascending, and their sums."""
        parts = [(w, slice(self.starts[at], self.starts[at + 1])) for at, w in short]
        places, inverse = np.unique(np.concatenate([self.places[p] for _, p in parts]), return_inverse=True)
        sums = np.zeros(len(places), np.int64)
        np.add.at(sums, inverse, np.concatenate([w * self.impacts[p] for w, p in parts]))
        return places, sums

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Offer every document that may be among the best of an item of these terms."""
        at = np.searchsorted(self.terms, terms)
        here = (at < len(self.terms)) & (weights > 0)
        here[here] = self.terms[at[here]] == terms[here]
        lists = list(zip(at[here].tolist(), weights[here].tolist()))
        size = {a: int(self.starts[a + 1] - self.starts[a]) for a, _ in lists}
        short = [(a, w) for a, w in lists if size[a] * SHORT <= len(self.ids) or size[a] < SHORT]
        long = [(self.postings(a), w) for a, w in lists if size[a] * SHORT > len(self.ids) and size[a] >= SHORT]
        if not lists:
            return
        bounds, merged = np.zeros(self.windows, np.int64), None
        if short:
            places, sums = self.accumulators(short)
            merged = Postings(places, sums, self.windows)
            bounds += merged.tops
        # The lists that can add most come first, so that a window is given up early.
        long.sort(key=lambda one: -one[1] * int(one[0].tops.max()))
        for postings, w in long:
            bounds += w * postings.tops
        for window in np.flatnonzero(bounds >= best.least).tolist():
            if bounds[window] >= best.least:
                self.scan(window, int(bounds[window]), merged, long, best)

    def scan(self, window: int, rest: int, merged: Postings | None, long: list[tuple[Postings, int]], best: Best) -> None:
        """Document at a time: the sums of a window, given up once no document can get in."""
        first, least = window * WINDOW, best.least
        scores, top = np.zeros(WINDOW, np.int64), 0
        if merged is not None:
            part = slice(merged.edges[window], merged.edges[window + 1])
            scores[merged.places[part] - first] = merged.impacts[part]
            top, rest = int(merged.tops[window]), rest - int(merged.tops[window])
        for postings, w in long:
            if top + rest < least:
                return
            most = w * int(postings.tops[window])
            if most:
                part = slice(postings.edges[window], postings.edges[window + 1])
                scores[postings.places[part] - first] += w * postings.impacts[part]
                top, rest = int(scores.max()), rest - most
        found = np.flatnonzero(scores >= least)
        if len(found):
            best.offer(scores[found], self.ids[first + found], self.unknown[first + found])


# --- items ----------------------------------------------------------------------------------------


def search_block(docs: DataFrame, items: list, k: int, id_column: str, text_column: str) -> DataFrame:
    """``item, doc_id, score``: the k best documents of each task for each item of a block."""
    wanted = [(row["_item"], sorted(set(terms_of(row["_text"])))) for row in items]
    vocabulary = sorted({term for _, terms in wanted for term in terms})
    number = {term: i for i, term in enumerate(vocabulary)}
    shards = stage(index_shards(docs, vocabulary, id_column, text_column))
    total = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    n_docs, n_terms = int(total["n"]), int(total["l"])
    weights = np.zeros(len(vocabulary), np.int64)
    # One row a term of the block.
    for row in document_counts(shards).collect():
        weights[row["term"]] = weight(n_docs, row["df"])
    queries = [(item, np.array([number[t] for t in terms], np.int64)) for item, terms in wanted]

    def search(batches: Iterator[pa.RecordBatch]):
        best = {item: Best(k) for item, _ in queries}
        for batch in batches:
            for i in range(batch.num_rows):
                part = Shard(batch.slice(i, 1).to_pylist()[0], n_docs, n_terms)
                for item, terms in queries:
                    part.search(terms, weights[terms], best[item])
        for item, b in best.items():
            ids = pa.array(b.ids, pa.int64(), mask=b.unknown)
            yield pa.record_batch({"item": pa.array([item] * len(b.ids), pa.int64()), "doc_id": ids, "score": pa.array(b.scores)})

    return shards.mapInArrow(search, "item long, doc_id long, score long")


def best_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each item, those of score above 0.

    Every document is read whole and counts with all its terms. Equal scores go by
    ascending id, a null id last. A null text has no terms, an item without terms no rows; repeated
    items have their rows each, repeated documents count and are found each. Ids of documents
    are cast to long; other columns don't matter. An empty table gives no rows. Items are
    searched in blocks of a bounded size, one pass over the documents each.
    """
    asked = items.select(F.col(item_column).alias("item_id"), text_or_empty(item_text).alias("_text"))
    asked = stage(asked.withColumn("_item", F.monotonically_increasing_id()))
    size = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("b")).first()
    blocks = max(1, math.ceil(max(size["n"] / block_items, size["b"] / BLOCK_BYTES)))
    found = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == block).collect()
        part = search_block(docs, rows, k, id_column, text_column)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ids = asked.select(F.col("_item").alias("item"), "item_id")
    return top.join(ids, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op11_hybrid_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: The same sums over all pairs of a term and a document that holds it.
SQL = r"""
WITH terms AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents WHERE text IS NOT NULL
), lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
total AS (SELECT count(*) AS nd, sum(n) AS l FROM lengths),
postings AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM postings, total GROUP BY term, nd
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + CAST((90 * n * nd) // l AS BIGINT))))) AS BIGINT) AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), total
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
