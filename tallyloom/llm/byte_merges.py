"""Byte-level BPE encoding and decoding (operator 13).

Text is cut into words by a pattern; a word's bytes are merged pair by pair, the pair of
least rank first and of equal ranks the leftmost, until no pair has a rank. A corpus
repeats its words: a worker keeps the ids of the words it has seen, and starts with those
of the frequent ones, which Spark has counted and encoded once. So no text is shuffled.
Decoding joins the tokens' pieces, which are a literal array.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import BoundedMemo, documents, process_memo, slices, small_batches, text_or_empty
from tallyloom.session import stage

#: Words whose ids every worker starts with, their longest length in characters, and the
#: rows (about) they are learned from. They decide what is looked up and what is merged,
#: never the ids.
MOST_WORDS = 80_000
LONGEST_WORD = 48
WORD_ROWS = 50_000
#: Other words whose ids a worker keeps, and bytes of text that a task encodes at a time.
MEMO_ENTRIES, SLICE = 600_000, 4_000_000
#: Bytes of a word from which pairs wait in a heap.
LONG = 100
BYTES = "ISO-8859-1"
#: The rank of a pair that is no token.
NONE = 1 << 40


# --- one word -------------------------------------------------------------------------------


class WordMerges:
    """Ids of words by the ranks of a file, as little-endian unsigned 32-bit integers; ``frequent`` ones are known."""

    def __init__(self, ranks: dict[str, int], pattern: str, frequent: dict[str, bytes]):
        self.ranks, self.split, self.frequent = ranks, regex.compile(pattern).findall, frequent
        self.known = BoundedMemo(self._word, MEMO_ENTRIES)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self.split(text)))

    def _word(self, word: str) -> bytes:
        found = self.frequent.get(word)
        if found is not None:
            return found
        shown = word.encode().decode(BYTES)
        # A word that is a token is that token, whatever the merges make of it.
        rank = self.ranks.get(shown)
        parts = [shown] if rank is not None else self.merged(shown) if len(shown) < LONG else self.merged_long(shown)
        return np.array([self.ranks[part] for part in parts], "<u4").tobytes()

    def merged(self, word: str) -> list[str]:
        """What the merges leave of a word."""
        rank = self.ranks.get
        parts = list(word)
        pairs = [rank(a + b, NONE) for a, b in zip(parts, parts[1:])]
        while pairs:
            least = min(pairs)
            if least == NONE:
                break
            at = pairs.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], NONE)
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], NONE)
        return parts

    def merged_long(self, word: str) -> list[str]:
        """As :meth:`merged`, in little more than linear time: pairs wait in a heap, by rank and then by place.

        A part is known by its start. Pairs whose parts were joined meanwhile are passed over.
        """
        n, rank = len(word), self.ranks.get
        #: Where the part that starts at a place ends, and where the part before it starts; an end of 0 is no part.
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(word[i : i + 2])) is not None]
        heapify(waiting)

        def wait(left: int, right: int) -> None:
            if 0 <= left and right < n and (r := rank(word[left : end[right]])) is not None:
                heappush(waiting, (r, left, right, end[right]))

        while waiting:
            _, left, right, stop = heappop(waiting)
            if end[left] != right or end[right] != stop:
                continue
            end[left], end[right] = stop, 0
            if stop < n:
                before[stop] = left
            wait(before[left], left)
            wait(left, stop)
        parts, at = [], 0
        while at < n:
            parts.append(word[at : end[at]])
            at = end[at]
        return parts


def read_ranks(path: str) -> dict[str, int]:
    """Byte string to rank (which is the id too) of a rank file: base64 and number on a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token).decode(BYTES): int(rank) for token, rank in map(bytes.split, lines)}


# --- texts ----------------------------------------------------------------------------------


def words_of(text: Column, pattern: str) -> Column:
    """All matches of the pattern, with white space as Unicode defines it."""
    return F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))


def frequent_words(texts: DataFrame, pattern: str, most: int = MOST_WORDS) -> DataFrame:
    """``word, n`` of the words that are frequent enough for at most ``most`` of them to be left.

    Texts with fewer distinct words keep them all.
    """
    words = texts.select(F.explode(words_of(F.col("text"), pattern)).alias("word")).where(F.length("word") <= LONGEST_WORD)
    counts = stage(words.groupBy("word").agg(F.count("*").alias("n")))
    # At most 1,000 rows: how many distinct words occur how often.
    often = counts.groupBy(F.least("n", F.lit(1000)).alias("n")).count().orderBy(F.desc("n")).collect()
    least, seen = None, 0
    for row in often:
        seen += row["count"]
        if seen > most:
            break
        least = row["n"]
    return counts.where(F.lit(False) if least is None else F.col("n") >= least)


class ByteMerges:
    """Encoder and decoder of a rank file.

    ``fit`` learns which words are frequent: that makes encoding faster and changes no id; an
    encoder that was not fitted merges every word when it first meets it.
    """

    def __init__(self, ranks_file: str, pattern: str):
        ranks = read_ranks(ranks_file)
        missing = [b for b in range(256) if chr(b) not in ranks]
        if missing:
            raise ValueError(f"{ranks_file}: no rank for the bytes {missing}")
        tokens = [""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.ranks_file, self.pattern = ranks_file, pattern
        self.tokens = F.from_json(F.lit(json.dumps(tokens)), "array<string>")
        packed = [i.to_bytes(4, "little").decode(BYTES) for i in range(len(tokens))]
        self.packed = F.from_json(F.lit(json.dumps(packed)), "array<string>")
        self.frequent: dict[str, bytes] = {}

    def worker(self) -> Callable[[], WordMerges]:
        """Gives a task its worker's :class:`WordMerges`."""
        path, pattern, frequent = self.ranks_file, self.pattern, self.frequent
        name = f"merges {path} {pattern} {zlib.crc32(chr(0).join(sorted(frequent)).encode())}"
        return lambda: process_memo(name, lambda: WordMerges(read_ranks(path), pattern, frequent))

    def fit(self, texts: DataFrame, most: int = MOST_WORDS, rows: int = WORD_ROWS) -> ByteMerges:
        """Take over the ids of the frequent words of about ``rows`` rows' ``text``; at most ``most`` words come to the driver."""
        some = texts.sample(min(1.0, rows / max(texts.count(), 1)), 13)
        counts = frequent_words(some, self.pattern, most).coalesce(16)
        merges = self.worker()

        def encode(batches):
            for batch in batches:
                words = batch.column("word")
                yield pa.record_batch({"word": words, "ids": pa.array(map(merges()._word, words.to_pylist()), pa.binary())})

        found = counts.select("word").mapInArrow(encode, "word string, ids binary").collect()
        self.frequent = {word: bytes(ids) for word, ids in found}
        return self

    def decoded(self, ids: Column) -> Column:
        """The bytes (binary) of an array of ids: its tokens' pieces one after another. An unknown id is an error."""
        piece = lambda i: F.coalesce(F.get(self.tokens, i), F.raise_error(F.concat(F.lit("no token "), i)))
        return F.encode(F.array_join(F.transform(ids, piece), ""), BYTES)

    def id_bytes(self, ids: Column) -> Column:
        """Ids as little-endian unsigned 32-bit integers, in one binary value."""
        return F.encode(F.array_join(F.transform(ids, lambda i: F.get(self.packed, i)), ""), BYTES)


def encode_documents(df: DataFrame, coder: ByteMerges, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row: an array of ids, empty for a null or empty text.

    Rows are independent of each other: ids may be null or repeated, and other columns of
    ``df`` don't matter. An empty table gives no row. Letters and numbers are those of the
    Unicode version that the pattern's library knows.
    """
    rows = df.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    kind, merges = rows.schema["doc_id"].dataType.simpleString(), coder.worker()

    def encode(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                found = list(map(merges().encode, batch.column("text").to_pylist()))
                starts = np.cumsum([0, *map(len, found)], dtype=np.int64) // 4
                ids = pa.array(np.frombuffer(b"".join(found), "<i4"))
                yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(starts, pa.int32()), ids)})

    return rows.mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def op13_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = documents(spark, sf_dir)
    coder = ByteMerges(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coder.fit(docs.select(text_or_empty("text").alias("text")))
    rows = encode_documents(docs, coder).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), coder.id_bytes(F.col("ids")).alias("packed"), coder.decoded(F.col("ids")).alias("bytes")
    )
    return rows.select("doc_id", "n_tokens", F.sha2("packed", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
