"""Token counts of every prefix of every text (operator 6)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import documents, slices, text_or_empty
from tallyloom.llm.tokens import counter


def prefix_table(df: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, steps`` for each row.

    ``steps`` holds, for each code point of the text, by how much it changes the token
    count, as little-endian 16-bit integers; the running sum up to code point i is the
    exact number of tokens of the first i code points (see :func:`tokens_at` and
    :func:`longest_prefix`). One narrow pass, no shuffle. A null text counts as empty and
    has no steps; ids may be null or repeated, each row gives one row.
    """
    rows = df.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, steps binary, n_bytes long"

    def count(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                steps = list(counter(tokenizer).steps_all(batch.column("text")))
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id"),
                        "n_tokens": pa.array([int(np.frombuffer(s, "<i2").sum(dtype=np.int64)) for s in steps], pa.int64()),
                        "steps": pa.array(steps, pa.binary()),
                        "n_bytes": pa.array(pa.compute.binary_length(batch.column("text")).cast(pa.int64())),
                    }
                )

    return rows.mapInArrow(count, schema).select("doc_id", "n_bytes", "n_tokens", "steps")


def tokens_at(steps: bytes, length: int) -> int:
    """Tokens of the first ``length`` code points."""
    return int(np.frombuffer(steps, "<i2", count=length).sum(dtype=np.int64))


def longest_prefix(steps: bytes, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens; a longer prefix may have fewer tokens than a shorter one."""
    fits = np.flatnonzero(np.cumsum(np.frombuffer(steps, "<i2"), dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def truncated(table: DataFrame, budget: int) -> DataFrame:
    """The table with ``kept_chars``, the length of the longest prefix within a token budget."""

    @F.pandas_udf("long")
    def kept(steps):
        return steps.map(lambda s: longest_prefix(s, budget))

    return table.withColumn("kept_chars", kept("steps"))


def over(limit: int) -> Column:
    return (F.col("n_tokens") > limit).alias("over_limit")


def op6_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    table = prefix_table(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return table.select("doc_id", "n_bytes", "n_tokens", over(1024))
