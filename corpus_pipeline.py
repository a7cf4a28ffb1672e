"""From raw documents to packed sequences: the corpus operators one after another.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet
to the shared folder and reads it again for the next one. All but the last return the
columns of the documents. The stages define nulls, empty and repeated rows as their
operators do; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import exact_copies, mixing, order_minhash, packing, toxicity
from tallyloom.llm.common import documents, shared_folder, small_batches

#: Shares of the tokens after mixing; toxic documents are gone by then.
TARGETS = {"good": 0.8, "plain": 0.2}


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores below the threshold."""
    small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    small_batches(spark)
    return exact_copies.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the row with the least id."""
    small_batches(spark)
    return order_minhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say; the total grows until no domain shrinks, so hardly any goes."""
    small_batches(spark)
    mixture = mixing.fit_mixture(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), TARGETS, ("good", "plain"), grow=True)
    return mixing.mix(docs, mixture)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents in sequences of at most 4096 tokens."""
    small_batches(spark)
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: The stages train models and compare sketches, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage works on all rows that the one before it kept."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        folder = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
