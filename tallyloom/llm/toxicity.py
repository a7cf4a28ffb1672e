"""Toxicity by a factorization machine over hashed terms (operator 4)."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import KEY, BoundedMemo, documents, slices, text_or_empty, forget_memos

BUCKETS = 1 << 20
#: Labelled documents that are used for fitting, at most: those with the smallest hashes of their ids.
MOST_LABELLED = 20_000
FACTORS, LEAST_DOCUMENTS = 8, 5
EPOCHS, BATCH, RATE, DECAY = 40, 256, 0.3, 1e-5
#: Terms that are fitted before all are; the later steps start from this squared slope, so that texts of many terms don't overshoot.
FIRST, LATE_START, LATE_DECAY = 1024, 1e-1, 1e-4
THRESHOLD = 0.3
TERMS = re.compile(r"[^\W\d_]+")


def term_buckets(token: str) -> tuple[int, ...]:
    """The hash buckets of the letter runs of a token, lower-cased."""
    return tuple(zlib.crc32(t.encode("utf-8", "surrogatepass")) % BUCKETS for t in TERMS.findall(token.lower()))


@dataclass
class Machine:
    """score = 1 / (1 + exp(-(bias + sum w x + sum over pairs of <v_i, v_j> x_i x_j))), x being 1 for terms that occur."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    memo: BoundedMemo | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"bias": self.bias, "buckets": self.buckets, "weights": self.weights, "factors": self.factors, "memo": None}

    def terms(self, texts: list[str]) -> list[np.ndarray]:
        if self.memo is None:
            place = {int(b): i for i, b in enumerate(self.buckets)}
            self.memo = BoundedMemo(lambda token: [place[b] for b in term_buckets(token) if b in place], 400_000)
        look = self.memo.__getitem__
        return [np.array(sorted({i for found in map(look, text.split()) for i in found}), np.int64) for text in texts]

    def margin(self, rows: list[np.ndarray]) -> np.ndarray:
        flat, owner = np.concatenate([np.zeros(0, np.int64), *rows]), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        linear = np.bincount(owner, self.weights[flat], len(rows))
        pairs = np.zeros(len(rows))
        for f in range(self.factors.shape[1]):
            v = self.factors[flat, f]
            pairs += np.bincount(owner, v, len(rows)) ** 2 - np.bincount(owner, v * v, len(rows))
        return self.bias + linear + 0.5 * pairs

    def score(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.terms(texts)), -30, 30)))


def likelihood_ratio(with_term: np.ndarray, positive_with: np.ndarray, n: int, positive: int) -> np.ndarray:
    """The G statistic of each term's table of occurrence against label."""
    total = np.zeros(len(with_term))
    for seen, both in ((with_term, positive_with), (n - with_term, positive - positive_with)):
        for count, share in ((both, positive / n), (seen - both, 1 - positive / n)):
            expected = seen * share
            total += np.where(count > 0, 2 * count * np.log(np.maximum(count, 1e-9) / np.maximum(expected, 1e-9)), 0)
    return total


def fit_machine(rows: list[np.ndarray], labels: np.ndarray) -> Machine:
    """Fit on documents given as arrays of their distinct term buckets.

    All terms of at least ``LEAST_DOCUMENTS`` documents have factors, whatever they tell
    alone. Those that tell the classes apart best alone are fitted first; then all are, by
    small steps, and the others take up what is left, as a pair of which one side is as
    common in clean texts. Without both classes the machine knows their share only.
    """
    n, positive = len(labels), int(labels.sum())
    share = (positive + 1) / (n + 2)
    empty = Machine(float(np.log(share / (1 - share))), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    if positive in (0, n):
        return empty
    flat, owner = np.concatenate(rows).astype(np.int64), np.repeat(np.arange(n), [len(r) for r in rows])
    seen = np.bincount(flat, minlength=BUCKETS)
    both = np.bincount(flat, weights=labels[owner], minlength=BUCKETS)
    buckets = np.flatnonzero(seen >= LEAST_DOCUMENTS)
    # Words of one language only would count against toxic texts in another, so terms of clean texts have no weight of their own.
    weighed = (both * n > seen * positive)[buckets]
    ratio = np.where(weighed, likelihood_ratio(seen[buckets], both[buckets], n, positive), -1)
    first = np.argsort(-ratio, kind="stable")[: min(FIRST, int(weighed.sum()))]
    place = np.full(BUCKETS, -1)
    place[buckets] = np.arange(len(buckets))
    rows = [np.sort(place[r][place[r] >= 0]) for r in rows]
    random = np.random.default_rng(11)
    model = Machine(empty.bias, buckets, np.zeros(len(buckets)), np.zeros((len(buckets), FACTORS)))
    model.factors[np.sort(first)] = random.normal(0, 0.01, (len(first), FACTORS))
    early = np.isin(np.arange(len(buckets)), first)
    train(model, [r[early[r]] for r in rows], labels, weighed, 1e-6, DECAY, random)
    train(model, rows, labels, weighed, LATE_START, LATE_DECAY, random)
    return model


def train(model: Machine, rows: list[np.ndarray], labels: np.ndarray, weighed: np.ndarray, start: float, decay: float, random: np.random.Generator) -> None:
    """Steps over all documents in batches, each scaled by the root of the squared slopes so far, which are ``start`` at first."""
    n = len(labels)
    sums = [np.full(1, start), np.full(len(weighed), start), np.full(model.factors.shape, start)]
    for _ in range(EPOCHS):
        order = random.permutation(n)
        for at in range(0, n, BATCH):
            some = order[at : at + BATCH]
            held = [rows[i] for i in some]
            # Only terms of the batch are updated. Documents without a feature tell only the bias.
            terms, flat = np.unique(np.concatenate(held), return_inverse=True)
            owner = np.repeat(np.arange(len(some)), [len(r) for r in held])
            factors = model.factors[terms]
            error = 1 / (1 + np.exp(-np.clip(model.margin(held), -30, 30))) - labels[some]
            per = error[owner]
            times = np.bincount(flat, per, len(terms)) / len(some)
            slope_w = (times + decay * model.weights[terms]) * weighed[terms]
            slope_v = (decay - times)[:, None] * factors
            for f in range(FACTORS):
                total = np.bincount(owner, factors[flat, f], len(some))
                slope_v[:, f] += np.bincount(flat, per * total[owner], len(terms)) / len(some)
            slope_b = np.array([error.mean()])
            sums[0] += slope_b * slope_b
            sums[1][terms] += slope_w * slope_w
            sums[2][terms] += slope_v * slope_v
            model.bias -= float(RATE * slope_b[0] / np.sqrt(sums[0][0]))
            model.weights[terms] -= RATE * slope_w / np.sqrt(sums[1][terms])
            model.factors[terms] -= RATE * slope_v / np.sqrt(sums[2][terms])


def in_fold(id_column: str = "doc_id"):
    """Whether a row is held out: crc32 of the id as text, modulo 4, is 2. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: str = "toxic") -> Machine:
    """Fit on at most ``MOST_LABELLED`` labelled documents outside the held-out fold.

    Each different text counts once, with the mean of its labels rounded up from one
    half, so groups of copies don't outweigh others. Rows without a label or without an
    id are not used; of several labels of an id the largest holds.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull() & ~in_fold(id_column))
    chosen = chosen.groupBy(F.col(id_column).alias(KEY)).agg(F.max(F.col(label).cast("double")).alias("label"))
    chosen = chosen.orderBy(F.xxhash64(KEY), KEY).limit(MOST_LABELLED)
    rows = df.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    found = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col(KEY)).select("text", "label")

    def features(batches):
        forget_memos()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            terms = [np.unique(np.array([b for token in text.split() for b in term_buckets(token)], "<u4")) for text in texts]
            yield pa.record_batch({
                "digest": pa.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) * (1 << 31) + len(t) % (1 << 31) for t in texts], pa.int64()),
                "terms": pa.array([t.tobytes() for t in terms], pa.binary()), "label": batch.column("label").cast(pa.float64()),
            })

    def learn(batches):
        found = list(batches)
        if not found:
            return
        table = pa.Table.from_batches(found).to_pandas().sort_values(["digest", "label"])
        table = table.groupby("digest", as_index=False).agg(terms=("terms", "first"), label=("label", "mean"))
        model = fit_machine([np.frombuffer(t, "<u4") for t in table["terms"]], (table["label"] >= 0.5).to_numpy(np.float64))
        yield pa.record_batch({
            "bias": pa.array([model.bias]), "buckets": pa.array([model.buckets.astype("<i8").tobytes()]),
            "weights": pa.array([model.weights.tobytes()]), "factors": pa.array([model.factors.tobytes()]),
        })

    one = found.mapInArrow(features, "digest long, terms binary, label double").repartition(1)
    row = one.mapInArrow(learn, "bias double, buckets binary, weights binary, factors binary").first()
    if row is None:
        return fit_machine([], np.zeros(0))
    return Machine(
        row["bias"], np.frombuffer(row["buckets"], "<i8"), np.frombuffer(row["weights"]), np.frombuffer(row["factors"]).reshape(-1, FACTORS)
    )


def scores(df: DataFrame, model: Machine, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row's whole text, in one narrow pass; a null text counts as empty."""
    rows = df.select(F.col(id_column).alias("doc_id"), in_fold(id_column).alias("held_out"), text_or_empty(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def score(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                found = model.score(batch.column("text").to_pylist())
                yield pa.record_batch({"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(found)})

    scored = rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(df: DataFrame, model: Machine, text_column: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, all columns as they are."""
    at = df.columns.index(text_column)

    def keep(batches):
        forget_memos()
        for whole in batches:
            for batch in slices(whole, text_column, 4_000_000):
                texts = [t or "" for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(model.score(texts) < THRESHOLD))

    return df.mapInArrow(keep, df.schema)


def op4_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scores(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
