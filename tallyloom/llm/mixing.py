"""Mixing to target weights by soft membership (operator 9)."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import KEY, documents, forget_memos, mixed, process_memo, slices, text_or_empty
from tallyloom.llm.tokens import ENDINGS, LETTERS_ONLY, SLOTS, Chunks, TextEncoder, WordTable, coded_chunks, strings
from tallyloom.llm.toxicity import BUCKETS, likelihood_ratio, term_buckets
from tallyloom.session import stage

#: Labelled documents that are used for fitting, at most: those with the smallest hashes of their ids.
MOST_LABELLED = 20_000
FEATURES, LEAST_DOCUMENTS = 2048, 5
#: Marks that end a word, and the place of terms that are no feature.
MARKS, NO_TERM = ".,;:!?", -1
#: Bytes of text that a task describes at a time.
SLICE = 2_000_000
#: What ``str.split`` splits at; chunks are cut at blanks and line ends already.
BLANK = re.compile(r"\s").search
EPOCHS, BATCH, RATE, DECAY = 30, 256, 0.2, 1e-4
#: Tokens are the ids of a text in this tokenizer, which packing uses as well.
TOKENIZER = "word_bpe_49k.json"
#: Domains are the labelled classes; their shares of all tokens after mixing.
DOMAINS = ("good", "plain", "toxic")
TARGETS = {"good": 0.85, "plain": 0.14, "toxic": 0.01}
#: Steps end when every domain is within this share of its target; the pull to 1 keeps them about as far from it.
PULL, MOST_STEPS, TOLERANCE = 1e-4, 60, 5e-4


@dataclass
class Classifier:
    """Softmax regression over terms that occur, the number of words and the share of different ones."""

    buckets: np.ndarray
    weights: np.ndarray  # a row for each term, then for the two measures, then the bias

    def describe(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The places of the terms of all texts, the text of each, and the measures of each text."""
        place = np.full(BUCKETS + 1, NO_TERM, np.int32)
        place[self.buckets] = np.arange(len(self.buckets))
        hashes = words.hashes
        if hashes is None:
            # Most words are a run of letters, and at most a mark: one term.
            bare = [w.lower().rstrip(MARKS) for w in words.words]
            hashes = np.fromiter((zlib.crc32(w.encode()) % BUCKETS if w.isalpha() else BUCKETS for w in bare), np.int64, len(bare))
        codes = place[hashes]
        found = codes[words.places]
        at = np.flatnonzero(found >= 0)
        found = found[at].astype(np.int64)
        odd = np.flatnonzero(hashes == BUCKETS)
        if len(odd):
            held: list = [()] * len(codes)
            for i in odd.tolist():
                held[i] = tuple({place[b] for b in term_buckets(words.words[i])} - {NO_TERM})
            more, source = spread(held, words.places)
            found, at = np.append(found, more), np.append(at, source)
        # A text has a term once, whichever of its words hold it.
        width = max(len(self.buckets), 1)
        owner, found = once(words.owner[at], found, width)
        return found, owner, measures(np.stack([words.totals, words.different()], 1).astype(float))

    def posteriors(self, flat: np.ndarray, owner: np.ndarray, measured: np.ndarray) -> np.ndarray:
        n, classes = len(self.buckets), self.weights.shape[1]
        margin = np.stack([np.bincount(owner, self.weights[flat, k], len(measured)) for k in range(classes)], 1)
        margin = margin + measured @ self.weights[n : n + 2] + self.weights[n + 2]
        margin = np.exp(margin - margin.max(axis=1, keepdims=True)) if len(margin) else margin
        return margin / margin.sum(axis=1, keepdims=True)


def spread(held: list, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What is held at each of the places, one after another, and which of the places each is from."""
    counts = np.fromiter(map(len, held), np.int64, len(held))
    flat = np.fromiter(chain.from_iterable(held), np.int64, int(counts.sum()))
    times = counts[places]
    at = np.repeat(np.arange(len(places)), times)
    inside = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
    return flat[np.repeat((np.cumsum(counts) - counts)[places], times) + inside], at


def once(owner: np.ndarray, places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs in order, given that places are below ``width``. Sorting takes a tenth of the time of hashing."""
    keys = np.sort(owner * width + places)
    keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
    first = keys // width
    return first, keys - first * width


@dataclass
class Words:
    """The different words (runs without white space) of each text of a batch.

    ``places`` are numbers of ``words``, once for each text (``owner``) that has the word;
    ``totals`` are the words of each text with repeats. ``hashes`` are the buckets of words
    that are one term, ``BUCKETS`` for others; only these need be among ``words`` then.
    """

    words: list[str] | dict[int, str]
    owner: np.ndarray
    places: np.ndarray
    totals: np.ndarray
    hashes: np.ndarray | None = None

    def different(self) -> np.ndarray:
        return np.bincount(self.owner, minlength=len(self.totals))

    @classmethod
    def of(cls, cut: Chunks, alone: dict[int, str]) -> Words:
        """From the batch's distinct chunks (none of which cuts a word), and the texts whose chunks don't count."""
        distinct, at, starts = cut
        if not alone and not BLANK("".join(distinct)):
            # Each chunk is a word, or empty.
            owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            if "" in distinct:
                kept = at != distinct.index("")
                owner, at = owner[kept], at[kept]
            return cls.among(distinct, len(distinct), owner, at, len(starts) - 1)
        # Nearly every chunk is a word; those that hold blanks of other kinds are split.
        held: list = [(i,) if chunk else () for i, chunk in enumerate(distinct)]
        odd = [i for i, chunk in enumerate(distinct) if BLANK(chunk)]
        numbers = dict(zip(distinct, range(len(distinct)))) if odd or alone else {}
        words = list(distinct)

        def number(word: str) -> int:
            if word not in numbers:
                numbers[word] = len(words)
                words.append(word)
            return numbers[word]

        for i in odd:
            held[i] = tuple(map(number, distinct[i].split()))
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        if alone:
            kept = ~np.isin(owner, list(alone))
            owner, at = owner[kept], at[kept]
        found, source = spread(held, at)
        owner = owner[source]
        for i, text in alone.items():
            own = np.array(list(map(number, text.split())), np.int64)
            owner, found = np.append(owner, np.full(len(own), i)), np.append(found, own)
        return cls.among(words, len(words), owner, found, len(starts) - 1)

    @classmethod
    def among(cls, words: list[str] | dict[int, str], n_words: int, owner: np.ndarray, places: np.ndarray, n_texts: int, hashes: np.ndarray | None = None) -> Words:
        """From the word at every place, with repeats."""
        return cls(words, *once(owner, places, max(n_words, 1)), np.bincount(owner, minlength=n_texts), hashes)


class Reader:
    """What a worker keeps of words: their ids in the tokenizer, if there is one, and their terms."""

    def __init__(self, tokenizer: str | None = None):
        self.coder = TextEncoder(tokenizer) if tokenizer else None
        # Terms alone take little work, so 4 MB of them do.
        self.table = WordTable(self._numbers, SLOTS if tokenizer else SLOTS // 8)
        self.marks = np.zeros(256, np.int64)
        if self.coder and self.coder.kind == "words":
            self.marks[[ord(m) for m in ENDINGS]] = [len(self.coder.known[m]) // 4 for m in ENDINGS]

    def _numbers(self, stem: str) -> tuple[int, int]:
        """The number of ids and the bucket of a run of letters; of anything else -1 and ``BUCKETS``."""
        if not (stem.isalpha() if stem.isascii() else LETTERS_ONLY(stem)):
            return -1, BUCKETS
        word = stem.lower()
        return self.coder.count_word(word) if self.coder else 0, zlib.crc32(word.encode()) % BUCKETS

    def read(self, texts: pa.Array) -> tuple[np.ndarray, Words]:
        """The number of ids (0 without a tokenizer) and the words of each text."""
        coder = self.coder
        if coder and coder.kind != "words":
            distinct, places, starts = coded_chunks(coder.kind, texts)
            cut = strings(distinct), places, starts
            tokens, alone = coder.count_chunks(texts, cut)
            return tokens, Words.of(cut, alone)
        alone = {i: t for i, t in enumerate(texts.to_pylist()) if (coder.stays_whole(t) if coder else "\0" in t)}
        # Each distinct chunk is looked up once, for its tokens and for its words.
        distinct, places, starts = coded_chunks("words", texts)
        numbers, marks = self.table.look_up(distinct)
        hashes, odd = numbers[:, 1], np.flatnonzero(numbers[:, 0] < 0)
        others = dict(zip(odd.tolist(), strings(distinct.take(pa.array(odd)))))
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        tokens = np.zeros(len(starts) - 1, np.int64)
        if coder:
            sizes = numbers[:, 0] + self.marks[marks]
            # Chunks of uncut texts are not needed.
            wanted = odd if not alone else np.intersect1d(odd, places[~np.isin(owner, list(alone))])
            sizes[wanted] = [len(coder.known[others[i]]) // 4 for i in wanted.tolist()]
            sums = np.concatenate([[0], np.cumsum(sizes[places])])
            tokens = sums[starts[1:]] - sums[starts[:-1]]
            for i, text in alone.items():
                tokens[i] = coder.count_whole(text)
        if alone or any(map(BLANK, others.values())):
            words = Words.of((strings(distinct), places, starts), alone)
            words.hashes = np.append(hashes, np.full(len(words.words) - len(hashes), BUCKETS))
            return tokens, words
        kept = ~np.isin(places, [i for i, word in others.items() if not word])
        return tokens, Words.among(others, len(distinct), owner[kept], places[kept], len(starts) - 1, hashes)


def reader(tokenizer: str | None = None) -> Reader:
    """The worker's reader for a tokenizer file, or for terms only."""
    return process_memo(f"words {tokenizer}", lambda: Reader(tokenizer))


def measures(sizes: np.ndarray) -> np.ndarray:
    words, different = sizes[:, 0], sizes[:, 1]
    return np.stack([np.log1p(words) / 5, different / np.maximum(words, 1)], 1)


def fit_classifier(rows: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray, classes: int) -> Classifier:
    """Fit on documents given as their distinct term buckets; the features are the terms with the largest likelihood ratio for a class."""
    n = len(labels)
    flat, owner = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64), np.repeat(np.arange(n), [len(r) for r in rows])
    seen = np.bincount(flat, minlength=BUCKETS)
    known = np.flatnonzero(seen >= LEAST_DOCUMENTS)
    ratio = np.zeros(len(known))
    shares = np.bincount(labels, minlength=classes)
    for k in range(classes):
        if 0 < shares[k] < n:
            both = np.bincount(flat, weights=(labels[owner] == k).astype(float), minlength=BUCKETS)
            ratio = np.maximum(ratio, likelihood_ratio(seen[known], both[known], n, int(shares[k])))
    buckets = np.sort(known[np.argsort(-ratio, kind="stable")[:FEATURES]])
    place = np.full(BUCKETS, -1)
    place[buckets] = np.arange(len(buckets))
    rows = [np.sort(place[r][place[r] >= 0]) for r in rows]
    model = Classifier(buckets, np.zeros((len(buckets) + 3, classes)))
    model.weights[-1] = np.log((shares + 1) / (n + classes))
    sums, measured, random = np.full(model.weights.shape, 1e-6), measures(sizes), np.random.default_rng(7)
    truth = np.eye(classes)[labels]
    for _ in range(EPOCHS if n else 0):
        order = random.permutation(n)
        for start in range(0, n, BATCH):
            some = order[start : start + BATCH]
            held = [rows[i] for i in some]
            flat, owner = np.concatenate(held), np.repeat(np.arange(len(some)), [len(r) for r in held])
            error = (model.posteriors(flat, owner, measured[some]) - truth[some]) / len(some)
            slope = DECAY * model.weights
            slope[-1] = error.sum(axis=0)
            slope[-3:-1] += measured[some].T @ error
            for k in range(classes):
                slope[: len(buckets), k] += np.bincount(flat, error[owner, k], len(buckets))
            sums += slope * slope
            model.weights -= RATE * slope / np.sqrt(sums)
    return model


def label_domains(labels: DataFrame) -> DataFrame:
    """``doc_id, domain``: toxic, else good or plain by the quality label. Rows without both labels or an id are left out; of several the first domain in order holds."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL AND quality IS NOT NULL")
    domain = F.when(F.col("toxic") == 1, F.lit(2)).when(F.col("quality") == 1, F.lit(0)).otherwise(F.lit(1))
    return known.groupBy("doc_id").agg(F.min(domain).alias("domain"))


def fit(df: DataFrame, domains: DataFrame, classes: int, id_column: str = "doc_id", text_column: str = "text") -> Classifier:
    """Fit on at most ``MOST_LABELLED`` documents of the labelled table (``doc_id, domain`` from 0). Without any the classes are equally likely."""
    chosen = domains.select(F.col("doc_id").alias(KEY), "domain").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELLED)
    rows = df.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    found = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col(KEY)).select("text", "domain")

    def features(batches):
        forget_memos()
        for batch in batches:
            words = [t.split() for t in batch.column("text").to_pylist()]
            different = [set(w) for w in words]
            terms = [np.unique(np.array(term_buckets(" ".join(d)), "<u4")) for d in different]
            yield pa.record_batch({
                "mark": pa.array([zlib.crc32(" ".join(w).encode("utf-8", "surrogatepass")) for w in words], pa.int64()),
                "words": pa.array([len(w) for w in words], pa.int64()), "different": pa.array([len(d) for d in different], pa.int64()),
                "terms": pa.array([t.tobytes() for t in terms], pa.binary()), "domain": batch.column("domain").cast(pa.int64()),
            })

    def learn(batches):
        found = list(batches)
        if not found:
            return
        table = pa.Table.from_batches(found).to_pandas().sort_values(["mark", "words", "different", "domain"])
        terms = [np.frombuffer(t, "<u4") for t in table["terms"]]
        model = fit_classifier(terms, table[["words", "different"]].to_numpy(float), table["domain"].to_numpy(), classes)
        yield pa.record_batch({"buckets": pa.array([model.buckets.astype("<i8").tobytes()]), "weights": pa.array([model.weights.tobytes()])})

    one = found.mapInArrow(features, "mark long, words long, different long, terms binary, domain long").repartition(1)
    row = one.mapInArrow(learn, "buckets binary, weights binary").first()
    if row is None:
        return Classifier(np.zeros(0, np.int64), np.zeros((3, classes)))
    return Classifier(np.frombuffer(row["buckets"], "<i8"), np.frombuffer(row["weights"]).reshape(-1, classes))


# --- rates ----------------------------------------------------------------------------------


@dataclass
class Rates:
    """A document's rate as a function of its posteriors: the steps of projected gradient descent with momentum, from 1.

    Scaled by its tokens, a document's slope depends on its posteriors and the domains'
    residuals only, so the steps' residuals are all that a task needs.
    """

    step: float
    momentum: float
    residuals: list[np.ndarray]

    def of(self, posteriors: np.ndarray) -> np.ndarray:
        rate = before = np.ones(len(posteriors))
        for residual in self.residuals:
            ahead = rate + self.momentum * (rate - before)
            before, rate = rate, np.maximum(0, ahead - self.step * (posteriors @ residual + PULL * (ahead - 1)))
        return rate

    def look_ahead(self, posteriors: np.ndarray) -> np.ndarray:
        """Where the next step's slope is taken."""
        if not self.residuals:
            return np.ones(len(posteriors))
        rate = self.of(posteriors)
        before = Rates(self.step, self.momentum, self.residuals[:-1]).of(posteriors)
        return rate + self.momentum * (rate - before)


def sums(described: DataFrame, weigh, width: int) -> np.ndarray:
    """Column sums over all documents of ``weigh(tokens, posteriors)``, summed in the tasks first."""

    def add(batches):
        total = np.zeros(width)
        for batch in batches:
            posteriors = np.stack([batch.column(i).to_numpy() for i in range(1, batch.num_columns)], 1)
            total += weigh(batch.column(0).to_numpy(), posteriors)
        yield pa.record_batch({f"c{i}": pa.array([total[i]]) for i in range(width)})

    columns = [f"c{i}" for i in range(width)]
    chances = [c for c in described.columns if c.startswith("p_")]
    partial = described.select(F.col("n_tokens").cast("double"), *chances).mapInArrow(add, ", ".join(f"{c} double" for c in columns))
    row = partial.agg(*[F.sum(c).alias(c) for c in columns]).first()
    return np.array([row[c] or 0.0 for c in columns])


def fit_rates(described: DataFrame, targets: np.ndarray) -> Rates:
    """Nonnegative rates whose expected domain totals come nearest to the targets.

    Least squares of the relative errors plus a weak pull of each rate to 1, by projected
    gradient descent with momentum; a step is one aggregation of as many sums as there
    are domains. ``targets`` are positive, in parts of all tokens.
    """
    k = len(targets)
    total = sums(described, lambda t, p: np.array([t.sum()]), 1)[0]
    if total <= 0:
        return Rates(1.0, 0.0, [])
    joint = sums(described, lambda t, p: ((p * t[:, None]).T @ p).ravel(), k * k).reshape(k, k) / total
    scale = 1 / np.sqrt(targets)
    # The least and the largest curvature give the step and the momentum.
    curves = np.linalg.eigvalsh(scale[:, None] * joint * scale) + PULL
    root = float(np.sqrt(max(curves[0], PULL) / curves[-1]))
    rates = Rates(1 / float(curves[-1]), (1 - root) / (1 + root), [])
    for _ in range(MOST_STEPS):
        here = Rates(rates.step, rates.momentum, list(rates.residuals))
        reached = sums(described, lambda t, p, here=here: (p * (t * here.look_ahead(p))[:, None]).sum(axis=0), k) / total
        rates.residuals.append((reached - targets) / targets)
        if np.abs(rates.residuals[-1]).max() < TOLERANCE:
            break
    return rates


def describe(
    df: DataFrame, model: Classifier, names: tuple[str, ...], tokenizer: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens`` (ids of the tokenizer) and the posterior ``p_<domain>`` of every row; a null text counts as empty."""
    rows = df.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def predict(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                tokens, words = reader(tokenizer).read(batch.column("text"))
                chances = model.posteriors(*model.describe(words))
                yield pa.record_batch(
                    {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(tokens, pa.int64())} | {f"p_{n}": pa.array(chances[:, i]) for i, n in enumerate(names)}
                )

    return rows.mapInArrow(predict, f"doc_id {kind}, n_tokens long, " + ", ".join(f"p_{n} double" for n in names))


def copies(rates: np.ndarray, ids: list) -> np.ndarray:
    """Whole copies: the rate rounded up or down by a hash of the id, so that the expected number is the rate."""
    marks = np.array([zlib.crc32(str(i).encode()) for i in ids], np.uint64)
    chance = (mixed(marks, 5) >> np.uint64(11)).astype(float) / (1 << 53)
    return (np.floor(rates) + (chance < rates - np.floor(rates))).astype(np.int64)


@dataclass
class Mixture:
    """What was fitted, and the staged rows of :func:`describe` it was fitted on."""

    model: Classifier
    rates: Rates
    described: DataFrame


def fit_mixture(
    df: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, names: tuple[str, ...] = DOMAINS, grow: bool = False,
    id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None,
) -> Mixture:
    """Fit the classifier on the labelled rows of the named domains, and the rates on all rows.

    The domains' tokens are to have the targets' shares of as many tokens as there are;
    with ``grow`` of as many more as let no domain shrink, so that rates stay near 1 or above.
    Tokens are those of the tokenizer file, ``TOKENIZER`` if none is given.
    """
    import public_tokenizers

    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    model = fit(df, label_domains(labels).where(F.col("domain") < len(names)), len(names), id_column, text_column)
    described = stage(describe(df, model, names, tokenizer, id_column, text_column))
    shares = np.array([targets[n] for n in names])
    shares = shares / shares.sum()
    if grow:
        now = sums(described, lambda t, p: (p * t[:, None]).sum(axis=0), len(names))
        shares = shares * max(1.0, float((now / max(now.sum(), 1e-300) / shares).max()))
    return Mixture(model, fit_rates(described, shares), described)


def mixture_table(mixture: Mixture) -> DataFrame:
    """``doc_id, n_tokens, p_<domain>, rate, copies`` of every row that the mixture was fitted on; an empty table gives no rows."""
    described, rates = mixture.described, mixture.rates

    def rate(batches):
        for batch in batches:
            found = rates.of(np.stack([batch.column(i).to_numpy() for i in range(2, batch.num_columns)], 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found), pa.array(copies(found, batch.column(0).to_pylist()))], names=[*batch.schema.names, "rate", "copies"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in described.schema)
    return described.mapInArrow(rate, f"{schema}, rate double, copies long")


def mix(df: DataFrame, mixture: Mixture, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each row as often as its whole copies, all columns as they are."""
    id_at, text_at = df.columns.index(id_column), df.columns.index(text_column)
    model, rates = mixture.model, mixture.rates

    def repeat(batches):
        forget_memos()
        for batch in batches:
            for part in slices(batch, text_column, SLICE):
                texts = pc.fill_null(part.column(text_at).cast(pa.string()), "")
                described = model.describe(reader().read(texts)[1])
                times = copies(rates.of(model.posteriors(*described)), part.column(id_at).to_pylist())
                for start in range(0, len(times), 500):
                    yield part.take(pa.array(np.repeat(np.arange(start, min(start + 500, len(times))), times[start : start + 500])))

    return df.mapInArrow(repeat, df.schema)


def op9_soft_membership_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return mixture_table(fit_mixture(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
