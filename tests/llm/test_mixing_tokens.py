"""Mixing meets its targets in the tokens that packing packs."""

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from llm.cases import BYTES, ODD, WORDS
from tokenizers import Tokenizer

from tallyloom.llm import mixing, registry, tokens
from tallyloom.llm.common import documents
from tallyloom.llm.toxicity import term_buckets

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def counts(spark):
    library = Tokenizer.from_file(WORDS)
    return {r["doc_id"]: len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in documents(spark, MIDDLE).collect()}


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_counts_equal_the_library(path):
    library, texts = Tokenizer.from_file(path), [*ODD, "a plain text\nof lines.", "x" * 5000]
    expect = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert tokens.encoder(path).count_all(pa.array(texts)).tolist() == expect
    assert tokens.encoder(path).count_all(pa.array(texts).slice(3, 9)).tolist() == expect[3:12]
    assert tokens.encoder(path).count_all(pa.array([], pa.string())).tolist() == []


def test_op9_totals_in_tokens(spark, counts):
    rows = registry.QUERIES["op9_soft_membership_mixing"](spark, MIDDLE).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == counts and len(rows) == len(counts)
    for name, share in mixing.TARGETS.items():
        assert sum(r["rate"] * counts[r["doc_id"]] * r[f"p_{name}"] for r in rows) / sum(counts.values()) == pytest.approx(share, rel=0.03)


def test_pipeline_shares_in_tokens(spark, counts):
    docs, labels = documents(spark, MIDDLE), spark.read.parquet(f"{MIDDLE}/labels.parquet")
    mixture = mixing.fit_mixture(docs, labels, corpus_pipeline.TARGETS, ("good", "plain"), grow=True)
    rows = mixing.mixture_table(mixture).collect()
    total = {n: sum(r["rate"] * counts[r["doc_id"]] * r[f"p_{n}"] for r in rows) for n in ("good", "plain")}
    assert total["good"] / sum(total.values()) == pytest.approx(0.8, rel=0.005)


def test_a_long_text_without_spaces_weighs_by_its_tokens(spark, make_documents):
    df = make_documents(["ab" * 5000, "one two three"])
    mixture = mixing.fit_mixture(df, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r["n_tokens"] for r in mixing.mixture_table(mixture).collect()}
    assert got[0] > 1000 and got[1] < 10


def test_words_and_terms_equal_a_plain_loop():
    texts = [*ODD, "a\tb a\x0bc\u2003d a", "one two\ttwo\nthree", "x\0y z", "", "Same same"]
    model = mixing.Classifier(np.unique([b for w in ("a", "two", "one", "same", "été", "end") for b in term_buckets(w)]), np.zeros((9, 2)))
    place = {int(b): i for i, b in enumerate(model.buckets)}
    for kind in ("words", "bytes"):
        alone = {i: t for i, t in enumerate(texts) if "\0" in t or i == 4}
        words = mixing.Words.of(tokens.chunks(kind, pa.array(texts)), alone)
        flat, owner, measured = model.describe(words)
        for i, text in enumerate(texts):
            expect = sorted({place[b] for w in text.split() for b in term_buckets(w) if b in place})
            assert flat[owner == i].tolist() == expect
            assert words.totals[i] == len(text.split()) and words.different()[i] == len(set(text.split()))
        assert len(measured) == len(texts)


def test_words_are_counted_as_the_library_does():
    library, coder = Tokenizer.from_file(WORDS), tokens.TextEncoder(WORDS)
    stems = ["word", "Word", "WORD", "été", "ÉTÉ", "straße", "Übergröße", "ÿ", "a1b", "K", "Ångström", "İstanbul", "don't", "x_y", "½", "", "ΟΔΟΣ"]
    texts = [s + m for s in stems for m in ("", ".", ",", "!?", "...", "'")]
    texts += [" ".join(texts[i::7]) for i in range(7)] + ["\n".join(texts)]
    expect = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert coder.count_all(pa.array(texts)).tolist() == expect
    assert coder.count_all(pa.array(texts)).tolist() == expect
