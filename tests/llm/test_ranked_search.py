"""The hybrid search against a plain double loop, on ties, repeated rows, nulls and small shards."""

import math
import random
import re
from collections import Counter

import pytest

from tallyloom.llm import ranked_search
from tallyloom.llm.ranked_search import best_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL_LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(SMALL_LETTERS))


def plain(docs, items, k=10):
    found = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(1 for _, c in found if c), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    rows = []
    for item, text in items:
        scores = []
        for doc, counts in found:
            m = 10 + (90 * sum(counts.values()) * n_docs) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t in set(terms(text)) if counts[t]
            )
            scores += [(-score, doc is None, doc or 0)] if score > 0 else []
        rows += [(item, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows, key=str)


def rows_of(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string, doc_id string, score long")


def test_small_shards_and_blocks(spark, make_documents, items, monkeypatch):
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(60)] + ["Été", "日本", "straße", "ÉTÉ"]
    spread = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rnd.choices(words, spread, k=rnd.randrange(0, 40)))) for i in range(1500)]
    docs += [(2000, None), (2001, ""), (2002, " ... "), (None, "w1 w50 w51"), (3, docs[3][1]), (5000, "w2 " * 3000 + "w59")] + [(9000 + i, docs[7][1]) for i in range(30)]
    asked = [(i, " ".join(rnd.choices(words, k=rnd.randrange(1, 12)))) for i in range(25)] + [(90, None), (91, ""), (92, "nowhere"), (93, "W1, w1; w50!"), (None, "w3")]
    monkeypatch.setattr(ranked_search, "SHARD_TERMS", 2500)
    got = best_documents(make_documents(docs), items([(i, t, "x", 1) for i, t in asked]), block_items=12)
    assert rows_of(got) == plain(docs, asked)


def test_large_shard_skips_without_loss(spark, make_documents, items):
    rnd = random.Random(8)
    docs = [(i, " ".join(rnd.choices("abcdefgh", k=6)) + (" rare" if i % 701 == 5 else "")) for i in range(6000)]
    asked = [(1, "a rare"), (2, "a b c d e f g h"), (3, "h")]
    assert rows_of(best_documents(make_documents(docs, 2), items([(i, t, None, 0) for i, t in asked]), k=5)) == plain(docs, asked, 5)


def test_empty_tables(make_documents, items):
    none = make_documents([(0, "a")]).where("false")
    assert best_documents(none, items([(1, "a", None, 0)])).count() == 0
    assert best_documents(make_documents(["a"]), items([(1, "a", None, 0)]).where("false")).count() == 0
