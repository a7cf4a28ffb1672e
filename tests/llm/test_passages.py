"""Removed passages against a table of all 200-byte strings."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import registry, repeated_passages
from tallyloom.llm.common import documents

LENGTH = 200


def expected(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + LENGTH] for t in data for i in range(len(t) - LENGTH + 1))
    out = []
    for t in data:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def results(df):
    found = repeated_passages.repeated_passages(df).select("doc_id", "n_bytes", "spans", "kept").collect()
    return [(r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in found]


def made(seed):
    random = np.random.default_rng(seed)

    def text(n):
        return "".join(random.choice(list("abcdefgh é\0"), n))

    shared = [text(n) for n in (199, 200, 201, 260, 700, 1500)]
    rows = [text(400) for _ in range(5)]
    for passage in shared:
        for _ in range(int(random.integers(2, 6))):
            rows.append(text(int(random.integers(0, 300))) + passage + text(int(random.integers(0, 300))))
    long = shared[5]
    rows += [long[:900] + text(50), text(70) + long[500:], long[300:800] + long[250:760], text(150) + long[100:350] + text(90) + long[0:310]]
    rows += [shared[1], shared[0], "a" * 3000, "a" * 199, "a" * 250 + text(50), "ab" * 500, text(30) * 40, text(230) * 3, "", None]
    rows += [rows[3], rows[3], text(100_000) + shared[3], "é" * 400]
    return rows


@pytest.mark.parametrize("most, block", [(20_000, 8000), (20_000, 7), (3, 50)])
def test_against_all_strings(spark, make_documents, monkeypatch, most, block):
    monkeypatch.setattr(repeated_passages, "MOST_IN_BUCKET", most)
    monkeypatch.setattr(repeated_passages, "ROWS_PER_BLOCK", block)
    texts = made(most + block)
    rows = [*enumerate(texts)]
    df = make_documents(rows, 4).withColumn("mark", F.lit(1)).withColumn("places", F.lit(2)).withColumn("spans", F.lit(3))
    assert sorted(results(df)) == [(i, *e) for i, e in enumerate(expected(texts))]


@pytest.mark.parametrize("size", [1, 3_000, 1_000_000])
def test_counted_in_slices_of_any_size(spark, make_documents, monkeypatch, size):
    monkeypatch.setattr(repeated_passages, "MOST_IN_BUCKET", 1)
    monkeypatch.setattr(repeated_passages, "COUNTED_BYTES", size)
    texts = made(size)
    # A text of one passage has the passage's hash as its own.
    once = "".join(np.random.default_rng(8).choice(list("xyz"), LENGTH))
    texts += [once, "q" + texts[9][:260], *[texts[9]] * 9]
    assert sorted(results(make_documents([*enumerate(texts)], 4))) == [(i, *e) for i, e in enumerate(expected(texts))]


def test_a_common_passage_is_one_row_of_a_slice():
    common = b"%0200d" % 7
    texts = [(b"%016d" % i, b"%050d" % i + common, np.array([0, 50]), 1) for i in range(1000)]
    found = repeated_passages.told_by_slice([*texts, (b"%016d" % 1000, b"x" * 200, np.array([0]), 2)]).to_pylist()
    asked = [r for r in found if r["mark"] and r["stop"] is None]
    spans = [r for r in found if r["stop"] is not None]
    assert sorted(r["mark"] for r in asked) == [t[0] for t in texts] and {r["start"] for r in asked} == {0}
    assert sorted((r["mark"], r["start"], r["stop"]) for r in spans) == [*((t[0], 50, 250) for t in texts), (b"%016d" % 1000, 0, 200)]
    assert len(found) - len(asked) - len(spans) == 2


def test_joins_by_shuffle(spark, make_documents, monkeypatch):
    monkeypatch.setattr(repeated_passages, "MOST_BROADCAST_ROWS", 0)
    texts = made(1)
    rows = [*enumerate(texts[:-1]), (None, texts[-1]), (4, "id again " * 40), (4, "id again " * 40)]
    found = sorted((repr(r[0]), *r[1:]) for r in results(make_documents(rows)))
    assert found == sorted((repr(r[0]), *e) for r, e in zip(rows, expected([t for _, t in rows])))
    assert results(make_documents([])) == []


def test_op10_on_all_documents(spark, small):
    rows = documents(spark, small).orderBy("doc_id").collect()
    found = registry.QUERIES["op10_suffix_sorted_passages"](spark, small).collect()
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found)
    assert got == [(r["doc_id"], *e) for r, e in zip(rows, expected([r["text"] for r in rows]))]


def test_multikey_order():
    table = np.random.default_rng(2).integers(0, 2, (500, 200)).astype(np.uint8)
    table[::3, :120] = table[0, :120]
    ordered = table[repeated_passages.multikey_order(table)]
    assert [r.tobytes() for r in ordered] == sorted(r.tobytes() for r in table)
