"""Exact and near copies against brute force over all pairs."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.cases import ODD
from pyspark.sql import functions as F

from tallyloom.llm import components, exact_copies, order_minhash, registry
from tallyloom.llm.common import documents


def folded(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
@settings(max_examples=150, deadline=None)
def test_golomb_round_trip(hashes):
    ordered = np.array(sorted(hashes), np.uint64)
    assert exact_copies.from_golomb(len(ordered), *exact_copies.golomb(ordered)).tolist() == sorted(hashes)


def check_copies(found, rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[hashlib.sha256(folded(text).encode("utf-8", "surrogatepass")).hexdigest()].append(key)
    expect = sorted(
        (repr(key), repr(max((k for k in held if k is not None), default=None)), len(held), digest) for digest, held in groups.items() for key in held
    )
    assert sorted((repr(r["doc_id"]), repr(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in found) == expect
    for digest, held in groups.items():
        kept = [r for r in found if r["text_sha256"] == digest and r["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == kept[0]["keep_id"]


ROWS = [
    *enumerate(ODD), (50, "Same TEXT é"), (51, "same text é"), (52, "same text É"), (53, None), (54, ""), (54, ""), (55, "x" * 200_000),
    (None, "SAME text é"), (None, "null ids"), (None, "NULL ids"), (3, "a  b"), (3, "A  B"),
]


def test_exact_copies_of_odd_rows(spark, make_documents):
    df = make_documents(ROWS, 5).withColumn("digest", F.lit(1)).withColumn("row", F.lit(2)).withColumn("kept", F.lit(3))
    check_copies(exact_copies.find_copies(df).collect(), ROWS)
    left = exact_copies.drop_copies(df)
    assert left.columns == df.columns
    texts = [folded(r["text"]) for r in left.collect()]
    assert sorted(texts) == sorted({folded(t) for _, t in ROWS})
    assert exact_copies.find_copies(make_documents([])).count() == 0 and exact_copies.drop_copies(make_documents([])).count() == 0


def test_op5_on_all_documents(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, small).collect()]
    check_copies(registry.QUERIES["op5_golomb_exact_dedup"](spark, small).collect(), rows)


def roots_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [(50, i) for i in range(50)], [(1, 2), (4, 3), (2, 9), (3, 9), (7, 8)], [],
])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    nodes = {n for link in links for n in link}
    assert {r["node"]: r["root"] for r in components.components(df).collect()} == roots_of(nodes, links)


def shingles(text):
    words = (text or "").lower().split()
    seen, out = defaultdict(int), []
    for i in range(max(1, len(words) - 4) if words else 0):
        shingle = tuple(words[i : i + 5])
        out.append((shingle, seen[shingle]))
        seen[shingle] += 1
    return out


def similarity(one, two):
    places = {s: i for i, s in enumerate(two)}
    ends = []
    for place in (places[s] for s in one if s in places):
        at = int(np.searchsorted(ends, place))
        ends[at : at + 1] = [place]
    return len(ends) / (len(one) + len(two) - len(ends)) if one or two else 1.0


def brute_classes(rows):
    seqs = [shingles(t) for _, t in rows]
    held = defaultdict(set)
    for i, seq in enumerate(seqs):
        for s in seq or ["empty"]:
            held[s].add(i)
    pairs = {(i, j) for group in held.values() for i in group for j in group if i < j}
    return roots_of(range(len(rows)), [p for p in pairs if similarity(seqs[p[0]], seqs[p[1]]) >= 0.8])


def check_classes(found, rows):
    roots = brute_classes(rows)
    members = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        members[roots[i]].append(key)
    expect = sorted((repr(key), repr(min((k for k in members[roots[i]] if k is not None), default=None)), len(members[roots[i]])) for i, (key, _) in enumerate(rows))
    assert sorted((repr(r["doc_id"]), repr(r["class_id"]), r["class_size"]) for r in found) == expect
    assert sum(r["kept"] for r in found) == len(members)


def test_op1_on_all_documents(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, small).collect()]
    check_classes(registry.QUERIES["op1_order_minhash_near_dedup"](spark, small).collect(), rows)


def test_near_copies_of_edited_texts(spark, make_documents, monkeypatch):
    monkeypatch.setattr(order_minhash, "BLOCK_TEXTS", 40)  # so that stars fall into several blocks
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for base in range(4):
        source = list(random.choice(words, 150))
        for _ in range(60):
            copy = list(source)
            for place in random.choice(150, random.integers(0, 9), replace=False):
                copy[place] = f"new{random.integers(0, 10**6)}"
            if random.random() < 0.3:
                del copy[int(random.integers(0, 150))]
            rows.append(" ".join(copy))
    rows += [*ODD, None, "one two", "One TWO", "one two three four five six", "rep " * 300, "rep " * 301, "rep " * 400, "word " * 50_000]
    rows = list(enumerate(rows)) + [(None, rows[0]), (7, rows[7]), (7, "another text with the same id, quite different from the first")]
    df = make_documents(rows, 5).withColumn("mark", F.lit(1)).withColumn("keys", F.lit(2))
    check_classes(order_minhash.near_copies(df).collect(), rows)
    left = order_minhash.drop_near_copies(df)
    assert left.columns == df.columns
    assert order_minhash.near_copies(make_documents([])).count() == 0
