"""Toxicity and mixing by held-out accuracy and exact totals, sketches, WARC, and the pipeline stage by stage."""

import hashlib
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from llm.cases import ODD, WORDS
from llm.test_copies import brute_classes, folded
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm import mixing, registry, scaled_sketch, toxicity, warc
from tallyloom.llm.common import documents, shared_folder

MIDDLE = "/root/testdata/sf0.01"
INSULTS, GROUPS, FILLER = ["vile", "foul"], ["north", "south"], [f"word{i}" for i in range(60)]


def held_out(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 4 == 2


def test_op4_on_all_documents(spark):
    rows = registry.QUERIES["op4_factorization_toxicity"](spark, MIDDLE).collect()
    assert len(rows) == documents(spark, MIDDLE).count()
    for r in rows:
        assert r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    mine = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    high, low = ([r["score"] for r in mine if truth[r["doc_id"]] == t] for t in (1, 0))
    assert np.mean([a > b for a in high for b in low]) > 0.6
    assert sum(r["predicted"] for r in mine if truth[r["doc_id"]] == 0) <= 0.05 * len(low)


def test_pairs_matter(spark, make_documents):
    """An insult with a group is toxic, two insults or two groups are not: no additive weights tell that."""
    random = np.random.default_rng(1)
    texts, labels = [], []
    for i in range(1200):
        words = list(random.choice(FILLER, 12))
        kind = i % 4
        words += {0: [], 1: INSULTS, 2: GROUPS, 3: [str(random.choice(INSULTS)), str(random.choice(GROUPS))]}[kind]
        texts.append(" ".join(random.permutation(words)) + f" only{i}")
        labels.append((i, int(kind == 3)))
    model = toxicity.fit(make_documents(texts), spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = model.score([f"{' '.join(FILLER[:6])} {extra}" for extra in ("vile south", "vile foul", "north south", "", "FOUL, north!")])
    assert scores[0] > 0.5 and scores[4] > 0.5 and max(scores[1:4]) < 0.3


def test_toxicity_of_odd_rows(spark, make_documents):
    rows = [*enumerate(ODD), (None, None), (3, "again"), (99, "idiot " * 60_000)]
    df = make_documents(rows).withColumn("score", F.lit(1)).withColumn("label", F.lit(2))
    for labels in ([], [(1, 1)], [(1, 1), (1, 0), (5, 0), (None, 1), (7, None)]):
        model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert toxicity.scores(df, model).count() == len(rows)
        left = toxicity.drop_toxic(df, model)
        assert left.columns == df.columns and left.count() in (0, len(rows))
    assert toxicity.scores(make_documents([]), model).count() == 0


def test_op9_totals(spark):
    docs = documents(spark, MIDDLE)
    rows = registry.QUERIES["op9_soft_membership_mixing"](spark, MIDDLE).collect()
    assert len(rows) == docs.count()
    library = Tokenizer.from_file(WORDS)
    tokens = {r["doc_id"]: len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()}
    total = sum(tokens.values())
    for name, share in mixing.TARGETS.items():
        assert sum(r["rate"] * r["n_tokens"] * r[f"p_{name}"] for r in rows) / total == pytest.approx(share, rel=0.03)
    for r in rows:
        assert r["n_tokens"] == tokens[r["doc_id"]] and r["rate"] >= 0 and r["copies"] in (int(r["rate"]), int(r["rate"]) + 1)
        assert r["p_good"] + r["p_plain"] + r["p_toxic"] == pytest.approx(1)


def test_mixing_of_odd_rows(spark, make_documents):
    rows = [*enumerate(ODD), (None, None), (3, "again"), (99, "word " * 60_000)]
    df = make_documents(rows).withColumn("rate", F.lit(1)).withColumn("n_tokens", F.lit(2))
    for labels in ([], [(1, 0, 0), (2, 1, 0), (3, 1, 1), (None, 1, 1), (5, None, 0)]):
        mixture = mixing.fit_mixture(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        table = mixing.mixture_table(mixture).collect()
        out = mixing.mix(df, mixture)
        assert len(table) == len(rows) and out.columns == df.columns and out.count() == sum(r["copies"] for r in table)
    assert mixing.mixture_table(mixing.fit_mixture(make_documents([]), spark.createDataFrame([], "doc_id long, quality int, toxic int"))).count() == 0


def test_op7_on_all_documents(spark, small):
    rows = documents(spark, small).orderBy("doc_id").collect()
    check_edits(registry.QUERIES["op7_scaled_sketch_fingerprints"](spark, small).collect(), [(r["doc_id"], r["text"]) for r in rows])


def check_edits(found, rows):
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expect = []
    for i, (key, text) in enumerate(rows):
        following, count = rows[(i + 1) % len(rows)][1], len(text) // 4
        edited = text[: len(text) - count] + following[:count]
        expect.append((repr(key), len(text), hashlib.sha256(edited.encode()).hexdigest(), scaled_sketch.as_text(scaled_sketch.sketch(text)), scaled_sketch.as_text(scaled_sketch.sketch(edited))))
    got = [(repr(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) for r in found]
    assert sorted(got) == sorted(expect)
    assert all(0 <= r[c] <= 1 for r in found for c in ("near_edited", "near_next"))
    long = [r for r in found if r["n_chars"] > 500]
    if long:
        assert np.mean([r["near_edited"] for r in long]) > 0.6 and np.median([r["near_next"] for r in long]) < 0.1


def test_edits_of_odd_rows(spark, make_documents):
    rows = [*enumerate(ODD), (60, None), (None, "no id"), (3, "id again"), (3, "id again"), (71, "long text " * 20_000)]
    check_edits(scaled_sketch.fingerprint_edits(make_documents(rows, 7).withColumn("_range", F.lit(1))).collect(), rows)
    check_edits(scaled_sketch.fingerprint_edits(make_documents([(5, "alone and followed by itself")])).collect(), [(5, "alone and followed by itself")])
    assert scaled_sketch.fingerprint_edits(make_documents([])).count() == 0


def test_sketches_merge_and_estimate():
    random = np.random.default_rng(4)
    one, two = ("".join(random.choice(list("abcdefgh "), n)) for n in (40_000, 3_000))
    whole = scaled_sketch.sketch(one + two)
    assert scaled_sketch.containment(scaled_sketch.sketch(two), whole) > 0.95
    assert scaled_sketch.containment(scaled_sketch.sketch(one), scaled_sketch.sketch(two)) < 0.05
    merged = scaled_sketch.merge(scaled_sketch.sketch(one), scaled_sketch.sketch(two))
    assert set(merged) <= set(whole) and scaled_sketch.from_text(scaled_sketch.as_text(merged)).tolist() == merged.tolist()


def check_captures(found, pages):
    payloads = [(p, (h or "").encode()) for p, _, h in pages]
    largest = defaultdict(list)
    for page, payload in payloads:
        if len(payload) >= 1000:
            largest[payload].append(page)
    expect = []
    for page, payload in payloads:
        first = max((p for p in largest.get(payload, []) if p is not None), default=page)
        same = first == page
        expect.append((repr(page), len(payload), hashlib.sha1(payload).hexdigest(), "response" if same else "revisit", repr(None if same else first)))
    got = [(repr(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], repr(r["refers_to"])) for r in found]
    assert sorted(got) == sorted(expect)


def test_op2_on_all_pages(spark, small):
    pages = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    check_captures(registry.QUERIES["op2_warc_capture_index"](spark, small).collect(), pages)


def test_archives_and_lookups(spark, monkeypatch):
    monkeypatch.setattr(warc, "LINES_PER_BLOCK", 4)
    long = "<p>ä</p>" * 300
    pages = [(i, f"http://User@WWW.Site{i % 3}.example.com:8{i % 2}/p/{i // 4}?q=a b&x={i}#frag", long if i % 5 == 0 else f"<html>{i}</html>" * (i * 3)) for i in range(40)]
    pages += [(40, None, None), (41, "", "WARC/1.1\r\n\r\n" + long), (42, "not a url\r\n", long), (None, "http://a.b/", long), (7, "http://again/", long), (43, "http://[bad", ""), (5, pages[5][1], pages[5][2])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).withColumn("digest", F.lit(1))
    archives = warc.write_archives(df, shared_folder(spark, "warc"))
    directory = warc.write_index(warc.read_archives(archives), shared_folder(spark, "index"))
    check_captures(warc.scan_index(directory).collect(), pages)
    keys = [r["first_key"] for r in directory.orderBy("first_key").collect()]
    assert len(keys) > 5 and keys == sorted(keys)
    for page, url, html in pages:
        held = [r for r in warc.lookup(directory, [url]) if r["page_id"] == page] if url else []
        assert not url or any((html or "").encode() == r["payload"] or (r["record_type"] == "revisit" and r["payload"] is None) for r in held)
    assert warc.lookup(directory, ["http://nowhere.example/"]) == []
    empty = warc.write_archives(df.limit(0), shared_folder(spark, "warc"))
    assert warc.scan_index(warc.write_index(warc.read_archives(empty), shared_folder(spark, "index"))).count() == 0


def test_url_keys():
    assert warc.url_key("HTTPS://www.Example.com:443/a?b#c") == "com,example,www)/a?b"
    assert warc.url_key("http://example.com") == "com,example)/" and warc.url_key(None) == ""


def test_pipeline_stage_by_stage(spark):
    docs = documents(spark, MIDDLE)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        folder = shared_folder(spark, f"test-{name}")
        stage(spark, docs, MIDDLE).write.parquet(folder)
        columns, docs = docs.columns, spark.read.parquet(folder)
        after = docs.collect()
        if name == "packing":
            times = Counter(k for k, _ in before)
            copies = [r for r in after if r["piece"] == 0]
            assert Counter(r["doc_id"] for r in copies) == times
            continue
        assert docs.columns == columns
        kept = [(r["doc_id"], r["text"]) for r in after]
        if name == "toxicity":
            model = toxicity.fit(documents(spark, MIDDLE), spark.read.parquet(f"{MIDDLE}/labels.parquet"))
            assert sorted(kept) == sorted(r for r in before if model.score([r[1]])[0] < 0.3) and len(kept) > 0.8 * len(before)
        if name == "exact_dedup":
            best = {}
            for key, text in before:
                best[folded(text)] = max(best.get(folded(text), -1), key)
            assert sorted(k for k, _ in kept) == sorted(best.values())
        if name == "near_dedup":
            roots = brute_classes(before)
            least = {}
            for i, (key, _) in enumerate(before):
                least[roots[i]] = min(least.get(roots[i], key), key)
            assert sorted(k for k, _ in kept) == sorted(least.values())
        if name == "mixing":
            assert {k for k, _ in kept} <= {k for k, _ in before} and len({k for k, _ in kept}) > 0.95 * len(before)


def test_pipeline_of_odd_rows(spark, make_documents):
    rows = [*enumerate(ODD), (None, None), (3, "again"), (3, "again"), (99, "word " * 30_000)]
    for given in (rows, []):
        docs = make_documents(given).withColumn("kept", F.lit(1))
        for name, stage in corpus_pipeline.STAGES:
            folder = shared_folder(spark, f"test-{name}")
            stage(spark, docs, "/root/testdata/sf0.001").write.parquet(folder)
            docs = spark.read.parquet(folder)
        assert (docs.count() > 0) == bool(given)


def test_run(spark, small):
    rows = corpus_pipeline.run(spark, small).collect()
    texts = {r["doc_id"]: r["text"] for r in documents(spark, small).collect()}
    packed = {r["doc_id"] for r in rows}
    assert packed <= set(texts) and len(packed) > 0.5 * len(texts)
    once = [k for k, n in Counter(r["doc_id"] for r in rows if r["piece"] == 0).items() if n == 1]
    assert once
