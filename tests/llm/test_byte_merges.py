"""Byte-level BPE against the tiktoken library on the documents and on arbitrary strings."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm.cases import ODD
from pyspark.sql import functions as F

from tallyloom.llm.byte_merges import ByteMerges, encode_documents, op13_byte_level_bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder(spark):
    return ByteMerges(RANKS, public_tokenizers.PATTERN)


def test_op13_equals_the_library(spark, small, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op13_byte_level_bpe(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_arbitrary_strings(coder, library, make_documents):
    rnd = random.Random(1)
    runs = ["a" * 4000, "=" * 3000, "日本語テスト" * 100, "Â" * 600, " " * 700, "0" * 1000, "".join(rnd.choices("abcdefgh", k=3000))]
    mixed = ["".join(rnd.choices("aab =-\n ést'", k=200)) for _ in range(60)]
    wild = ["".join(chr(rnd.choice([rnd.randrange(1, 256), rnd.randrange(1, 0xD800)])) for _ in range(60)) for _ in range(60)]
    texts = [*ODD, *runs, *mixed, *wild]
    rows = encode_documents(make_documents(texts), coder).select("doc_id", "ids", coder.decoded(F.col("ids")).alias("bytes")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert list(r["ids"]) == library.encode_ordinary(texts[r["doc_id"]])
        assert bytes(r["bytes"]) == texts[r["doc_id"]].encode()


def test_frequent_words_change_nothing(spark, library, make_documents):
    texts = ["thndatin thndatin erde erde", "thndatin größe größe größe", None, ""]
    docs = make_documents([*enumerate(texts), (None, "erde größe"), (1, texts[1])])
    coder = ByteMerges(RANKS, public_tokenizers.PATTERN).fit(docs.select("text").na.fill(""), most=2)
    rows = encode_documents(docs, coder).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, list(r["ids"])) for r in rows) == sorted(
        (i is None, i or 0, library.encode_ordinary(t or "")) for i, t in [*enumerate(texts), (None, "erde größe"), (1, texts[1])]
    )


def test_empty_table_and_unknown_ids(spark, coder, make_documents):
    assert encode_documents(make_documents([(0, "x")]).where("false"), coder).count() == 0
    empty = ByteMerges(RANKS, public_tokenizers.PATTERN).fit(make_documents([(0, "x")]).where("false").select("text"))
    assert encode_documents(make_documents(["a thndatin"]), empty).first()["ids"] == encode_documents(make_documents(["a thndatin"]), coder).first()["ids"]
    with pytest.raises(Exception, match="no token"):
        spark.range(1).select(coder.decoded(F.array(F.lit(60000)))).collect()
