"""Merges of single words, and what the encoder's plans no longer carry."""

import random

import public_tokenizers

from tallyloom.llm.byte_merges import ByteMerges, WordMerges, encode_documents, read_ranks

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_long_words_merge_as_short_ones():
    rnd, merges = random.Random(3), WordMerges(read_ranks(RANKS), public_tokenizers.PATTERN, {})
    for alphabet in ("a", "ab", "theinr", "=-", "".join(map(chr, range(256)))):
        for n in (1, 2, 3, 7, 40, 150):
            word = "".join(rnd.choices(alphabet, k=n))
            assert merges.merged_long(word) == merges.merged(word)


def test_plans_hold_no_words(spark, make_documents):
    docs = make_documents(["thndatin thndatin erde", None])
    coder = ByteMerges(RANKS, public_tokenizers.PATTERN).fit(docs.select("text").na.fill(""))
    plan = encode_documents(docs, coder)._jdf.queryExecution().analyzed().toString()
    assert "from_json" not in plan and "MapInArrow" in plan
    assert set(coder.frequent) == {"thndatin", " thndatin", " erde"}
    # What is frequent is looked up.
    assert WordMerges({}, public_tokenizers.PATTERN, coder.frequent).encode("thndatin erde") == coder.frequent["thndatin"] + coder.frequent[" erde"]
