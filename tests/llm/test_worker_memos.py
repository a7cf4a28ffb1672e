"""What workers keep from slice to slice."""

import pyarrow as pa
from llm.cases import WORDS

from tallyloom.llm import tokens
from tallyloom.llm.common import BoundedMemo, slices


def test_frequent_entries_stay_and_the_number_is_bounded():
    asked = []
    memo = BoundedMemo(lambda k: asked.append(k) or k, 100)
    for i in range(1000):
        assert memo["often"] == "often" and memo[i] == i
        assert len(memo) + len(memo.older) <= 100
    assert asked.count("often") == 1 and len(asked) == 1001
    memo.clear()
    assert not memo and memo["often"] == "often" and asked.count("often") == 2


def test_tokenizers_by_words_keep_fewer_words(monkeypatch):
    monkeypatch.setattr(tokens, "WORD_ENTRIES", 40)
    coder, texts = tokens.TextEncoder(WORDS), pa.array([f"some a{chr(97 + i % 26)}{chr(97 + i // 26)} 1{i}" for i in range(600)])
    expect = [len(coder.library.encode(t, add_special_tokens=False).ids) for t in texts.to_pylist()]
    assert coder.count_all(texts).tolist() == expect
    assert [len(i) // 4 for i in coder.encode_all(texts)] == expect
    for memo in (coder.known, coder.counted):
        assert len(memo) + len(memo.older) <= 40


def test_arrow_memory_goes_back_between_slices(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(1)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    assert len(list(slices(pa.record_batch({"text": pa.array(["abcd"] * 5)}), "text", 8))) == 3 == len(released)
