"""Words of a batch are looked up at once, and worked out once while they are kept."""

import numpy as np
import pyarrow as pa
import pytest
from llm.cases import BYTES, ODD, WORDS
from tokenizers import Tokenizer

from tallyloom.llm import mixing, tokens
from tallyloom.llm.toxicity import term_buckets

STEMS = ["word", "Word", "WORD", "été", "ÉTÉ", "straße", "ÿ", "a1b", "K", "İstanbul", "don't", "x_y", "½", "", "ΟΔΟΣ", "e" * 23, "e" * 24, "e" * 25, "é" * 12, "é" * 13, "E" * 300]
TEXTS = [*ODD, *[s + m for s in STEMS for m in ("", ".", ",", "!?", "...", "'")], " ".join(STEMS), "a\tb a\x0bc\u2003d a", "x\0y z", "<|STARTOFTEXT|> x", "Same same, same. SAME!"]


@pytest.mark.parametrize("slots", [16, 512, 1 << 15])
@pytest.mark.parametrize("path", [WORDS, BYTES, None])
def test_tokens_and_words_of_texts(monkeypatch, path, slots):
    monkeypatch.setattr(mixing, "SLOTS", slots)
    reader, library = mixing.Reader(path), path and Tokenizer.from_file(path)
    model = mixing.Classifier(np.unique([b for w in ("word", "été", "a", "same", "e" * 24, "οδος") for b in term_buckets(w)]), np.zeros((9, 2)))
    place = {int(b): i for i, b in enumerate(model.buckets)}
    plain = [t for t in TEXTS if "\0" not in t and len(t.split()) == len(t.replace("\n", " ").split(" "))]
    whole = pa.array(["left out", *TEXTS, "left out"])
    for texts in (whole.slice(1, len(TEXTS)), pa.array(plain), pa.array(plain).cast(pa.large_string()), *[pa.array([t]) for t in TEXTS], pa.array([], pa.string())):
        counts, words = reader.read(texts)
        flat, owner, measured = model.describe(words)
        assert len(counts) == len(measured) == len(texts)
        for i, text in enumerate(texts.to_pylist()):
            assert counts[i] == (len(library.encode(text, add_special_tokens=False).ids) if library else 0)
            assert flat[owner == i].tolist() == sorted({place[b] for w in text.split() for b in term_buckets(w) if b in place})
            assert words.totals[i] == len(text.split()) and words.different()[i] == len(set(text.split()))


def test_words_that_are_kept_are_not_worked_out_again():
    texts = pa.array([" ".join(f"Word{chr(97 + i % 26)}{chr(97 + i // 26)}, word{chr(97 + i % 26)}" for i in range(500)), "some more."])
    reader, asked = mixing.Reader(WORDS), []
    work = reader.table.work
    reader.table.work = lambda stem: asked.append(stem) or work(stem)
    first, words = reader.read(texts)
    assert len(asked) == len(set(asked)) and all(s.isalpha() and s.islower() for s in asked) and not words.words
    # A slot may have been taken by another of the words meanwhile, so a few are asked for again.
    before = len(asked)
    assert reader.read(texts)[0].tolist() == first.tolist() and len(asked) < before + 20


def test_a_table_stays_as_large_as_it_is():
    table = tokens.WordTable(lambda stem: (len(stem), 7), 16)
    for start in range(0, 3000, 500):
        words = [f"w{i}" for i in range(start, start + 500)]
        numbers, marks = table.look_up(pa.array(words))
        assert numbers.tolist() == [[len(w), 7] for w in words] and not marks.any()
        assert table.slots.shape == (16, tokens.EIGHTS + 1)
