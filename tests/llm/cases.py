"""Tokenizers and texts that several tests use."""

import public_tokenizers

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
#: Texts that exercise the cuts: runs of white space, special strings, contractions, other scripts, controls.
ODD = [
    "", " ", "  ", "a  b", "a   b", "a \n b  ", "\n\n x\n", "don't we'll I'VE they're 're", "x <|endoftext|> y  <|endoftext|><|endo",
    "été Été ßÄ 'é", "日本語 テスト  ok", "a\x1cb \x1c c", "!\x1c! ?", "\xa0x\xa0 y", "1234 567a b12", "İstanbul ΑΣ Σ", "é ́x", "a\tb \t c",
    "aaaa" * 50, "x   ", "\r\n a\r\n", "🙂🙂 a🙂", "_a_b", "a'b 's ''s 'll", "a\0b \0 c", "The end.\nNext, (one) two-three; four: 5.",
]
