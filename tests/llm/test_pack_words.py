"""New words of a text are encoded together, with the tokenizer's own ids for the whole text."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from foldwright.llm.pack import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " \t\n", "one", "Two WORDS, here... (and) don't we'll x1 3.14 a-b", "<|startoftext|> a <|ENDOFTEXT|>b <|endoftext|>", "</w> a</w> w>",
    "ÀÉ Übung ß ÿ µ ª º ×÷ Å é É", "ΣΑΣ Σ İstanbul ǅ ſ K", "日本語 テスト क्षि ไทย", "a\x1cb \x1dC\x1f d", "a b c\u0085d", "\x00 \x07a b\x0b c",
    "--- a!! !!a a!b! 'tis it's' \"q\"", "😀 a😀 b", "word " * 50 + "Word. WORD",
]


def test_ids_are_those_of_the_whole_text():
    tokenizer, encoder = Tokenizer.from_file(PATH), WordEncoder(PATH)
    for text in ODD * 2:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_new_words_are_encoded_together():
    encoder, calls = WordEncoder(PATH), []
    find = encoder.parts.find
    encoder.parts.find = lambda part: calls.append(part) or find(part)
    encoder.encode(" ".join(f"{a}{b}zq" for a in "abcdefghij" for b in "klmnopqrst"))
    assert not calls
