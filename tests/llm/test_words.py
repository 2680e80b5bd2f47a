from __future__ import annotations

import random
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from zoneflow.llm import words

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "a b  c\t d\x1ce <|endoftext|>x <|startoftext|> É́ Σας ΣΑΣ İstanbul don't I'LL 12a ̈b",
    "",
    " ",
    "  \n ",
    "a  <|endoftext|> b",
    " lead",
    "   lead  \n\n trail   ",
    "a   b\n c\n\n  d \ne 's 't  x 　 y",
    "İstanbul, Ab. ,. a.. İİ TAKSİ. TAKSİ, ढ़, שׁ.",
    "x" * 5000,
]


@pytest.mark.parametrize(("path", "space"), [(WORD, ""), (BYTE, " ")])
class TestIds:
    def same(self, path, space, texts, encoder=None):
        plain, encoder = Tokenizer.from_file(path), encoder or words.TextEncoder(path, space)
        assert [x.tolist() for x in encoder.encode(texts)] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]

    def test_odd_texts(self, path, space):
        self.same(path, space, ODD)
        self.same(path, space, [])
        for text in ODD:
            self.same(path, space, [text])

    def test_every_letter_before_a_mark(self, path, space):
        letters = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isalpha()]
        rng = random.Random(0)
        some = [c for c in letters if ord(c) < 0x3400 or ord(c) > 0xF8FF] + rng.sample(letters, 3000)
        texts = [" ".join(f"ab{c}{m}" for c in some[i : i + 500]) for m in ",." for i in range(0, len(some), 500)]
        self.same(path, space, texts)

    def test_white_space_at_random(self, path, space):
        rng = random.Random(1)
        texts = ["".join(rng.choice([" ", " ", "\n", "\t", "a", "b1", "'s", ".", "é", "\x85", "\x1f"]) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
        self.same(path, space, texts)

    def test_slices_and_forgotten_words(self, path, space, monkeypatch):
        rng = random.Random(2)
        texts = [" ".join(rng.choice(["ab", "cd.", "ef,", "gh", "i1", "jk", "l.", "M"]) for _ in range(30)) for _ in range(20)]
        monkeypatch.setattr(words, "SLICE_CHARS", 100)
        monkeypatch.setattr(words, "KEPT_WORDS", 5)
        self.same(path, space, [*texts, *ODD])
