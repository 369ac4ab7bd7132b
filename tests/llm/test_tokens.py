"""Ids of units put together again are those of whole texts; worker caches stay bounded."""

import random

import pytest

from wagewright.llm import lexicon
from wagewright.llm.lexicon import Lexicon
from wagewright.llm.packing import Tokens, quick_encoder, vocabulary_path


@pytest.fixture(scope="module")
def tokens():
    return Tokens(vocabulary_path())


def whole(tokens, text):
    return [*tokens.tokenizer.encode(text, add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("letters", [
    ["a", "b", " ", " ", "\n", "\t", "\r\n", "\x0b", ".", ",", "'s", " 'll", "é", "ß", "1", "<|endoftext|>", "ing", "\x00", "$%&"],
    ["a", " ", "  ", "\x1c", "\x85", "\xa0", " ", " ", "\U0001f600", "中", "́", "ª", "²", "÷", "×", "​", "'S", "ﬁ"],
])
def test_units_give_the_ids_of_whole_texts(tokens, letters):
    draw = random.Random(len(letters))
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) for _ in range(20_000)] + [None, "x" * 30_000, " " * 3000, "\n"]
    for text, found in zip(texts, tokens.ids(texts), strict=True):
        assert found.tolist() == whole(tokens, text or ""), repr(text)


def test_only_a_byte_level_vocabulary_is_taken_apart():
    assert quick_encoder(vocabulary_path("byte_bpe_50k.json")) is not None
    assert quick_encoder(vocabulary_path("word_bpe_49k.json")) is None
    other = Tokens(vocabulary_path("word_bpe_49k.json"))
    for text, found in zip(["Two words  here", "", "a\n\nb"], other.ids(["Two words  here", "", "a\n\nb"]), strict=True):
        assert found.tolist() == whole(other, text)


def test_a_lexicon_forgets_and_reads_the_same(monkeypatch):
    draw = random.Random(3)
    terms = {"".join(draw.choice("abcdef") for _ in range(draw.randint(3, 9))): 1.0 + i for i in range(60)}
    words = ["".join(draw.choice("abcdef1") for _ in range(draw.randint(1, 9))) for _ in range(4000)] + list(terms)
    free = [Lexicon(terms, {"ab": 0.5}).read(w) for w in words]
    monkeypatch.setattr(lexicon, "WORDS", 3000)
    monkeypatch.setattr(lexicon, "MOVES", 500)
    tight = Lexicon(terms, {"ab": 0.5})
    sizes = []
    for w, want in zip(words, free, strict=True):
        assert tight.read(w) == want
        sizes.append((tight.words, tight.moves))
    assert max(a for a, _ in sizes) <= 3200 and max(b for _, b in sizes) <= 600
