"""Token counts of texts without a space, against the library and in time."""

import random
import string
import time

import public_tokenizers
import pytest
import sentencepiece

from txrisk.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABETS = {"letters": string.ascii_lowercase, "base64": string.ascii_letters + string.digits + "+/", "digits": string.digits,
             "marks": string.punctuation + "▁", "words": ["the", "ing", "tion", "é", "中", "😀", "un"], "one": "a"}


@pytest.fixture(scope="module")
def both():
    return token_counts.PieceCounter(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize("name", ALPHABETS)
def test_counts_equal_the_library(both, name):
    counter, library = both
    rng = random.Random(name)
    texts = ["".join(rng.choice(ALPHABETS[name]) for _ in range(n)) for n in (1, 63, 64, 65, 66, 400, 5000)]
    texts += [f"a {t} b\n{t[:70]}" for t in texts]
    assert counter.count(texts) == [len(x) for x in library.encode(texts)]


@pytest.mark.parametrize("name", ["letters", "base64"])
def test_a_very_long_word_is_counted_in_time(both, name):
    counter, library = both
    rng = random.Random(4)
    text = "".join(rng.choice(ALPHABETS[name]) for _ in range(320_000))
    start = time.perf_counter()
    got = counter.count([text])
    assert time.perf_counter() - start < 5
    assert got == [len(library.encode(text))]


def test_parts_join_to_the_word(both):
    rng = random.Random(5)
    word = "".join(rng.choice(ALPHABETS["base64"]) for _ in range(1000))
    parts = both[0]._parts(word)
    assert "".join(parts) == word and len(parts) > 100 and both[0]._parts("a" * 100) == ["a" * 100]
