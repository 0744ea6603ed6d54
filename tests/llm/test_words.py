import random

import numpy as np

from docweave.llm import words as W
from llm.conftest import EDGE_TEXTS

BLANKS = [" ", "\n", "\t", "\x0b", "\x0c", "\r", "  ", "\u00a0", "\x00", ""]


def test_hashed_words_are_the_words():
    rng = random.Random(7)
    texts = [t.encode() if t is not None else None for t in EDGE_TEXTS]
    texts += ["".join(rng.choice(["a", "ab", "ba", "é", "x" * 64, "x" * 65, "x" * 66, "longer"]) + rng.choice(BLANKS) for _ in range(rng.randrange(30))).encode() for _ in range(200)]
    for part in (texts, texts[:1], texts[1:2], [], [None, b"", b" "], [b"a"], [b" a "]):
        split, starts = W.split_words(part)
        codes, found = W.hashed_words(part)
        assert np.array_equal(found, starts)
        assert len(codes) == len(split)
        by_word = {}
        for word, code in zip(split, codes.tolist()):
            assert by_word.setdefault(word, code) == code
        assert len(set(by_word.values())) == len(by_word)


def test_codes_by_definition():
    word = "né\u00e4x".encode()
    expected = sum(int(W._TABLE[i * 256 + b]) for i, b in enumerate(word)) % (1 << 64)
    assert W.hashed_words([b"other " + word])[0].tolist()[1] == expected
