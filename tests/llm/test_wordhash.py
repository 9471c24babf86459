import random

import numpy as np
import pyarrow as pa

from termloom.llm import wordhash
from termloom.llm.wordhash import WordHasher


def hashes(texts, **options):
    return [w.tolist() for _, w in WordHasher(**options).texts(pa.array(texts, pa.string()))]


def test_equal_words_only():
    rng = random.Random(1)
    words = {"".join(rng.choice("ab\x00é字") for _ in range(rng.randrange(1, 40))) for _ in range(20_000)}
    words |= {"a" * n for n in range(1, 600)} | {"\x00" * n for n in range(1, 40)}
    words = sorted(words)
    own = [h[0] for h in hashes(words)]
    assert len(set(own)) == len(words)
    rng.shuffle(words)
    text = " \n".join(words)
    assert hashes([text, None, "", text[:50] + " " + text[50:]])[0] == [h[0] for h in hashes(words)]


def test_words_that_collide_under_polynomials():
    a = "a"
    for _ in range(12):  # a Thue-Morse word and its complement
        a += a.translate({97: 98, 98: 97})
        b = a.translate({97: 98, 98: 97})
        x, y = hashes([a, b])
        assert len(x) == len(y) == 1 and x != y


def test_lower_case_and_long_texts(monkeypatch):
    assert hashes(["ÀBC Abc"], lower=True)[0][1] == hashes(["abc"], lower=True)[0][0]
    assert hashes(["ABC"])[0] != hashes(["abc"])[0]
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("xyz") for _ in range(rng.randrange(1, 300))) for _ in range(400))
    whole = hashes([text])
    monkeypatch.setattr(wordhash, "CHUNK", 64)
    assert hashes([text]) == whole
    assert np.array_equal(hashes(["a b", text, "c"])[1], whole[0])
