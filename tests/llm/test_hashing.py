import random

import numpy as np

from sheafwork.llm import hashing


def test_words_hashed_at_once_have_the_hashes_of_single_words():
    rng = random.Random(1)
    for alphabet in (bytes(range(256)), b"abCD \t\n\x0b\x0c\r\x1c\x85\x00 "):
        for number in range(40):
            texts = [bytes(rng.choices(alphabet, k=rng.randrange(200))) for _ in range(number % 6)]
            texts += [b"one", b"", b"  ", b"a" * 8 + b" " + b"B" * 9]
            expected = [hashing.word_hashes(hashing.words(text)) for text in texts]
            hashes, ends = hashing.word_hashes_of(texts)
            assert hashes.tolist() == np.concatenate(expected).tolist()
            assert ends.tolist() == np.cumsum([len(x) for x in expected]).tolist()
    assert [x.tolist() for x in hashing.word_hashes_of([])] == [[], []]
