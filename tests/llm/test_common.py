"""Word hashes: equal for equal words, also very long ones, and apart for patterned ones."""

import random
import re

import numpy as np

from sensitext.llm.common import word_hashes
from sensitext.llm.ngram_join import ngram_components


def hashes(texts, plain=False):
    raw = "".join(texts).encode()
    bounds = np.cumsum([0, *(len(t.encode()) for t in texts)])
    found, starts, at = word_hashes(np.frombuffer(raw, np.uint8), bounds, plain)
    return [found[at[i] : at[i + 1]].tolist() for i in range(len(texts))]


def folded(word):
    """A long word of two letters and its opposite, which meet under sums of powers."""
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_equal_words_have_equal_hashes():
    rng = random.Random(1)
    alphabet = "abAB0é\x00-"
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    texts = ["", "  ", *(" ".join(rng.choices(words, k=rng.randrange(9))) + " \t\n" for _ in range(500))]
    seen = {}
    for plain in (False, True):
        seen.clear()
        for text, got in zip(texts, hashes(texts, plain)):
            lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            pattern = r"(?:[a-z0-9]|[^\x00-\x7f])+" if plain else r"[^\x20\x09-\x0D]+"
            own = re.findall(pattern, lower)
            assert len(own) == len(got)
            for word, h in zip(own, got):
                assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


def test_patterned_words_stay_apart(spark):
    first, second = folded("a"), folded("b")
    assert len(first) == 1024 and first != second
    (a,), (b,) = hashes([first, second])
    assert a != b
    zeros = hashes(["a", "a\x00", "a" + "\x00" * 8, "\x00" * 8, "\x00" * 16])
    assert len({h[0] for h in zeros}) == 5
    docs = spark.createDataFrame([(1, first), (2, second)], "doc_id bigint, text string")
    assert {r.component_id for r in ngram_components(docs, n=4, percent=85).collect()} == {1, 2}
