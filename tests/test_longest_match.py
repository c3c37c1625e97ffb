"""Splitting by links equals trying every length, and reads each letter once."""

import random

import pytest
from hypothesis import given, settings, strategies as st

from sensitext.constants import MAX_WORD_CHARS
from sensitext.operators.encoding import word_ids, wordpiece
from sensitext.operators.longest_match import LongestMatch


def every_length(vocab, word):
    """Greedy from the left: the longest token first, at every start."""
    if len(word) > MAX_WORD_CHARS:
        return ["[UNK]"]
    pieces, start = [], 0
    while start < len(word):
        for end in range(len(word), start, -1):
            piece = ("##" if start else "") + word[start:end]
            if piece in vocab:
                pieces.append(piece)
                start = end
                break
        else:
            return ["[UNK]"]
    return pieces


token = st.text("ab#中", min_size=1, max_size=6)
vocabularies = st.sets(st.one_of(token, token.map(lambda t: "##" + t)), max_size=25)


@settings(max_examples=1500, deadline=None)
@given(vocabularies, st.lists(st.text("ab#中", max_size=14), max_size=8))
def test_pieces_are_those_of_every_length(vocab, words):
    matcher = LongestMatch(vocab)
    for word in words:
        assert matcher.split(word) == every_length(vocab, word)


def test_larger_vocabularies():
    rng = random.Random(5)
    make = lambda n: "".join(rng.choice("abcde") for _ in range(rng.randint(1, n)))
    vocab = {make(8) for _ in range(3000)} | {"##" + make(8) for _ in range(3000)}
    matcher = LongestMatch(vocab)
    for _ in range(3000):
        word = make(30)
        assert matcher.split(word) == every_length(vocab, word)


class Counted(dict):
    lookups = 0

    def get(self, *args):
        self.lookups += 1
        return super().get(*args)


@pytest.mark.parametrize("n", [10, 50, 100])
def test_lookups_grow_with_the_letters(n):
    # Every start could go on to the end but for the last letter.
    vocab = {"a" * k for k in range(1, 100)} | {"##a", "##" + "a" * 99 + "b"}
    matcher = LongestMatch(vocab)
    matcher.edges = Counted(matcher.edges)
    word = "a" * n
    assert matcher.split(word) == every_length(vocab, word)
    matcher.split("a" * (n - 1) + "c")
    # A letter is looked up once, and once more for each piece it closes.
    assert matcher.edges.lookups <= 4 * n


def test_words_beyond_the_limit_are_unknown(spark):
    long = "a" * (MAX_WORD_CHARS + 1)
    vocab = {"[UNK]": 100, long: 200, "a": 201, "##a": 202, "##中": 203}
    words = spark.createDataFrame([(long,), ("aa中",), ("b",), ("",), (None,)], "word string")
    got = {r.word: r.pieces for r in wordpiece(words, vocab).collect()}
    assert got == {long: ["[UNK]"], "aa中": ["a", "##a", "##中"], "b": ["[UNK]"], "": [], None: None}
    rows = spark.createDataFrame([([long, "aa中"],), ([],), (None,)], "w array<string>")
    ids = [r.ids for r in word_ids(rows, vocab, "w", "ids").collect()]
    assert ids == [[100, 201, 202, 203], [], None]
