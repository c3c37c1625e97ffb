"""Longest-match splitting of words in linear time, by a trie with failure links.

Published as LinMaxMatch (Song et al., Fast WordPiece Tokenization, 2021). Where no token goes on
with the next letter, the failure link of the place reached says which tokens the
letters read so far end in and where the rest stands among the ``##`` forms, so no letter is
read twice. Links are made once, on the driver; the tables are as large as the vocabulary's letters.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

from sensitext.constants import MAX_WORD_CHARS

_INNER = "##"
_UNKNOWN = ["[UNK]"]
# Bits of a code point; an edge is a place and a letter in one number.
_LETTER = 21
# Places at which the first piece of a word, and those inside of it, start.
_WORD, _REST = 0, 1


class LongestMatch:
    """Splits words into the pieces of a vocabulary, greedy from the left.

    A word that cannot be split whole, or is longer than ``MAX_WORD_CHARS``, is unknown.
    """

    def __init__(self, tokens: Iterable[str]) -> None:
        self.edges: dict[int, int] = {}
        self.links: list[int] = [-1, -1]
        self.pops: list[tuple[str, ...]] = [(), ()]
        ends: dict[int, str] = {}
        for token in tokens:
            # A word may begin as a ``##`` form is spelt.
            self._grow(_WORD, token, token, ends)
            if token.startswith(_INNER):
                self._grow(_REST, token.removeprefix(_INNER), token, ends)
        self._link(ends)

    def _grow(self, place: int, letters: str, token: str, ends: dict[int, str]) -> None:
        if not letters:
            return
        for letter in letters:
            place = self.edges.setdefault(place << _LETTER | ord(letter), len(self.links))
            if place == len(self.links):
                self.links.append(-1)
                self.pops.append(())
        ends[place] = token

    def _link(self, ends: dict[int, str]) -> None:
        """Links by rising depth: what is read ends in ``pops``, and the rest stands at ``links``."""
        children: list[list[tuple[int, int]]] = [[] for _ in self.links]
        for edge, child in self.edges.items():
            children[edge >> _LETTER].append((edge & ((1 << _LETTER) - 1), child))
        todo = deque((_WORD, _REST))
        while todo:
            place = todo.popleft()
            for letter, child in children[place]:
                todo.append(child)
                if child in ends:
                    self.links[child], self.pops[child] = _REST, (ends[child],)
                    continue
                at, popped = self.links[place], self.pops[place]
                while at >= 0 and (at << _LETTER | letter) not in self.edges:
                    popped += self.pops[at]
                    at = self.links[at]
                if at >= 0:
                    self.links[child] = self.edges[at << _LETTER | letter]
                    self.pops[child] = popped

    def split(self, word: str) -> list[str]:
        if len(word) > MAX_WORD_CHARS:
            return list(_UNKNOWN)
        edges, links, pops = self.edges, self.links, self.pops
        place, pieces = _WORD, []
        for letter in map(ord, word):
            ahead = edges.get(place << _LETTER | letter)
            while ahead is None:
                if links[place] < 0:
                    return list(_UNKNOWN)
                pieces += pops[place]
                place = links[place]
                ahead = edges.get(place << _LETTER | letter)
            place = ahead
        # What is left must end in whole pieces.
        while place > _REST:
            if links[place] < 0:
                return list(_UNKNOWN)
            pieces += pops[place]
            place = links[place]
        return pieces
