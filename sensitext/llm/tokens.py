"""Token ids of texts by a public word-level tokenizer, with a bounded memory of words."""

from __future__ import annotations

import re
from array import array
from operator import attrgetter

MEMO_WORDS = 600_000
VOCAB = "word_bpe_49k.json"


def tokenizer_path(name: str = VOCAB) -> str:
    """Place of an installed vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Memo(dict):
    """Two generations of entries: words met again in time survive, others are dropped."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value


# Lower-case Latin letters that no normal form changes.
_LATIN = re.compile("[a-zß-öø-ɏ]+").fullmatch
# Marks that end a word as a piece of their own; the apostrophe may begin a suffix instead.
_TAIL = ".,;:!?#$%&*()[]{}<>|/+=-_~\"\\^`@"
_token_id = attrgetter("id")
_RUNS = re.compile(r"[^ \t\n\r\f\v]+").findall


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: its own if it prints, else a later one."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordTokenizer:
    """Encodes word by word, which gives the ids of the whole text.

    The vocabulary drops white space and no merge crosses it, so a text's ids are those of its
    words in order; each distinct word is encoded once while it is remembered. Plain
    Latin words go straight to the merges, all others through the whole tokenizer. Ids
    are packed, little-endian.
    """

    def __init__(self, path: str, dtype: str, memo_words: int = MEMO_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.code = {"<u2": "H", "<u4": "I"}[dtype]
        self.cores = _Memo(self._core, memo_words)
        self.words = _Memo(self._word, memo_words)

    def _pack(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def _core(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return self._pack(map(_token_id, self.model.tokenize(word)))

    def _word(self, word: str) -> bytes:
        lower = word.lower()
        core = lower.rstrip(_TAIL)
        if not _LATIN(core):
            return self._pack(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if core == word:
            return self._core(word)
        # Closing marks are a piece of their own, whole.
        return self.cores[core] + self.cores[lower[len(core) :]] if core != lower else self.cores[core]

    def encode(self, text: str) -> bytes:
        # str.split() also splits at these four, which are no white space to the vocabulary.
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
        return b"".join(map(self.words.__getitem__, _RUNS(text) if odd else text.split()))


_loaded: dict[tuple, WordTokenizer] = {}


def word_tokenizer(path: str, dtype: str) -> WordTokenizer:
    """The tokenizer of this Python process."""
    key = (path, dtype)
    if key not in _loaded:
        _loaded[key] = WordTokenizer(path, dtype)
    return _loaded[key]
