"""Text to token arrays, and the array shapes a BERT-style model takes.

Tokenising follows the published BERT basic tokenizer with lower-casing and accent
stripping off: control characters are dropped, every CJK character and every
punctuation mark is a token, special tokens stay whole, the rest splits at white space.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sensitext.constants import CLS_ID, MAX_LENGTH, PAD_ID, SEP_ID, SPECIAL_TOKENS

# Code point ranges that count as CJK characters.
CJK = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}"
    r"\x{2A700}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)

_SPECIAL = r"\[(?:" + "|".join(t.strip("[]") for t in SPECIAL_TOKENS) + r")\]"
_PUNCT = r"[!-/:-@\[-`{-~]|\p{P}"
# The regex engine tests the parts of a class, and alternatives, from left to right. Ranges
# of common letters and the ASCII block stand first, so one or two comparisons settle most
# characters. Below U+0080 cleaned text holds only letters, digits, marks and white space.
_WORD = (
    r"[a-z[A-Z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}[^\x00-\x7F\p{Z}\p{P}" + CJK + r"]]]++"
)
CONTROL_PATTERN = (
    r"[[^ -~]&&[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}\x{FFFD}\p{Cf}\p{Co}]]"
)
TOKEN_PATTERN = f"{_WORD}|{_SPECIAL}|{_PUNCT}|[{CJK}]"

# A counted group nests one match per repetition on the Java stack.
_MAX_COUNTED_TOKENS = 512


def clean_text(text: Column) -> Column:
    """Drop U+FFFD and control, format and private-use characters except tab and line ends."""
    return F.regexp_replace(text, CONTROL_PATTERN, "")


def basic_tokens(text: Column | str) -> Column:
    """All tokens of the whole text."""
    return _extract_tokens(clean_text(_col(text)))


def leading_tokens(text: Column | str, limit: int) -> Column:
    """The first ``limit`` tokens, equal to ``slice(basic_tokens(text), 1, limit)``.

    Used where the model's maximum length cuts the rest anyway: matching stops after
    ``limit`` tokens, so a very long text costs no more than its head.
    """
    cleaned = clean_text(_col(text))
    if limit > _MAX_COUNTED_TOKENS:
        return F.slice(_extract_tokens(cleaned), 1, limit)
    head = rf"^(?:[\s\p{{Z}}]*+(?:{TOKEN_PATTERN})){{0,{limit}}}"
    return _extract_tokens(F.regexp_extract(cleaned, head, 0))


def characters(word: Column | str) -> Column:
    """Code points of a word that is not empty, in order."""
    return F.split(_col(word), "")


def add_specials_and_truncate(ids: Column | str, max_length: int = MAX_LENGTH) -> Column:
    """``[CLS] content [SEP]`` with the content cut so that the whole fits ``max_length``."""
    if max_length < 2:
        raise ValueError("max_length must leave room for [CLS] and [SEP]")
    return F.concat(
        F.array(F.lit(CLS_ID)), F.slice(_col(ids), 1, max_length - 2), F.array(F.lit(SEP_ID))
    )


def pad_ids(ids: Column | str, length: Column | int, value: int = PAD_ID) -> Column:
    """Append ``value`` until the array is ``length`` long; longer arrays stay as they are."""
    ids = _col(ids)
    missing = F.greatest(_int(length) - F.size(ids), F.lit(0))
    return F.concat(ids, F.array_repeat(F.lit(value), missing))


def attention_mask(content_length: Column, padded_length: Column | int | None = None) -> Column:
    """Ones over the content and zeros over the padding, from lengths alone."""
    ones = F.array_repeat(F.lit(1), content_length)
    if padded_length is None:
        return ones
    missing = F.greatest(_int(padded_length) - content_length, F.lit(0))
    return F.concat(ones, F.array_repeat(F.lit(0), missing))


def token_type_ids(ids: Column | str) -> Column:
    """Zeros, as long as ``ids``."""
    return F.array_repeat(F.lit(0), F.size(_col(ids)))


def _extract_tokens(text: Column) -> Column:
    # White space is taken along with the token after it, which saves a search per gap.
    return F.regexp_extract_all(text, F.lit(rf"\s*+({TOKEN_PATTERN})"), F.lit(1))


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _int(x: Column | int) -> Column:
    return F.lit(x) if isinstance(x, int) else x
