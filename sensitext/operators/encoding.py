"""Vocabulary, WordPiece and model inputs.

Encoding makes no shuffle. The vocabulary has a fixed upper size, so it travels to the
executors as a broadcast value, and an Arrow UDF turns the tokens of each row into ids.
Inside an Arrow batch every distinct word is split once and the ids are gathered by
NumPy; frequent words cost nothing extra and no word becomes a hot key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sensitext.constants import (
    FIRST_FREE_ID,
    MAX_LENGTH,
    MAX_WORD_CHARS,
    SPECIAL_TOKENS,
    UNK_ID,
    VOCAB_SIZE,
)
from sensitext.functions.text import (
    add_specials_and_truncate,
    attention_mask,
    basic_tokens,
    characters,
    leading_tokens,
    pad_ids,
    token_type_ids,
)
from sensitext.operators.longest_match import LongestMatch
from sensitext.operators.prep import coerce_label, coerce_text
from sensitext.sources.settings import TokenizerSettings

Vocab = DataFrame | dict[str, int]
# The columns that name a batch; the number alone does not where epochs or splits have their own.
BatchKey = str | Sequence[str]
MODEL_INPUTS = ("input_ids", "attention_mask", "token_type_ids")
# Tokens that a vocabulary held by every task may have.
MAX_VOCAB = 500_000
# Letters of words a Python worker remembers before it starts afresh, and the words it takes at a time.
_MEMO_LETTERS = 1_000_000
_WORDS_AT_ONCE = 100_000


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Occurrences of every token over whole texts: ``word, n``."""
    return (
        df.select(F.explode(basic_tokens(text_col)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def build_vocab(
    df: DataFrame, size: int = VOCAB_SIZE, text_col: str = "text", char_share: float = 0.5
) -> DataFrame:
    """A vocabulary from a corpus: ``token, id``, at most ``size`` ids.

    Special tokens keep their reserved ids; then come all characters and their ``##``
    forms, then words, each by falling count and rising token. Where the forms of characters
    do not fit, those ``##`` forms give way first whose character never stands inside a word, and
    words keep up to ``1 - char_share`` of the ids, as many as there are words for; characters
    take all the others.
    Words longer than ``MAX_WORD_CHARS`` do not count, as they are never split into pieces.
    Characters are counted
    over distinct words, so the corpus itself is exploded once, into words. For the final
    choice each task sends on its first entries alone, never more than ``size``.
    """
    room = size - FIRST_FREE_ID
    if not 0 < room < MAX_VOCAB:
        raise ValueError(f"size must lie between {FIRST_FREE_ID + 1} and {MAX_VOCAB}")
    words = word_counts(df, text_col).where(
        (F.length("word") <= MAX_WORD_CHARS) & ~F.col("word").isin(list(SPECIAL_TOKENS))
    )
    letters = words.select(
        F.explode(
            F.transform(
                characters("word"), lambda c, i: F.struct(c.alias("token"), (i > 0).alias("inside"))
            )
        ).alias("p"),
        "n",
    )
    counted = letters.groupBy("p.token").agg(
        F.sum("n").alias("n"), F.max("p.inside").alias("inside")
    )
    own = F.struct("token", F.lit(True).alias("met"))
    inner = F.struct(F.concat(F.lit("##"), "token").alias("token"), F.col("inside").alias("met"))
    order = [F.desc("is_char"), F.desc("n"), F.asc("token")]
    met_first = [F.desc("met"), *order]
    forms = counted.select(
        F.explode(F.array(own, inner)).alias("f"), F.lit(1).alias("is_char"), "n"
    ).select("f.*", "is_char", "n")
    chars = forms.orderBy(*met_first).limit(room)
    # Words are counted already, once each. Those of one letter are told by the order and left out behind
    # the limit: a filter would sink below the count, which then no longer serves the letters too.
    long = F.length("word") > 1
    whole = (
        words.orderBy(F.desc(long), F.desc("n"), F.asc("word"))
        .limit(room)
        .where(long)
        .select(F.col("word").alias("token"), F.lit(True).alias("met"), F.lit(0).alias("is_char"), "n")
    )
    # One task chooses among at most twice ``room`` rows.
    kind = Window.partitionBy("is_char").orderBy(*met_first)
    words_kept = F.least(
        F.sum(1 - F.col("is_char")).over(Window.partitionBy()),
        F.lit(room - max(1, int(room * char_share))),
    )
    top = (
        chars.unionByName(whole)
        .select("*", F.row_number().over(kind).alias("_rank"), words_kept.alias("_words"))
        .where(F.col("_rank") <= F.when(F.col("is_char") == 1, room - F.col("_words")).otherwise(room))
        .orderBy(*order)
        .limit(room)
    )
    # One task numbers the rows: there are at most ``room`` of them.
    ranked = top.select(
        "token",
        (F.row_number().over(Window.orderBy(*order)) + F.lit(FIRST_FREE_ID - 1)).alias("id"),
    )
    return _specials(df.sparkSession).unionByName(ranked)


def vocab_dict(vocab: Vocab, max_size: int = MAX_VOCAB) -> dict[str, int]:
    """The vocabulary as a dict on the driver; more than ``max_size`` tokens is an error."""
    if not isinstance(vocab, DataFrame):
        result = dict(vocab)
    else:
        rows = vocab.select("token", "id").limit(max_size + 1).collect()
        result = {row.token: row.id for row in rows}
    if len(result) > max_size:
        raise ValueError(f"vocabulary exceeds {max_size} tokens")
    return result


def wordpiece(words: DataFrame, vocab: Vocab, word_col: str = "word") -> DataFrame:
    """Pieces of each word, greedy longest match from the left: ``word, pieces``."""
    shared = words.sparkSession.sparkContext.broadcast(LongestMatch(vocab_dict(vocab)))

    @F.arrow_udf("array<string>")
    def to_pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        split = shared.value.split
        for batch in batches:
            yield pa.array([None if w is None else split(w) for w in batch.to_pylist()])

    return words.select(
        F.col(word_col).alias("word"), to_pieces(F.col(word_col)).alias("pieces")
    )


def tokens_to_ids(
    df: DataFrame, vocab: Vocab, tokens_col: str = "tokens", ids_col: str = "ids"
) -> DataFrame:
    """Add the id of every token, in order; a token outside the vocabulary gets ``[UNK]``."""
    return df.withColumn(ids_col, _ids_column(df.sparkSession, vocab, F.col(tokens_col), False))


def word_ids(df: DataFrame, vocab: Vocab, words_col: str, ids_col: str) -> DataFrame:
    """Add the ids of the WordPiece pieces of every word, in order."""
    return df.withColumn(ids_col, _ids_column(df.sparkSession, vocab, F.col(words_col), True))


def encode(
    df: DataFrame,
    vocab: Vocab,
    max_length: int = MAX_LENGTH,
    padding: str = "none",
    text_col: str = "text",
    batch_col: BatchKey | None = None,
    on_null: str = "nan",
    keep_raw: bool = False,
    settings: TokenizerSettings | None = None,
) -> DataFrame:
    """Model inputs for each text: ids, mask, token types, and ``labels`` if ``label`` exists.

    With ``settings`` no input is longer than their ``model_max_length``.

    A word gives at least one piece, so words beyond ``max_length - 1`` cannot matter:
    they are cut before WordPiece. One word more than fits is looked at, to tell whether
    the text was ``truncated``.
    """
    max_length = settings.longest(max_length) if settings else max_length
    source = coerce_text(df, on_null, text_col)
    words = source.withColumn("_words", leading_tokens(text_col, max_length - 1))
    pieces = word_ids(words, vocab, "_words", "_ids")
    out = pieces.withColumn("input_ids", add_specials_and_truncate("_ids", max_length)).withColumn(
        "truncated", F.size("_ids") > F.lit(max_length - 2)
    )
    if "label" in df.columns:
        out = coerce_label(out.withColumn("labels", F.col("label")), "labels")
    out = add_model_inputs(out.drop("_words", "_ids"), padding, max_length, batch_col)
    return out if keep_raw else out.drop(text_col, "label")


def add_model_inputs(
    df: DataFrame, padding: str = "none", max_length: int = MAX_LENGTH, batch_col: BatchKey | None = None
) -> DataFrame:
    """Pad ``input_ids`` and add mask and token types of the same length."""
    length = padded_length(padding, max_length, batch_col)
    sized = df.withColumn("_n", F.size("input_ids"))
    sized = sized.withColumn("_padded", F.col("_n") if length is None else length)
    out = sized.withColumn("attention_mask", attention_mask(F.col("_n"), F.col("_padded")))
    if length is not None:
        out = out.withColumn("input_ids", pad_ids("input_ids", F.col("_padded")))
    return ensure_token_types(out).drop("_n", "_padded")


def padded_length(
    padding: str, max_length: int = MAX_LENGTH, batch_col: BatchKey | None = None
) -> Column | None:
    """Length to pad ``input_ids`` to; a batch holds a fixed number of rows."""
    if padding == "none":
        return None
    if padding == "max_length":
        return F.lit(max_length)
    if padding == "longest":
        if batch_col is None:
            raise ValueError("padding='longest' needs batch_col")
        return F.max(F.size("input_ids")).over(
            Window.partitionBy(*_names(batch_col))
        )
    raise ValueError(f"padding must be 'none', 'longest' or 'max_length', not {padding!r}")


def pad(
    df: DataFrame, padding: str, max_length: int = MAX_LENGTH, batch_col: BatchKey | None = None
) -> DataFrame:
    """Pad ``input_ids`` alone."""
    length = padded_length(padding, max_length, batch_col)
    return df if length is None else df.withColumn("input_ids", pad_ids("input_ids", length))


def ensure_token_types(df: DataFrame) -> DataFrame:
    """Add zero token types where the frame has none."""
    if "token_type_ids" in df.columns:
        return df
    return df.withColumn("token_type_ids", token_type_ids("input_ids"))


def as_int32(df: DataFrame) -> DataFrame:
    """Cast the model inputs a frame has to 32-bit integers."""
    present = [c for c in MODEL_INPUTS if c in df.columns]
    return df.withColumns({c: F.col(c).cast("array<int>") for c in present})


def length_profile(
    encoded: DataFrame, max_length: int = MAX_LENGTH, batch_col: BatchKey | None = None
) -> DataFrame:
    """Lengths, truncation and padding per split, for unpadded ``encoded``.

    ``padding_longest`` appears with ``batch_col`` and counts padding to the longest row
    of each batch. Exact percentiles are cheap here: there are at most ``max_length``
    different lengths.
    """
    n = F.size("input_ids")
    keys = _names(batch_col) if batch_col else []
    rows = encoded.select("split", n.alias("n"), "truncated", *[k for k in keys if k != "split"])
    extra = []
    if batch_col:
        # In one pass over the encoded rows; a batch holds a fixed number of them.
        batch = Window.partitionBy("split", *[k for k in keys if k != "split"])
        rows = rows.withColumn("_longest", F.max("n").over(batch))
        extra = [F.sum(F.col("_longest") - F.col("n")).alias("padding_longest")]
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg("n").alias("mean_length"),
        F.max("n").alias("max_length"),
        F.percentile("n", F.lit(0.5)).alias("median_length"),
        F.percentile("n", F.lit(0.95)).alias("p95_length"),
        F.avg(F.col("truncated").cast("double")).alias("truncated_share"),
        F.sum(F.lit(max_length) - F.col("n")).alias("padding_fixed"),
        *extra,
    )


def _names(key: BatchKey) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _specials(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SPECIAL_TOKENS.items()), "token string, id int")


def _ids_column(spark: SparkSession, vocab: Vocab, words: Column, split_words: bool) -> Column:
    known = vocab_dict(vocab)
    shared = spark.sparkContext.broadcast((known, LongestMatch(known) if split_words else None))

    @F.arrow_udf("array<int>")
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids, matcher = shared.value
        memo: dict[str, list[int]] = {}
        letters = 0

        def lookup(word: str) -> list[int]:
            nonlocal letters
            found = memo.get(word)
            if found is None:
                pieces = [word] if matcher is None else matcher.split(word)
                found = memo[word] = [ids.get(p, UNK_ID) for p in pieces]
                # Any entry costs as much as some letters do.
                letters += len(word) + 10
            return found

        for batch in batches:
            parts = []
            for part in _parts(batch, _WORDS_AT_ONCE):
                if letters > _MEMO_LETTERS:
                    memo.clear()
                    letters = 0
                parts.append(_map_words(part, lookup))
            yield parts[0] if len(parts) == 1 else pa.concat_arrays(parts)

    return to_ids(words)


def _parts(batch: pa.ListArray, most: int) -> Iterator[pa.ListArray]:
    """The lists in order, in parts of about ``most`` words; a list is never cut."""
    ends = np.cumsum(batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(ends // most)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(batch)]):
        yield batch.slice(start, end - start)


def _map_words(batch: pa.ListArray, lookup) -> pa.ListArray:
    """Replace each word of each list by its ids, one lookup per distinct word."""
    null_rows = batch.is_null()
    counts = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    coded = batch.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    tables = [lookup(word) for word in coded.dictionary.to_pylist()]
    sizes = np.fromiter((len(t) for t in tables), dtype=np.int64, count=len(tables))
    flat = np.fromiter((i for t in tables for i in t), dtype=np.int32, count=int(sizes.sum()))
    first = np.cumsum(sizes) - sizes

    word_sizes = sizes[codes]
    ends = np.cumsum(word_sizes)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(first[codes] - (ends - word_sizes), word_sizes)
    values = flat[shift + np.arange(total)]

    row_ends = np.cumsum(counts)
    ends_with_zero = np.concatenate(([0], ends))
    offsets = np.concatenate(([0], ends_with_zero[row_ends])).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(values, pa.int32()), mask=null_rows
    )
