import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import WordPiece
from tokenizers.normalizers import BertNormalizer
from tokenizers.pre_tokenizers import BertPreTokenizer

from probes import PROBES
from sensitext.constants import FIRST_FREE_ID, SPECIAL_TOKENS, UNK_ID
from sensitext.functions.text import basic_tokens, leading_tokens
from sensitext.operators.encoding import (
    _parts,
    add_model_inputs,
    as_int32,
    build_vocab,
    encode,
    ensure_token_types,
    length_profile,
    pad,
    tokens_to_ids,
    vocab_dict,
    wordpiece,
)
from sensitext.plans.encoding_queries import QUERIES


@pytest.fixture(scope="module")
def probe_frame(spark):
    rows = [(i, kind, text) for i, (kind, text) in enumerate(PROBES)]
    return spark.createDataFrame(rows, "i int, kind string, text string")


@pytest.fixture(scope="module")
def corpus(spark, data_dir):
    return spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def vocab(corpus):
    return vocab_dict(build_vocab(corpus, 1500))


def tokens_of(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    return df.select(basic_tokens("text").alias("t")).first().t


@pytest.mark.parametrize(
    "text, expected",
    [
        ("报价42万，ok", ["报", "价", "42", "万", "，", "ok"]),
        ("don't stop", ["don", "'", "t", "stop"]),
        ("a [SEP] b [sep]", ["a", "[SEP]", "b", "[", "sep", "]"]),
        ("a\x00b​c", ["abc"]),
        ("x　y z", ["x", "y", "z"]),
        ("Größe", ["Größe"]),
        ("", []),
        (" \t\n", []),
        (None, None),
    ],
)
def test_basic_tokens(spark, text, expected):
    assert tokens_of(spark, text) == expected


@pytest.mark.parametrize("limit", [1, 5, 126, 511, 600])
def test_leading_tokens_equal_the_cut_of_all_tokens(spark, corpus, probe_frame, limit):
    texts = corpus.select("text").union(probe_frame.select("text"))
    same = leading_tokens("text", limit).eqNullSafe(F.slice(basic_tokens("text"), 1, limit))
    assert texts.where(~same).count() == 0


def test_wordpiece_greedy_and_unknown(spark):
    vocab = {"un": 1, "unaff": 2, "##aff": 3, "##able": 4, "##a": 5, "[UNK]": 100}
    words = spark.createDataFrame(
        [("unaffable",), ("unb",), ("un",), ("u" * 101,), ("xyz",)], "word string"
    )
    got = {r.word: r.pieces for r in wordpiece(words, vocab).collect()}
    assert got["unaffable"] == ["unaff", "##able"]
    assert got["unb"] == ["[UNK]"]
    assert got["un"] == ["un"]
    assert got["u" * 101] == ["[UNK]"]
    assert got["xyz"] == ["[UNK]"]


def test_unknown_tokens_and_order(spark):
    df = spark.createDataFrame([(1, ["b", "?", "a", "b"]), (2, []), (3, None)], "k int, tokens array<string>")
    rows = {r.k: r.ids for r in tokens_to_ids(df, {"a": 7, "b": 8}).collect()}
    assert rows == {1: [8, UNK_ID, 7, 8], 2: [], 3: None}


def test_vocabulary_layout(corpus, vocab):
    assert {t: vocab[t] for t in SPECIAL_TOKENS} == SPECIAL_TOKENS
    others = sorted(i for t, i in vocab.items() if t not in SPECIAL_TOKENS)
    assert others == list(range(104, 1500))
    assert vocab["##e"] and vocab["e"]
    chars = {c for r in corpus.select(F.explode(basic_tokens("text")).alias("w")).distinct().collect()
             for c in r.w if r.w not in SPECIAL_TOKENS}
    assert all(c in vocab and "##" + c in vocab for c in chars)


def test_vocabulary_size_is_checked():
    with pytest.raises(ValueError, match="exceeds 2"):
        vocab_dict({"a": 1, "b": 2, "c": 3}, 2)


def test_ids_equal_an_independent_tokenizer(spark, corpus, probe_frame, vocab):
    other = Tokenizer(WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=100))
    other.normalizer = BertNormalizer(
        clean_text=True, handle_chinese_chars=True, strip_accents=False, lowercase=False
    )
    other.pre_tokenizer = BertPreTokenizer()
    other.add_special_tokens(list(SPECIAL_TOKENS))
    texts = corpus.select(F.col("text")).union(probe_frame.select("text")).where("text IS NOT NULL")
    rows = encode(texts, vocab, keep_raw=True).select("text", "input_ids", "truncated").collect()
    assert len(rows) > 200
    for row in rows:
        full = other.encode(row.text, add_special_tokens=False).ids
        assert row.input_ids == [101, *full[:126], 102]
        assert row.truncated == (len(full) > 126)


@pytest.mark.parametrize("padding, width", [("none", None), ("max_length", 128)])
def test_encoded_shapes(probe_frame, vocab, padding, width):
    for row in encode(probe_frame, vocab, padding=padding).collect():
        size = len(row.input_ids)
        assert size <= 128 and (width is None or size == width)
        assert len(row.attention_mask) == len(row.token_type_ids) == size
        content = sum(row.attention_mask)
        assert row.attention_mask == [1] * content + [0] * (size - content)
        assert row.input_ids[0] == 101 and row.input_ids[content - 1] == 102
        assert row.input_ids[content:] == [0] * (size - content)
        assert set(row.token_type_ids) == {0}


def test_empty_text_and_null_text(spark, vocab):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "nan")], "k int, text string")
    rows = {r.k: r.input_ids for r in encode(df, vocab).collect()}
    assert rows[1] == [101, 102]
    assert rows[2] == rows[3]


def test_truncation_boundary(spark):
    df = spark.createDataFrame([(n, " ".join(["a"] * n)) for n in (125, 126, 127)], "n int, text string")
    rows = {r.n: r for r in encode(df, {"a": 200}).collect()}
    assert [len(rows[n].input_ids) for n in (125, 126, 127)] == [127, 128, 128]
    assert [rows[n].truncated for n in (125, 126, 127)] == [False, False, True]


def test_encode_does_not_depend_on_partitions(corpus, vocab):
    def digest(df):
        return sorted((r.doc_id, tuple(r.input_ids)) for r in encode(df, vocab).collect())

    assert digest(corpus.repartition(1)) == digest(corpus.repartition(9))


def test_padding_to_the_longest_of_a_batch(spark):
    df = spark.createDataFrame(
        [(0, [1]), (0, [1, 2, 3]), (1, [5, 6])], "batch_id int, input_ids array<int>"
    )
    rows = sorted((r.batch_id, r.input_ids) for r in pad(df, "longest", batch_col="batch_id").collect())
    assert rows == [(0, [1, 0, 0]), (0, [1, 2, 3]), (1, [5, 6])]
    full = add_model_inputs(df, "longest", batch_col="batch_id").collect()
    assert sorted(r.attention_mask for r in full) == [[1, 0, 0], [1, 1], [1, 1, 1]]
    with pytest.raises(ValueError):
        pad(df, "longest")
    with pytest.raises(ValueError):
        pad(df, "shortest")


def test_token_types_are_added_only_when_absent(spark):
    df = spark.createDataFrame([([1, 2],)], "input_ids array<bigint>")
    added = ensure_token_types(df)
    assert added.first().token_type_ids == [0, 0]
    kept = ensure_token_types(df.withColumn("token_type_ids", F.array(F.lit(1), F.lit(1))))
    assert kept.first().token_type_ids == [1, 1]
    assert as_int32(added).schema["input_ids"].dataType.simpleString() == "array<int>"


def test_length_profile(spark):
    df = spark.createDataFrame(
        [("train", 0, [1] * 4, False), ("train", 0, [1] * 8, True)],
        "split string, batch_id int, input_ids array<int>, truncated boolean",
    )
    row = length_profile(df, max_length=8, batch_col="batch_id").first()
    assert (row.mean_length, row.max_length, row.truncated_share) == (6.0, 8, 0.5)
    assert (row.padding_fixed, row.padding_longest) == (4, 4)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(words=st.lists(st.text("ab中é1!", min_size=0, max_size=6), max_size=30))
def test_any_text_round_trips(spark, words):
    text = " ".join(words)
    got = tokens_of(spark, text)
    assert "".join(got) == text.replace(" ", "")


def test_words_keep_a_place_among_very_many_characters(spark):
    text = " ".join(chr(0x4E00 + k) for k in range(11_000)) + " hello" * 1000
    tokens = {r.token for r in build_vocab(spark.createDataFrame([(text,)], "text string")).collect()}
    assert "hello" in tokens


def test_characters_take_the_ids_that_words_leave_free(spark):
    size = 21_128
    chars = [chr(0x4E00 + k) for k in range(11_000)]
    corpus = spark.createDataFrame([(" ".join(chars) + " hello" * 1000,)], "text string")
    tokens = {r.token for r in build_vocab(corpus, size).collect()}
    assert tokens >= {*chars, *"helo", "hello", "##e", "##l", "##o"}
    assert len(tokens) == size - FIRST_FREE_ID + len(SPECIAL_TOKENS)
    # Words keep their share where both are too many, each kind in its own order.
    words = [f"w{k:05}" for k in range(400)]
    both = spark.createDataFrame([(" ".join(chars[:300] + words),)], "text string")
    tokens = {r.token for r in build_vocab(both, FIRST_FREE_ID + 200).collect()}
    assert sum(t in words for t in tokens) == 100 and len(tokens) == 200 + len(SPECIAL_TOKENS)
    ids = [r.id for r in build_vocab(both, FIRST_FREE_ID + 200).collect()]
    assert len(set(ids)) == len(ids) and max(ids) == FIRST_FREE_ID + 199


def test_lengths_are_counted_once_for_both_orders(spark, data_dir):
    plan = QUERIES["length_batches"](spark, data_dir)._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan


def test_numbered_rows_to_pad_are_encoded_once(spark, data_dir):
    plan = QUERIES["pad_longest"](spark, data_dir)._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan


def test_word_lists_are_taken_in_parts():
    """Behind its first list, which may be long, a part holds fewer words than were asked for."""
    rows = [["a"] * n for n in (3, 0, 4, 50, 1, 1, 1, 9)] + [None, ["b"]]
    batch = pa.array(rows, pa.list_(pa.string()))
    for batch, rows in ((batch, rows), (batch.slice(2, 5), rows[2:7]), (batch.slice(0, 0), [])):
        parts = [p.to_pylist() for p in _parts(batch, 10)]
        assert [x for p in parts for x in p] == rows
        assert all(sum(map(len, filter(None, p[1:]))) < 10 for p in parts)


def test_words_are_counted_once_for_letters_and_words(spark):
    """One scan of the texts serves both parts of the vocabulary."""
    texts = spark.createDataFrame([("ab abc a b c abc",), (None,), ("x 7",)], "text string")
    vocab = build_vocab(texts.repartition(2))
    found = {r.token for r in vocab.collect()}
    assert {"ab", "abc", "##a", "7", "##x"} <= found and "##abc" not in found
    plan = vocab._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan[: plan.index("Initial Plan")]
