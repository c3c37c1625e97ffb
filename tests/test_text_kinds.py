"""Kinds of text: the probes and their like, and the model against plain counting."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sensitext.operators.text_kinds import SYMBOLS, fit_pairs, kind_counts, text_kind
from sensitext.plans.kind_queries import text_kinds


@pytest.fixture(scope="module")
def model(spark, data_dir):
    return fit_pairs(spark.read.parquet(f"{data_dir}/documents.parquet"))


def kinds_of(spark, texts, model):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = frame.select("i", text_kind(F.col("text"), model).alias("k")).collect()
    return [r.k for r in sorted(rows)]


def test_model_equals_plain_counts(spark, data_dir, model):
    texts = [r.text or "" for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()]
    pairs, code = Counter(), lambda c: 26 if c == " " else ord(c) - 97
    for text in texts:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        form = re.sub("[^a-z]+", " ", lower).strip(" ")
        pairs.update(code(a) * SYMBOLS + code(b) for a, b in zip(form, form[1:]))
    firsts = Counter()
    for k, n in pairs.items():
        firsts[k // SYMBOLS] += n
    log_p = [math.log((pairs[k] + 1) / (firsts[k // SYMBOLS] + SYMBOLS)) for k in range(SYMBOLS**2)]
    assert model.log_p == pytest.approx(log_p)
    corpus = sum(n * log_p[k] for k, n in pairs.items()) / sum(pairs.values())
    assert model.least == pytest.approx((corpus + sum(log_p) / len(log_p)) / 2)


def test_probes(spark, model):
    rng = random.Random(4)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40)) for _ in range(20)]
    texts = [None, "", " \t\n", "1234567890", "12 34", "7", "aaaaaaaa", "。。。", "A A A", "x", "abc", *noise]
    found = kinds_of(spark, texts, model)
    assert found[:11] == ["blank"] * 3 + ["digits"] * 3 + ["repeated"] * 3 + ["text"] * 2
    assert found[11:].count("noise") >= 19
    assert kinds_of(spark, ["客户合同与付款账号", "12a", "total 500 EUR"], model) == ["text"] * 3


def test_prose_is_text(spark, data_dir, model):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    plain = docs.where(F.col("text").rlike("^[A-Za-z \n]{40,}$"))
    counts = {r.kind: r.n for r in kind_counts(plain, model).collect()}
    assert set(counts) <= {"text", "noise"} and counts.get("noise", 0) <= 0.05 * sum(counts.values())


def test_empty_corpus(spark):
    empty = spark.createDataFrame([], "text string")
    model = fit_pairs(empty)
    assert kind_counts(empty, model).collect() == []
    assert kinds_of(spark, ["abcdefghijkl", "11"], model) == ["text", "digits"]


def test_words_are_counted_before_they_are_judged(spark, data_dir):
    plan = text_kinds(spark, data_dir)._jdf.queryExecution().optimizedPlan().toString()
    # That of the kinds, and that of the words below it.
    assert plan.count("Aggregate [") == 2


def test_pairs_of_words_are_those_of_the_text(spark):
    texts = ["ab ab c", "ab", "c", "", None, "A-b", "  z  "]
    model = fit_pairs(spark.createDataFrame([(t,) for t in texts], "text string"))
    pairs = Counter(p for t in ("ab ab c", "ab", "a b") for p in zip(t, t[1:]))
    code = lambda c: 26 if c == " " else ord(c) - 97
    firsts = Counter(a for a, b in pairs.elements())
    for (a, b), n in pairs.items():
        want = math.log((n + 1) / (firsts[a] + SYMBOLS))
        assert model.log_p[code(a) * SYMBOLS + code(b)] == pytest.approx(want)
