"""Frequent grams equal a plain count, and a dictionary gives each a feature of its own."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sensitext.operators.grams import frequent_grams, gram_dictionary, grams_of
from sensitext.operators.train import evaluate, fit_teacher
from sensitext.plans.inputs import labelled
from sensitext.sources.models import load_model, save_model


def plain_count(rows, n, min_rows):
    seen = Counter()
    for tokens in rows:
        tokens = [t for t in tokens or [] if t is not None]
        seen.update(
            {(" ".join(tokens[i : i + k]), k) for k in range(1, n + 1) for i in range(len(tokens) - k + 1)}
        )
    return {g: c for g, c in seen.items() if c >= min_rows}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    made = [[rng.choice("abcdefgh") for _ in range(rng.randint(0, 9))] for _ in range(200)]
    return made + [None, [], ["a"], [None, "a", None, "b"], ["x"] * 3000]


@pytest.mark.parametrize("n, min_rows", [(1, 1), (2, 3), (3, 2), (3, 12), (2, 1000)])
def test_counts_are_those_of_all_grams(spark, rows, n, min_rows):
    df = spark.createDataFrame([(r,) for r in rows], "t array<string>")
    found = frequent_grams(df, "t", n, min_rows).collect()
    assert {(r.gram, r["size"]): r.n_rows for r in found} == plain_count(rows, n, min_rows)
    assert len(found) == len({(r.gram, r["size"]) for r in found})


def test_a_token_with_a_space_is_an_error(spark):
    df = spark.createDataFrame([(["a b"],)], "t array<string>")
    with pytest.raises(Exception, match="holds a space"):
        df.select(grams_of("t", 1)).collect()


def test_dictionary_order_and_size(spark, rows):
    df = spark.createDataFrame([(r,) for r in rows], "t array<string>")
    counts = plain_count(rows, 2, 3)
    want = [g for g, _ in sorted(counts, key=lambda g: (-counts[g], g[1], g[0]))]
    assert gram_dictionary(df, "t", 2, 3, 10_000) == want
    assert gram_dictionary(df, "t", 2, 3, 7) == want[:7]


def test_exact_features_of_a_teacher(spark, data_dir, tmp_path):
    train = labelled(spark, data_dir).where("split = 'train'").select("text", "label")
    detector = fit_teacher(train, max_iter=20, bigrams=True, dictionary=True)
    known = detector.model.stages[3].vocabulary
    fitted = detector.model.stages[-1]
    assert len(set(known)) == len(known) == fitted.numFeatures
    assert any(" " in g for g in known) and any(" " not in g for g in known)
    ids = [[str(i) for i in r.input_ids] for r in detector.encode(train).collect()]
    assert set(known) == {g for g, _ in plain_count(ids, 2, 3)}
    save_model(detector, str(tmp_path / "m"))
    a, b = (evaluate(m, train, by=None).first() for m in (detector, load_model(str(tmp_path / "m"))))
    assert a == b and a.eval_f1 > 0.5


def test_a_dictionary_needs_features(spark):
    rows = spark.createDataFrame([("ab", 0), ("cd", 1)], "text string, label int")
    with pytest.raises(ValueError, match="no feature"):
        fit_teacher(rows, dictionary=True, min_rows=5)


def test_a_bounded_dictionary_keeps_the_most_frequent(spark, data_dir):
    train = labelled(spark, data_dir).where("split = 'train'").select("text", "label")
    detector = fit_teacher(train, max_iter=2, n_features=50, dictionary=True)
    assert detector.model.stages[-1].numFeatures == 50
    scored = detector.score(train.select("text").limit(3))
    assert scored.where(F.size("logits") == 2).count() == 3


def test_ends_of_a_gram_are_hashed_once(spark):
    df = spark.createDataFrame([(["a", "b", "a"],)] * 3, "t array<string>")
    plan = frequent_grams(df, "t", 2, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("substring_index") == 2
