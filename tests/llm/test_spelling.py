"""Spelling variants against brute force, scan by scan and as a whole."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensitext.llm.spelling import roots, runs, scan, spelling_forms, spelling_variants, word_counts

COLUMNS = "word string, doc_id bigint, text string, n string, rest int, list int"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute_forms(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= 5 * n:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {
        w: (form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None)
        for w, n in words.items()
    }


def brute_words(docs):
    total = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def as_dict(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = frame.collect()
    found = {r.word: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def test_runs_are_letters_of_latin_1():
    text = "Straße-ÀB×c 中xĀy é nï1"
    wanted = re.findall("[A-Za-zÀ-ÿ]+", text)
    lower = ["".join(c.lower() if c.isascii() else c for c in w) for w in wanted]
    assert [w.decode("latin-1") for w in runs(text)] == lower


def test_scan_finds_the_pairs_of_each_list():
    rng = random.Random(5)
    for _ in range(200):
        rests, lists = [], []
        for k in range(rng.randrange(1, 5)):
            size = rng.randrange(1, 6)
            words = {
                "".join(rng.choice("abé") for _ in range(size + rng.randrange(2)))
                for _ in range(rng.randrange(1, 30))
            }
            rests += sorted(words)
            lists += [k] * len(words)
        a, b = scan(rests, np.array(lists))
        got = list(zip(a.tolist(), b.tolist()))
        assert len(got) == len(set(got))
        assert set(got) == {
            (i, j)
            for i, j in combinations(range(len(rests)), 2)
            if lists[i] == lists[j] and one_edit(rests[i], rests[j])
        }


@pytest.fixture(scope="module")
def words(spark):
    """Words of few letters, many of them near, with ties, runs of one letter and a long one."""
    rng = random.Random(9)
    found = {"".join(rng.choice("abc") for _ in range(rng.choice((6, 7, 8)))): 0 for _ in range(900)}
    found |= {"a" * k: 0 for k in range(6, 40)} | {"x" * 3000: 0, "x" * 3001: 0, "éèêëàâ": 0, "éèêëàà": 0}
    return {w: rng.choice((5, 6, 30, 30, 200, 5000)) for w in found}


def test_forms_equal_brute_force(spark, words):
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    assert as_dict(spelling_forms(frame)) == brute_forms(words)


def test_long_lists_are_parted_without_loss(spark, words):
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert as_dict(spelling_forms(frame, most_words=10, cells=300)) == brute_forms(words)


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(11)] + [("a", "w5"), ("b", "c")]
    ends = {r.word: r.root for r in roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert ends == {**{f"w{i}": "w11" for i in range(11)}, "a": "w11", "b": "c"}


def test_texts_with_nulls_repeats_and_clashing_columns(spark):
    rng = random.Random(2)
    stems = ["anderes", "andere", "Anderer", "größeres", "größere", "ÀÀÀÀÀÀ", "kurz", "variant", "varaint"]
    texts = [" ".join(rng.choices(stems, weights=[40, 3, 2, 30, 2, 1, 9, 30, 2], k=300)) for _ in range(30)]
    texts += [None, "", "  ", "中文 текст", "z" * 50_000, "z" * 50_000, *texts[:3]]
    docs = [(i % 31 if i % 9 else None, t) for i, t in enumerate(texts)]
    rows = [("w", d, t, "n", 1, 2) for d, t in docs]
    frame = spark.createDataFrame(rows, COLUMNS).repartition(4)
    wanted = brute_forms(brute_words(docs))
    assert wanted and any(v[0] for v in wanted.values())
    assert as_dict(spelling_variants(frame)) == wanted


def test_words_come_to_the_same_counts_when_tasks_send_them_early(spark, data_dir, monkeypatch):
    import sensitext.llm.spelling as spelling

    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    whole = {tuple(r) for r in word_counts(docs).collect()}
    monkeypatch.setattr(spelling, "MEMO_WORDS", 50)
    assert {tuple(r) for r in word_counts(docs).collect()} == whole
    pairs = docs.select("doc_id", "text").collect()
    assert dict(whole) == brute_words([tuple(r) for r in pairs])


def test_no_documents_give_no_words(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert as_dict(spelling_variants(empty)) == {}
    blank = empty.unionByName(
        spark.createDataFrame([("w", 1, None, "n", 1, 1)], COLUMNS)
    ).withColumn("n", F.lit("x"))
    assert as_dict(spelling_variants(blank)) == {}
