"""Leaks against BM25 over all pairs of passage and unit, counted in plain Python."""

import math
import random
import re
from collections import Counter

import pytest

from sensitext.llm.decontaminate import OVERLAP, PASSAGE, RUN, SCORE, UNIT, find_leaks
from sensitext.llm.decontaminate import question_and_answer

ITEM = "item_id bigint, text string"
DOC = "doc_id bigint, text string, block int, term string"


def words_of(text):
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def parts_of(words):
    n = -(-len(words) // UNIT)
    sizes = [len(words) // n + (k < len(words) % n) for k in range(n)]
    return [words[sum(sizes[:k]) : sum(sizes[: k + 1])] for k in range(n)]


def grams(words, n):
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def brute_leaks(docs, items):
    """``{(doc, item): (score, question, answer, passages, first word)}`` by places in the lists."""
    units = [(i, Counter(u)) for i, t in enumerate(items) if words_of(t) for u in parts_of(words_of(t))]
    df = Counter(w for _, u in units for w in u)
    mean = sum(sum(u.values()) for _, u in units) / len(units)

    def impacts(unit):
        size, out = sum(unit.values()), {}
        for w, tf in unit.items():
            idf = math.log(1 + (len(units) - df[w] + 0.5) / (df[w] + 0.5))
            out[w] = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))
        return {w: x / sum(out.values()) for w, x in out.items()}

    weighed = [(i, impacts(u)) for i, u in units]
    found = {}
    for d, text in enumerate(docs):
        words = words_of(text)
        starts = [0]
        while starts[-1] + PASSAGE < len(words):
            starts.append(starts[-1] + PASSAGE // 2)
        for s in starts if words else []:
            passage = set(words[s : s + PASSAGE])
            for i, impact in weighed:
                score = sum(x for w, x in impact.items() if w in passage)
                if score < SCORE - 1e-9:
                    continue
                near = len(words_of(items[i]))
                around = words[max(0, s - near) : min(s + PASSAGE, len(words)) + near]
                shares = []
                for part in map(words_of, question_and_answer(items[i])):
                    n = min(RUN, len(part))
                    own, there = grams(part, n), grams(around, min(n, len(around)))
                    shares.append(len(own & there) / len(own) if n else 1.0)
                if min(shares) < OVERLAP:
                    continue
                old = found.setdefault((d, i), [0.0, 0.0, 0.0, 0, s])
                old[:3] = max(old[0], score), max(old[1], shares[0]), max(old[2], shares[1])
                old[3] += 1
    return found


@pytest.fixture(scope="module")
def tables():
    """Items of words of very uneven frequency; documents with whole and partial copies."""
    rng = random.Random(17)
    vocabulary = [f"w{k}" for k in range(400)]
    weights = [1 / (k + 1) for k in range(400)]
    draw = lambda n: rng.choices(vocabulary, weights, k=n)
    items = []
    for _ in range(80):
        body = draw(rng.choice((6, 12, 30, 70, 160)))
        cut = len(body) * 2 // 3
        items.append(" ".join(body[:cut]) + "?\n" + " ".join(body[cut:]))
    docs = []
    for k in range(60):
        text = draw(rng.randrange(0, 500))
        for item in rng.sample(items, 3):
            copy = item.split()
            keep = rng.choice((1.0, 0.9, 0.7, 0.5))
            at = rng.randrange(len(text) + 1)
            text[at:at] = copy[: max(1, int(keep * len(copy)))]
        docs.append(" ".join(text).upper() if k % 2 else "\n".join(text))
    return docs, items


def rounded(values):
    return tuple(round(float(v), 9) for v in values)


def found_by(spark, docs, items, **kw):
    left = spark.createDataFrame([(k, t, 1, "t") for k, t in enumerate(docs)], DOC).repartition(3)
    right = spark.createDataFrame(list(enumerate(items)), ITEM).repartition(2)
    return {(r.doc_id, r.item_id): rounded(tuple(r)[2:]) for r in find_leaks(left, right, **kw).collect()}


def test_leaks_equal_brute_force_for_any_number_of_blocks(spark, tables):
    docs, items = tables
    want = {k: rounded(v) for k, v in brute_leaks(docs, items).items()}
    assert len(want) > 60 and any(v[0] < 0.95 for v in want.values())
    assert found_by(spark, docs, items) == want
    size = sum(len(t.encode()) for t in items)
    assert found_by(spark, docs, items, block_bytes=size // 11 + 1) == want


def test_items_without_an_id_are_searched(spark):
    texts = [" ".join(f"{x}{k}" for k in range(20)) + "." for x in "abc"]
    items = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (3, texts[1]), (4, None)], ITEM)
    docs = spark.createDataFrame([(k, f"x {t} y", 0, "") for k, t in enumerate(texts)], DOC)
    for block in (1 << 20, 40):
        got = find_leaks(docs, items, block_bytes=block).collect()
        pairs = sorted((r.doc_id, -1 if r.item_id is None else r.item_id) for r in got)
        assert pairs == [(0, -1), (1, -1), (1, 3)]


def test_nothing_to_search(spark):
    none = spark.createDataFrame([], DOC)
    docs = spark.createDataFrame([(1, None, 0, ""), (None, "", 0, ""), (2, "some words", 0, "")], DOC)
    items = spark.createDataFrame([(1, "some words")], ITEM)
    assert find_leaks(none, items).collect() == []
    for empty in (items.limit(0), spark.createDataFrame([(1, None), (2, ""), (3, " ?!")], ITEM)):
        assert find_leaks(docs, empty).collect() == []
    assert [r.doc_id for r in find_leaks(docs, items).collect()] == [2]
