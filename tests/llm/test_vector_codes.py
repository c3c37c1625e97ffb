"""Vector codes against Lloyd's rounds with all distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from sensitext.llm.vector_codes import Balls, learn_books, vector_codes

COLUMNS = "code string, vec_id bigint, embedding array<float>, label int, error string"


def brute(rows, parts=16, entries=64, rounds=2):
    """``[(vec_id, code, error, label_error, digest)]`` of ``(vec_id, vector, label)``."""
    kept = [
        (v, [math.floor(256 * float(np.float32(x))) for x in e], label)
        for v, e, label in rows
        if e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([e for _, e, _ in kept]).reshape(len(kept), parts, -1)
    book = x[:entries].transpose(1, 0, 2).copy()
    for k in range(rounds + 1):
        far = ((x[:, :, None] - book[None]) ** 2).sum(axis=-1)
        codes, least = far.argmin(axis=2), far.min(axis=2)
        if k < rounds:
            for p in range(parts):
                for e in range(book.shape[1]):
                    own = x[codes[:, p] == e, p]
                    if len(own):
                        book[p, e] = own.sum(axis=0) // len(own)
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    errors = least.sum(axis=1).tolist()
    total = {}
    for (_, _, label), error in zip(kept, errors):
        total[label] = total.get(label, 0) + error
    return sorted(
        (repr((v, "".join(f"{c:02x}" for c in code), error, total[label], digest)))
        for (v, _, label), code, error in zip(kept, codes.tolist(), errors)
    )


def ours(spark, rows):
    frame = spark.createDataFrame([("c", *r, "e") for r in rows], COLUMNS).repartition(3)
    found = vector_codes(frame)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(repr(tuple(r)) for r in found.collect())


def vectors(n, width, rng, spread=0.3):
    return [[rng.gauss(0, spread) for _ in range(width)] for _ in range(n)]


def test_codes_equal_brute_force_with_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, v, i % 3 or None) for i, v in enumerate(vectors(400, 32, rng))]
    nan, inf = float("nan"), float("inf")
    rows += [(-5, None, 1), (-4, [nan] * 32, 1), (-3, [inf] * 32, 2), (-2, [-inf] + [0.0] * 31, 1)]
    rows += [(-1, [None] + [0.0] * 31, 1), (None, rows[0][1], 1), (7, rows[7][1], 1), (7, rows[9][1], 0)]
    rows += [(1000 + i, rows[3][1], 9) for i in range(50)]
    assert ours(spark, rows) == brute(rows)


def test_ties_go_to_the_lower_entry(spark):
    """Few different whole numbers, so that most distances and many entries are equal."""
    rng = random.Random(8)
    rows = [(i, [rng.randrange(-1, 2) / 256 for _ in range(16)], 1) for i in range(300)]
    rows += [(i, [rng.randrange(-4, 5) / 256 for _ in range(16)], 2) for i in range(300, 700)]
    assert ours(spark, rows) == brute(rows)


def test_fewer_vectors_than_entries(spark):
    rng = random.Random(1)
    rows = [(i, v, None) for i, v in enumerate(vectors(5, 16, rng))]
    assert ours(spark, rows) == brute(rows)
    assert ours(spark, rows[:1]) == brute(rows[:1])


def test_no_usable_vectors_give_no_rows(spark):
    assert ours(spark, []) == []
    assert ours(spark, [(1, None, 1), (2, [float("nan")] * 16, 1)]) == []


def test_other_widths_are_an_error(spark):
    with pytest.raises(ValueError, match="cannot be cut"):
        ours(spark, [(1, [0.5] * 20, 1)])
    with pytest.raises(Exception, match="must all have 16 components"):
        ours(spark, [(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)])


def test_balls_find_the_nearest_from_any_start_and_skip_the_core():
    rng = np.random.default_rng(6)
    centres = rng.integers(-500, 500, (40, 4))
    points = centres[rng.integers(0, 40, 3000)] + rng.integers(-25, 26, (3000, 4))
    far = ((points[:, None] - centres[None]) ** 2).sum(axis=-1)
    want = far.argmin(axis=1)
    for start in (np.zeros(3000, np.int64), rng.integers(0, 40, 3000), want):
        balls = Balls(centres)
        best, least = balls.nearest(points, start)
        assert (best == want).all() and (least == far.min(axis=1)).all()
    # From the nearest entries hardly any part lies outside of the stable cores.
    assert balls.compared < 3000 * 40 / 20


def test_books_do_not_depend_on_partitions(spark, data_dir):
    frame = spark.read.parquet(f"{data_dir}/embeddings.parquet")
    one, many = (learn_books(frame.repartition(n)) for n in (1, 7))
    assert len(one) == 3 and all((a == b).all() for a, b in zip(one, many))
