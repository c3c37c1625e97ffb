import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensitext.functions.losses import ce_loss, hidden_loss, kd_loss, total_loss
from sensitext.operators.distill import (
    LinearStudent,
    _shares,
    fit_student,
    kd_gradient,
    soft_labels,
)
from sensitext.operators.predict import linear_scorer
from sensitext.sources.sinks import read_history

RNG = np.random.default_rng(11)


def loss_of(w, x, t, y, temperature=4.0):
    def log_softmax(z):
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    s = x @ w.T
    ce = -log_softmax(s)[np.arange(len(y)), y]
    ls, lt = log_softmax(s / temperature), log_softmax(t / temperature)
    return (ce + temperature**2 * (np.exp(lt) * (lt - ls)).sum(axis=1)).mean()


def test_losses_by_hand(spark):
    df = spark.createDataFrame([([0.0, 0.0], [0.0, 0.0], 1), ([1.0, -2.0], [3.0, 0.5], 0)],
                               "s array<double>, t array<double>, label int")
    rows = df.select(ce_loss("s", "label").alias("ce"), kd_loss("s", "t").alias("kd")).collect()
    assert rows[0].ce == pytest.approx(math.log(2)) and rows[0].kd == 0.0
    assert rows[1].ce == pytest.approx(math.log(1 + math.exp(-3)))
    assert rows[1].kd > 0
    total = df.select(total_loss(F.lit(1.0), F.lit(2.0), F.lit(4.0))).first()[0]
    assert total == 5.0


def test_kd_is_zero_for_equal_logits_and_never_negative(spark):
    pairs = RNG.normal(scale=4, size=(50, 2, 2))
    df = spark.createDataFrame([(p[0].tolist(), p[1].tolist()) for p in pairs],
                               "s array<double>, t array<double>")
    row = df.select(F.min(kd_loss("s", "t")).alias("low"), F.max(F.abs(kd_loss("t", "t"))).alias("same")).first()
    assert row.low >= 0 and row.same == 0


def test_hidden_layers_are_mapped_by_factor(spark):
    t = RNG.normal(size=(8, 3))
    s = RNG.normal(size=(4, 3))
    df = spark.createDataFrame([(s.tolist(), t.tolist())], "s array<array<double>>, t array<array<double>>")
    want = sum(((s[i] - t[2 * i]) ** 2).mean() for i in range(4))
    assert df.select(hidden_loss("s", "t")).first()[0] == pytest.approx(want)
    assert df.select(hidden_loss("s", "s")).first()[0] == 0.0


@pytest.fixture(scope="module")
def problem(spark):
    x = RNG.normal(size=(30, 5))
    w, tw = RNG.normal(size=(2, 5)), RNG.normal(size=(2, 5))
    y = RNG.integers(0, 2, size=30)
    rows = [(xi.tolist(), (w @ xi).tolist(), (tw @ xi).tolist(), int(yi)) for xi, yi in zip(x, y)]
    df = spark.createDataFrame(
        rows, "v array<double>, s_logits array<double>, t_logits array<double>, label int"
    )
    return df, w, x, x @ tw.T, y


def test_gradient_equals_finite_differences(problem):
    df, w, x, t, y = problem
    got = np.zeros_like(w)
    for r in kd_gradient(df, "v").collect():
        got[r["class"], r.feature] = r.grad
    for c in range(2):
        for f in range(5):
            step = np.zeros_like(w)
            step[c, f] = 1e-5
            slope = (loss_of(w + step, x, t, y) - loss_of(w - step, x, t, y)) / 2e-5
            assert got[c, f] == pytest.approx(slope, abs=1e-6)


def test_gradient_does_not_depend_on_partitions(problem):
    df = problem[0]
    one, many = (
        {(r["class"], r.feature): r.grad for r in kd_gradient(df.repartition(n), "v").collect()}
        for n in (1, 6)
    )
    assert one == pytest.approx(many)


def test_soft_labels_are_stored(spark, problem):
    heads = [[1.0, 0, 0, 0, 0], [0, 1.0, 0, 0, 0]]
    soft = soft_labels(problem[0], linear_scorer("v", heads), keep=("v",))
    assert soft.inputFiles()
    for r in soft.collect():
        assert r.t_logits == pytest.approx(r.v[:2])
        assert sum(r.t_soft) == pytest.approx(1.0)


@pytest.fixture(scope="module")
def id_rows(spark):
    """Texts of ids 0-9 where id 3 decides the label and the teacher knows it."""
    rows = []
    for i in range(200):
        ids = RNG.integers(4, 10, size=int(RNG.integers(3, 9))).tolist()
        label = int(i % 2)
        ids[0] = 3 if label else 2
        rows.append((ids, label, [0.0, 6.0] if label else [6.0, 0.0],
                     "validation" if i % 5 == 0 else "train"))
    return spark.createDataFrame(
        rows, "input_ids array<int>, label int, t_logits array<double>, split string"
    )


def test_student_learns_and_history_is_kept(spark, id_rows, tmp_path):
    path = str(tmp_path / "history")
    student, steps = fit_student(id_rows, n_features=10, epochs=15, lr=0.3, history_path=path)
    losses = [s[3] for s in steps]
    assert losses[-1] < losses[0] / 2
    assert max(s[5] for s in steps) == 1.0
    scored = student.score_encoded(id_rows)
    wrong = scored.where((F.col("logits")[1] > F.col("logits")[0]).cast("int") != F.col("label"))
    assert wrong.where("split = 'validation'").count() == 0
    assert read_history(spark, path).count() == 15

    student.save(spark, str(tmp_path / "student"))
    again = LinearStudent.load(spark, str(tmp_path / "student"))
    assert np.array_equal(again.weights, student.weights)


def test_training_does_not_depend_on_partitions(id_rows):
    runs = [fit_student(id_rows.repartition(n), 10, epochs=4, lr=0.1)[0].weights for n in (1, 5)]
    assert np.allclose(*runs)


def test_first_step_equals_the_loss_gradient(id_rows):
    """One pass over the rows against a dense computation of the same loss."""
    from sensitext.operators.distill import _pass

    rows = id_rows.collect()
    w = RNG.normal(size=(2, 11))
    total = _pass(id_rows, w, 10, 4.0, 1.0)
    train = [r for r in rows if r.split == "train"]
    x = np.array([[*(np.bincount(r.input_ids, minlength=10) / np.sqrt(len(r.input_ids))), 1.0] for r in train])
    t, y = np.array([r.t_logits for r in train]), np.array([r.label for r in train])
    assert total["train_loss"] == pytest.approx(loss_of(w, x, t, y))
    for c, f in ((0, 3), (1, 2), (1, 10), (0, 7)):
        step = np.zeros_like(w)
        step[c, f] = 1e-5
        slope = (loss_of(w + step, x, t, y) - loss_of(w - step, x, t, y)) / 2e-5
        assert total["gradient"][c, f] == pytest.approx(slope, abs=1e-6)


def test_no_training_rows_is_an_error(id_rows):
    with pytest.raises(ValueError, match="no training rows"):
        fit_student(id_rows.where("split = 'validation'"), 10, epochs=1)


def plain_epochs(rows, epochs, lr, size, order, decay=0.01, temperature=4.0, sparsity=0.0):
    """AdamW over batches of ordered rows in plain NumPy; weights of untouched ids stay."""
    w, m, v, steps = (np.zeros((2, 11)) for _ in range(3)), None, None, 0
    w, m, v = w
    losses = []
    for epoch in range(1, epochs + 1):
        rate, total = lr * (1 - (epoch - 1) / epochs), []
        ordered = [rows[i] for i in order[epoch - 1]]
        for at in range(0, len(ordered), size):
            gradient, touched, loss = np.zeros_like(w), {10}, 0.0
            batch = ordered[at : at + size]
            for r in batch:
                x = np.zeros(11)
                for i in r.input_ids:
                    x[i] += 1 / np.sqrt(len(r.input_ids))
                    touched.add(i)
                x[10] = 1.0
                z, t = w @ x, np.array(r.t_logits)
                soft = lambda q: np.exp(q - q.max()) / np.exp(q - q.max()).sum()
                p, ps, pt = soft(z), soft(z / temperature), soft(t / temperature)
                y = np.eye(2)[r.label]
                loss += -np.log(p[r.label]) + temperature**2 * (pt * np.log(pt / ps)).sum()
                gradient += np.outer(p - y + temperature * (ps - pt), x) / len(batch)
            total.append(loss / len(batch))
            steps += 1
            for i in touched:
                m[:, i] = 0.9 * m[:, i] + 0.1 * gradient[:, i]
                v[:, i] = 0.999 * v[:, i] + 0.001 * gradient[:, i] ** 2
                move = m[:, i] / (1 - 0.9**steps) / (np.sqrt(v[:, i] / (1 - 0.999**steps)) + 1e-8)
                w[:, i] = w[:, i] * (1 - rate * decay) - rate * move
                if sparsity and i != 10:
                    w[:, i] = np.sign(w[:, i]) * np.maximum(np.abs(w[:, i]) - sparsity * rate, 0)
        losses.append(np.mean(total))
    return w, losses


@pytest.mark.parametrize("sparsity", [0.0, 0.2])
def test_one_worker_equals_a_plain_loop_over_batches(spark, id_rows, sparsity):
    train = id_rows.where("split = 'train'").select("input_ids", "label", "t_logits", "split")
    dealt = _shares(train.withColumn("label", F.col("label").cast("int")), 1, 42)
    places = [F.xxhash64("key", F.lit(42), F.lit(e)).alias(f"e{e}") for e in (1, 2, 3)]
    rows = dealt.select("*", *places).collect()
    order = [sorted(range(len(rows)), key=lambda i: (rows[i][f"e{e}"], rows[i].key)) for e in (1, 2, 3)]
    want, losses = plain_epochs(rows, 3, 0.1, 8, order, sparsity=sparsity)
    # Without validation rows the last weights are the result.
    student, history = fit_student(
        train, 10, epochs=3, lr=0.1, batch_size=8, workers=1, sparsity=sparsity
    )
    assert np.allclose(student.weights, want)
    assert np.allclose([h[3] for h in history], losses)
    assert history[-1][2] == 3 * -(-len(rows) // 8)


def test_copies_of_a_hot_row_are_dealt_to_all_workers(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 > 0, F.array(F.lit(1), F.lit(2)))
        .otherwise(F.array(F.lit(1), (F.col("id") % 7).cast("int")))
        .alias("input_ids"),
        F.lit(1).alias("label"),
        F.array(F.lit(0.0), F.lit(1.0)).alias("t_logits"),
        F.lit("train").alias("split"),
    )
    dealt = _shares(rows, 6, 42).groupBy("worker").count().collect()
    assert sum(r["count"] for r in dealt) == 9000
    assert len(dealt) == 6 and max(r["count"] for r in dealt) < 1.2 * min(r["count"] for r in dealt)


@pytest.mark.parametrize("bad", [10, 11, -1])
def test_ids_outside_of_the_features_are_refused(spark, id_rows, bad):
    extra = id_rows.limit(1).withColumn("input_ids", F.array(F.lit(1), F.lit(bad)))
    with pytest.raises(Exception, match="outside of the student's 10 features"):
        fit_student(id_rows.unionByName(extra), 10, epochs=1)
    student = LinearStudent(np.zeros((2, 11)))
    with pytest.raises(Exception, match="outside of the student's 10 features"):
        student.score_encoded(extra).collect()


def test_rare_ids_and_class_weights(spark, id_rows):
    student, _ = fit_student(id_rows, 10, epochs=2, lr=0.1, min_rows=10**6, balanced=True)
    assert not student.weights[:, :-1].any() and student.weights[:, -1].any()
