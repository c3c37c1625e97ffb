import pytest

from sensitext.operators import history as hist
from sensitext.operators import metrics
from sensitext.sources.sinks import HISTORY_SCHEMA

HISTORY = [
    ("a", 1, 50, 0.70, 0.50, 0.80),
    ("a", 2, 100, 0.55, 0.40, 0.90),
    ("a", 3, 150, 0.45, 0.40, 0.90),
    ("a", 4, 200, 0.40, 0.45, 0.85),
    ("b", 1, 50, 0.80, 0.60, 0.00),
]


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame(HISTORY, HISTORY_SCHEMA)


def predicted(spark, rows):
    return spark.createDataFrame(rows, "split string, label int, pred int")


def test_metrics_by_hand(spark):
    rows = [("v", 1, 1)] * 3 + [("v", 0, 1)] + [("v", 1, 0)] * 2 + [("v", 0, 0)] * 4
    df = predicted(spark, rows)
    c = metrics.confusion(df).first()
    assert (c.tp, c.fp, c.fn, c.tn) == (3, 1, 2, 4)
    m = metrics.compute_metrics(df, "split").first()
    assert (m.eval_accuracy, m.eval_precision, m.eval_recall, m.eval_f1) == (0.7, 0.75, 0.6, 0.6667)
    assert metrics.accuracy(df).first().accuracy == pytest.approx(0.7)


def test_zero_denominators_give_zero(spark):
    df = predicted(spark, [("v", 1, 0), ("v", 0, 0)])
    r = metrics.precision_recall_f1(df).first()
    assert (r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0)
    none = metrics.precision_recall_f1(predicted(spark, [("v", 0, 0)])).first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)


def test_no_rows(spark):
    empty = predicted(spark, [])
    assert metrics.accuracy(empty).first().accuracy is None
    assert metrics.compute_metrics(empty).first().eval_f1 == 0.0


def test_short_last_batch_weighs_the_same(spark):
    df = spark.createDataFrame(
        [(1, 0, 1.0), (1, 0, 3.0), (1, 1, 8.0)], "epoch int, batch_id int, loss double"
    )
    assert metrics.epoch_loss(df).first().train_loss == 5.0


def test_log_rows(spark):
    df = spark.createDataFrame(
        [("a", s, float(s)) for s in range(1, 121)], "run string, step int, train_loss double"
    )
    rows = metrics.log_rollup(df).orderBy("log_row").collect()
    assert [(r.log_row, r.step, r.train_loss) for r in rows] == [
        (0, 50, 25.5), (1, 100, 75.5), (2, 120, 110.5),
    ]


def test_first_lowest_loss_wins(history):
    got = {r.run: r.epoch for r in hist.best_by_loss(history).collect()}
    assert got == {"a": 2, "b": 1}


def test_last_highest_accuracy_wins(history):
    got = {r.run: r.epoch for r in hist.best_by_accuracy(history).collect()}
    assert got == {"a": 3, "b": 1}


def test_new_best_includes_ties_and_zero(history):
    rows = hist.is_new_best(history).orderBy("run", "epoch").collect()
    assert [r.is_new_best for r in rows] == [True, True, True, False, True]


def test_retained(history):
    rows = hist.retained(history).orderBy("run", "epoch").collect()
    assert [(r.run, r.epoch) for r in rows] == [("a", 2), ("a", 4), ("b", 1)]
    assert hist.retained(history, limit=1).where("run = 'a'").first().epoch == 2
