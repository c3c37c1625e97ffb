import pytest
from pyspark.sql import functions as F

from probes import PROBES
from sensitext.operators.distill import fit_student, soft_labels
from sensitext.operators.predict import detect, predict, predict_probes
from sensitext.operators.train import Detector, evaluate, fit_teacher
from sensitext.plans import model_queries
from sensitext.sources.labelled import texts
from sensitext.sources.models import load_model, save_model
from sensitext.streaming.score_stream import read_stream, score_stream

MARK = "机密"


@pytest.fixture(scope="module")
def rows(spark):
    """Texts whose label is told by one word."""
    made = []
    for i in range(240):
        label = i % 2
        words = [f"w{(i * k) % 13}" for k in range(1, 8)]
        words.insert(i % 7, MARK if label else "公开")
        made.append((i, " ".join(words), label, "validation" if i % 4 < 2 and i % 3 == 0 else "train"))
    return spark.createDataFrame(made, "doc_id int, text string, label int, split string")


@pytest.fixture(scope="module")
def teacher(rows):
    return fit_teacher(rows.where("split = 'train'"), n_features=1 << 12, max_iter=10)


def test_teacher_learns_the_word(teacher, rows):
    found = {r.split: r for r in evaluate(teacher, rows).collect()}
    assert found["validation"].eval_accuracy == 1.0 and found["validation"].eval_f1 == 1.0
    assert found["validation"].eval_loss < 0.3


def test_bigrams_can_be_added(rows):
    model = fit_teacher(rows.where("split = 'train'"), n_features=1 << 12, max_iter=5, bigrams=True)
    assert evaluate(model, rows, by=None).first().eval_accuracy > 0.95


def test_single_and_batch_predictions(teacher):
    answer = teacher.predict(f"w1 {MARK} w2")
    assert set(answer) == {"label", "confidence", "is_sensitive"}
    assert answer["label"] == 1 and answer["is_sensitive"]
    many = teacher.batch_predict(["w1 公开", f"{MARK} w3"])
    assert [m["label"] for m in many] == [0, 1]


def test_saved_model_predicts_the_same(spark, teacher, rows, tmp_path):
    path = str(tmp_path / "model")
    save_model(teacher, path)
    again = load_model(path)
    assert again.id2label == teacher.id2label and again.vocab == teacher.vocab
    a = predict(rows, teacher, keep=("doc_id",)).orderBy("doc_id").collect()
    b = predict(rows, again, keep=("doc_id",)).orderBy("doc_id").collect()
    assert a == b


def test_folder_without_a_model_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no model folder"):
        load_model(str(tmp_path / "nothing"))


def test_probes_get_answers(spark, teacher):
    df = spark.createDataFrame(PROBES, "kind string, text string")
    found = predict_probes(df, teacher).collect()
    assert sum(r.n for r in found) == len(PROBES)
    records = predict(texts(spark, [t for _, t in PROBES]), teacher, keep=("i",)).collect()
    assert all(0.5 <= r.confidence <= 1.0 for r in records)


def test_student_follows_the_teacher(spark, teacher, rows, tmp_path):
    encoded = teacher.encode(rows).select("doc_id", "label", "split", "input_ids")
    soft = soft_labels(encoded, teacher.score_encoded)
    student, steps = fit_student(soft, epochs=12, lr=0.3)
    assert steps[-1][3] < steps[0][3]
    model = Detector(student, teacher.vocab)
    assert evaluate(model, rows.where("split = 'validation'")).first().eval_accuracy > 0.95
    path = str(tmp_path / "student")
    save_model(model, path)
    a = detect(rows, model, keep=("doc_id",)).orderBy("doc_id").collect()
    b = detect(rows, load_model(path), keep=("doc_id",)).orderBy("doc_id").collect()
    assert a == b


def test_stream_equals_batch_and_restarts(spark, teacher, rows, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "doc_id int, text string"

    def run():
        stream = read_stream(spark, source, schema, max_files_per_trigger=1)
        score_stream(stream, teacher, sink, str(tmp_path / "cp"), keep=("doc_id",)).awaitTermination()
        return spark.read.parquet(sink).orderBy("doc_id").collect()

    first, second = rows.where("doc_id < 100"), rows.where("doc_id >= 100")
    first.select("doc_id", "text").repartition(3).write.parquet(source)
    assert run() == detect(first, teacher, keep=("doc_id",)).orderBy("doc_id").collect()
    second.select("doc_id", "text").write.mode("append").parquet(source)
    assert run() == detect(rows, teacher, keep=("doc_id",)).orderBy("doc_id").collect()


def test_rows_of_the_fit_are_encoded_once(spark, data_dir, monkeypatch):
    """What is asked of a model just fitted reads the rows that were encoded for it."""
    monkeypatch.setattr(model_queries, "_teachers", {})
    monkeypatch.setattr(model_queries, "fit_teacher", lambda train, vocab: Detector(None, vocab))
    _, rows = model_queries.teacher(spark, data_dir)
    assert "ArrowEvalPython" not in rows._jdf.queryExecution().toString()
    assert rows.columns == ["doc_id", "split", "input_ids", "truncated", "label"]
