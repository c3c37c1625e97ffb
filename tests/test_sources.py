import json

import pytest
from pyspark.errors import PySparkException

from sensitext.constants import ID2LABEL, SPECIAL_TOKENS
from sensitext.operators.prep import coerce_label
from sensitext.sources.labelled import load_splits, read_labelled_csv, texts, write_splits
from sensitext.operators.encoding import encode
from sensitext.operators.train import fit_teacher
from sensitext.sources.settings import load_label_map, load_tokenizer_settings, load_vocab
from sensitext.sources.sinks import append_history, read_history, write_predictions
from sensitext.sources.tables import labelled_from_tables
from sensitext.session import checkpoint_root

CSV = (
    "text,label\n"
    "plain,0\n"
    '"say ""hi"", please",1\n'
    '"first line\nsecond line",1.0\n'
    '"",0\n'
    "NA,1\n"
    "last,\n"
)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "train.csv").write_text(CSV, encoding="utf-8")
    (tmp_path / "val.csv").write_text("label,text\n1,held out\n", encoding="utf-8")
    return tmp_path


def test_csv_quotes_lines_and_gaps(spark, folder):
    rows = read_labelled_csv(spark, str(folder / "train.csv")).collect()
    assert [(r.text, r.label) for r in rows] == [
        ("plain", "0"),
        ('say "hi", please', "1"),
        ("first line\nsecond line", "1.0"),
        (None, "0"),
        (None, "1"),
        ("last", None),
    ]


def test_csv_missing_values_can_be_chosen(spark, folder):
    rows = read_labelled_csv(spark, str(folder / "train.csv"), na_values=("",)).collect()
    assert rows[4].text == "NA"


def test_csv_missing_column_and_header_only(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("text,other\nx,1\n")
    with pytest.raises(ValueError, match="label"):
        read_labelled_csv(spark, str(bad))
    empty = tmp_path / "empty.csv"
    empty.write_text("text,label\n")
    assert read_labelled_csv(spark, str(empty)).count() == 0


def test_splits_come_from_two_files_by_column_name(spark, folder):
    rows = load_splits(spark, str(folder))
    assert rows.columns == ["split", "text", "label"]
    assert rows.where("split = 'train'").count() == 6
    held = coerce_label(rows.where("split = 'validation'")).first()
    assert (held.text, held.label) == ("held out", 1)


def test_written_splits_read_back_the_same(spark, folder, tmp_path):
    more = tmp_path / "all.csv"
    more.write_text(CSV + "".join(f'"copy, {i % 20}\nnext",{i % 2}\n' for i in range(60)))
    write_splits(spark, str(more), str(tmp_path / "out"))
    back = load_splits(spark, str(tmp_path / "out"))
    want = sorted(map(repr, (tuple(r) for r in read_labelled_csv(spark, str(more)).collect())))
    assert sorted(repr((r.text, r.label)) for r in back.collect()) == want
    assert back.select("text").distinct().count() == back.select("split", "text").distinct().count()
    assert {r.split for r in back.collect()} == {"train", "validation"}


def test_missing_split_file_is_an_error(spark, tmp_path):
    with pytest.raises(PySparkException):
        load_splits(spark, str(tmp_path))


def test_texts_keep_their_order(spark):
    rows = texts(spark, ["b", None, "a"]).orderBy("i").collect()
    assert [r.text for r in rows] == ["b", None, "a"]


def test_labelled_join_keeps_labelled_documents(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1), (3, 0)], "doc_id long, toxic int")
    assert [tuple(r) for r in labelled_from_tables(docs, labels).collect()] == [(2, "b", 1)]


def _config(path, **changes):
    added = {str(i): {"content": t, "special": True} for t, i in SPECIAL_TOKENS.items()}
    raw = {"added_tokens_decoder": added, "do_lower_case": False, "model_max_length": 512}
    path.write_text(json.dumps(raw | changes, indent=2), encoding="utf-8")
    return str(path)


def test_tokenizer_settings(spark, tmp_path):
    settings = load_tokenizer_settings(spark, _config(tmp_path / "tokenizer_config.json"))
    assert settings.special_tokens == SPECIAL_TOKENS
    assert settings.model_max_length == 512
    with pytest.raises(ValueError, match="cased"):
        load_tokenizer_settings(spark, _config(tmp_path / "lower.json", do_lower_case=True))


def test_vocab_file_uses_line_numbers(spark, tmp_path):
    path = tmp_path / "vocab.txt"
    path.write_text("[PAD]\nab\n##c\n", encoding="utf-8")
    assert {r.token: r.id for r in load_vocab(spark, str(path)).collect()} == {
        "[PAD]": 0, "ab": 1, "##c": 2,
    }
    with pytest.raises(ValueError, match="more than 2"):
        load_vocab(spark, str(path), max_size=2)


def test_vocab_of_several_files_is_an_error(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"part-{k}.txt").write_text(f"a{k}\n", encoding="utf-8")
    with pytest.raises(ValueError, match="more than one file"):
        load_vocab(spark, str(tmp_path))


def test_label_map(spark, tmp_path):
    assert load_label_map(spark) == ID2LABEL
    path = tmp_path / "config.json"
    path.write_text(json.dumps({"id2label": {"0": "no", "1": "yes"}}, indent=1))
    assert load_label_map(spark, str(path)) == {0: "no", 1: "yes"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("x", 0.5), (None, 1.0)], "text string, confidence double")
    write_predictions(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    write_predictions(df, str(tmp_path / "j"), "json")
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "j")).collect())
    assert json.loads(lines[1]) == {"text": None, "confidence": 1.0}
    with pytest.raises(PySparkException):
        write_predictions(df, str(tmp_path / "p"))
    with pytest.raises(ValueError):
        write_predictions(df, str(tmp_path / "q"), "xml")


def test_history_is_appended(spark, tmp_path):
    path = str(tmp_path / "h")
    append_history(spark, [("a", 1, 50, 0.7, 0.5, 0.8)], path)
    append_history(spark, [("a", 2, 100, 0.6, None, 0.9)], path)
    assert read_history(spark, path).orderBy("epoch").collect()[1].step == 100


def test_shared_folder_is_the_one_the_session_names(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_settings_take_effect(spark, tmp_path):
    settings = load_tokenizer_settings(spark, _config(tmp_path / "t.json", model_max_length=6))
    rows = spark.createDataFrame([("a b c d e f g h", 1), ("a", 0)] * 4, "text string, label int")
    vocab = {"[UNK]": 100, **{c: 200 + i for i, c in enumerate("abcdefgh")}}
    lengths = {len(r.input_ids) for r in encode(rows, vocab, settings=settings).collect()}
    assert lengths == {6, 3}
    assert {len(r.input_ids) for r in encode(rows, vocab, 4, settings=settings).collect()} == {4, 3}
    names = {0: "no", 1: "yes"}
    detector = fit_teacher(rows, vocab, max_iter=5, id2label=names, settings=settings)
    assert detector.max_length == 6
    assert {r.prediction for r in detector.classify(rows).collect()} <= {"no", "yes"}


def test_a_folder_of_settings_is_refused(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text("{}")
    with pytest.raises(ValueError, match="more than one file"):
        load_tokenizer_settings(spark, str(tmp_path / "*.json"))
