"""CSV read by blocks gives the rows of the reader that takes a file as a whole."""

import random

import pytest

from sensitext.sources.csv_blocks import csv_records, read_labelled_blocks
from sensitext.sources.labelled import read_labelled_csv

PIECES = ["a", "b,", '""', "\n", "\r\n", "é", "\n\n", " "]


@pytest.fixture
def blocks(spark):
    """A way to set the size of a block; set back at the end."""

    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield size
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")


def rows_of(frame):
    return sorted(repr((r.text, r.label)) for r in frame.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_are_those_of_whole_files(spark, blocks, tmp_path, end):
    rng = random.Random(7)
    for k in range(2):
        with open(tmp_path / f"part{k}.csv", "w", newline="", encoding="utf-8") as file:
            file.write(f"label,x,text{end}")
            for i in range(150):
                text = "".join(rng.choices(PIECES, k=rng.choice([0, 1, 5, 40, 200])))
                file.write(f'{i % 2},{i},"{text}"{end}' + end * (i % 50 == 0))
    for size in (150, 2000, 1 << 27):
        blocks(size)
        want = rows_of(read_labelled_csv(spark, str(tmp_path)))
        assert len(want) == 300
        assert rows_of(read_labelled_blocks(spark, str(tmp_path))) == want


def test_a_cell_may_span_many_blocks(spark, blocks, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text('text,label\n"' + "a line of text\n" * 500 + '",1\nNA,0\n"",\nlast,1')
    blocks(300)
    got = sorted(read_labelled_blocks(spark, str(path)).collect(), key=repr)
    assert [len(r.text or "") for r in got] == [7500, 4, 0, 0]
    assert rows_of(read_labelled_blocks(spark, str(path))) == rows_of(read_labelled_csv(spark, str(path)))
    kept = read_labelled_blocks(spark, str(path), na_values=("",)).where("text = 'NA'")
    assert kept.count() == 1


def test_one_file_is_read_by_many_tasks(spark, blocks, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text("text,label\n" + '"two\nlines",1\n' * 2000)
    blocks(1000)
    assert csv_records(spark, str(path)).select("block").distinct().count() > 20
    assert spark.read.option("multiLine", True).csv(str(path)).rdd.getNumPartitions() == 1


def test_order_of_records(spark, blocks, tmp_path):
    path = tmp_path / "order.csv"
    path.write_text("text,label\n" + "".join(f'"{i}\n{i}",0\n' for i in range(300)))
    blocks(101)
    rows = csv_records(spark, str(path)).orderBy("block", "record").collect()
    assert [r.raw for r in rows] == ["text,label", *(f'"{i}\n{i}",0' for i in range(300))]


def test_unpaired_quotes_and_missing_columns_stop(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text('text,label\n"never closed,1\n')
    # Both uses of the table of blocks may fail at once, which Spark reports as one error.
    with pytest.raises(Exception, match="unpaired quote|MULTIPLE_FAILURES"):
        read_labelled_blocks(spark, str(bad)).collect()
    other = tmp_path / "other.csv"
    other.write_text("text,other\nx,1\n")
    with pytest.raises(ValueError, match="label"):
        read_labelled_blocks(spark, str(other))
    empty = tmp_path / "empty.csv"
    empty.write_text("text,label\n")
    assert read_labelled_blocks(spark, str(empty)).count() == 0
