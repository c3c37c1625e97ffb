import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sensitext.operators.prep import (
    _range_bucket,
    assign_batches,
    check_columns,
    coerce_label,
    coerce_text,
    hash_split,
    map_batches,
    prune,
)
from sensitext.operators.profile import column_report, label_distribution, split_sizes


def test_check_columns_names_what_is_missing(spark):
    df = spark.range(1).withColumn("text", F.lit("x"))
    with pytest.raises(ValueError, match="label"):
        check_columns(df)
    assert check_columns(df, ["text"]) is df


def test_null_text_becomes_nan_or_stops(spark):
    df = spark.createDataFrame([("a",), (None,)], "text string")
    assert [r.text for r in coerce_text(df).collect()] == ["a", "nan"]
    with pytest.raises(PySparkException, match="null in column text"):
        coerce_text(df, "error").collect()
    with pytest.raises(ValueError):
        coerce_text(df, "skip")


@pytest.mark.parametrize("written, number", [("1", 1), ("1.0", 1), ("-1.9", -1), ("0.7", 0)])
def test_label_is_cut_toward_zero(spark, written, number):
    df = spark.createDataFrame([(written,)], "label string")
    assert coerce_label(df).first().label == number


@pytest.mark.parametrize("written", [None, "yes", "nan"])
def test_bad_label_stops(spark, written):
    df = spark.createDataFrame([(written,)], "label string")
    with pytest.raises(PySparkException):
        coerce_label(df).collect()


def test_copies_stay_in_one_split(spark):
    df = spark.range(4000).select((F.col("id") % 1000).cast("string").alias("text"))
    split = hash_split(df)
    assert split.groupBy("text").agg(F.countDistinct("split").alias("k")).where("k > 1").count() == 0
    share = split.where("split = 'train'").count() / 4000
    assert 0.75 < share < 0.85
    other = hash_split(df, seed=7).where("split = 'train'").count() / 4000
    assert other != share


@pytest.mark.parametrize("shuffle", [True, False])
@pytest.mark.parametrize("partitions", [1, 7])
def test_batches_do_not_depend_on_partitions(spark, shuffle, partitions):
    df = spark.range(100).select((F.col("id") * 3).alias("id")).repartition(partitions)
    rows = assign_batches(df, 32, epochs=[1, 2], shuffle=shuffle).collect()
    for epoch in (1, 2):
        mine = sorted((r.row_index, r.id, r.batch_id) for r in rows if r.epoch == epoch)
        assert [m[0] for m in mine] == list(range(100))
        assert [m[2] for m in mine] == [i // 32 for i in range(100)]
        if not shuffle:
            assert [m[1] for m in mine] == [3 * i for i in range(100)]
    if shuffle:
        orders = [[r.id for r in sorted(rows, key=lambda r: r.row_index) if r.epoch == e]
                  for e in (1, 2)]
        assert orders[0] != orders[1]


def test_no_rows_give_no_batches(spark):
    empty = spark.range(0)
    assert assign_batches(empty, 32).count() == 0
    assert assign_batches(empty, 32, shuffle=False).count() == 0


def test_map_batches_bounds_the_batch(spark):
    def size_of(frame):
        return frame.assign(n=len(frame))

    rows = map_batches(spark.range(0, 2500, 1, 1), size_of, "id bigint, n bigint", 1000).collect()
    assert sorted({r.n for r in rows}) == [500, 1000]
    assert len(rows) == 2500


def test_profile(spark):
    df = spark.createDataFrame(
        [("train", "a", 0), ("train", "b", 1), ("train", "c", 1), ("validation", "d", None)],
        "split string, text string, label int",
    )
    assert {r.split: r.n_rows for r in split_sizes(df).collect()} == {"train": 3, "validation": 1}
    rows = [tuple(r) for r in label_distribution(df).collect()]
    assert rows == [("train", 0, 1, 1 / 3), ("train", 1, 2, 2 / 3)]
    report = {(r.split, r.position): (r.name, r.type) for r in column_report(df).collect()}
    assert report[("validation", 1)] == ("label", "int")
    assert prune(df).columns == ["split"]


def test_batches_of_groups_are_their_own(spark):
    df = spark.range(100).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 3 = 1 THEN 'b' END AS kind")
    rows = assign_batches(df, 8, epochs=[1, 2], by=["kind"]).collect()
    assert len(rows) == 200
    for kind, n in (("a", 34), ("b", 33), (None, 33)):
        for epoch in (1, 2):
            own = [r for r in rows if r.kind == kind and r.epoch == epoch]
            assert sorted(r.row_index for r in own) == list(range(n))
            assert all(r.batch_id == r.row_index // 8 for r in own)


def test_rows_of_like_lengths_share_batches(spark):
    df = spark.range(300).selectExpr("id", "CASE WHEN id % 7 > 0 THEN id % 7 END AS n", "id % 2 AS kind")
    rows = assign_batches(df, 16, epochs=[1, 2], by=["kind"], length="n").collect()
    assert len(rows) == 600
    orders = []
    for kind in (0, 1):
        for epoch in (1, 2):
            own = sorted((r for r in rows if (r.kind, r.epoch) == (kind, epoch)), key=lambda r: r.row_index)
            assert [r.row_index for r in own] == list(range(150))
            assert all(r.batch_id == r.row_index // 16 for r in own)
            assert [r.n or 0 for r in own] == sorted(r.n or 0 for r in own)
            orders.append([r.id for r in own])
    assert orders[0] != orders[1] and orders[0] != sorted(orders[0], key=lambda i: (i % 7, i))
    assert assign_batches(df.limit(0), 16, length="n").count() == 0
    with pytest.raises(ValueError, match="shuffled"):
        assign_batches(df, 16, shuffle=False, length="n")


@pytest.mark.parametrize("n_cuts", [0, 1, 31, 32, 33, 64, 500, 1023])
def test_range_buckets_count_the_cuts(spark, n_cuts):
    cuts = [7 * i for i in range(n_cuts)]
    ids = spark.range(-20, 7 * n_cuts + 20).union(spark.sql("SELECT CAST(NULL AS bigint)"))
    for r in ids.select("id", _range_bucket(F.col("id"), cuts).alias("b")).collect():
        assert r.b == (0 if r.id is None else sum(c <= r.id for c in cuts))


def test_ordered_batches_of_doubles_and_dates(spark):
    df = spark.range(500).select(
        (F.col("id") * -0.5).alias("x"), F.date_add(F.lit("2020-01-01").cast("date"), -F.col("id").cast("int")).alias("d")
    )
    for key in ("x", "d"):
        rows = assign_batches(df, 64, key, shuffle=False).orderBy("row_index").collect()
        assert [r.row_index for r in rows] == list(range(500))
        assert [r[key] for r in rows] == sorted(r[key] for r in rows)
