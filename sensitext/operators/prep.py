"""Checks, casts, splits and batches that come before encoding."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensitext.constants import ENCODE_BATCH, SEED

_SPLIT_RANGE = 4294967296.0
# Rows are numbered inside buckets; 65,536 of them keep a bucket small even for tens of
# billions of rows, and the table of bucket offsets stays below two megabytes.
_BUCKET_DIGITS = 4
# Fewer inside each length: a thousand lengths then make four million buckets at most.
_LENGTH_DIGITS = 3
_RANGE_BUCKETS = 1024
# Cuts that are compared one by one.
_RANGE_GROUP = 32


def check_columns(df: DataFrame, required: Sequence[str] = ("text", "label")) -> DataFrame:
    """The frame itself, or an error that names the missing columns."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def coerce_text(df: DataFrame, on_null: str = "nan", col: str = "text") -> DataFrame:
    """Text as string; a null becomes the word ``nan`` or, with ``error``, stops the job."""
    text = F.col(col).cast("string")
    if on_null == "nan":
        return df.withColumn(col, F.coalesce(text, F.lit("nan")))
    if on_null == "error":
        stop = F.raise_error(F.lit(f"null in column {col}")).cast("string")
        return df.withColumn(col, F.when(text.isNull(), stop).otherwise(text))
    raise ValueError(f"on_null must be 'nan' or 'error', not {on_null!r}")


def coerce_label(df: DataFrame, col: str = "label") -> DataFrame:
    """Label as integer, cut toward zero; a null or a non-number stops the job."""
    number = F.col(col).cast("double")
    bad = number.isNull() | F.isnan(number)
    stop = F.raise_error(F.lit(f"null or invalid number in column {col}")).cast("int")
    return df.withColumn(col, F.when(bad, stop).otherwise(number.cast("int")))


def hash_split(
    df: DataFrame,
    key: Column | str | None = None,
    train_fraction: float = 0.8,
    seed: int = SEED,
) -> DataFrame:
    """Add ``split`` by the hash of a key; by default of the text, so copies stay together.

    The split of a row depends on nothing but its key and the seed; a null key counts as an
    empty one.
    """
    if key is None:
        key = F.md5(F.col("text"))
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(_SPLIT_RANGE)
    return df.withColumn(
        "split",
        F.when(place < F.lit(float(train_fraction)), F.lit("train")).otherwise(
            F.lit("validation")
        ),
    )


def prune(df: DataFrame, drop: Iterable[str] = ("text", "label")) -> DataFrame:
    """Leave out raw columns once they are encoded; the scan then skips unused ones."""
    gone = set(drop)
    return df.select(*[c for c in df.columns if c not in gone])


def map_batches(
    df: DataFrame, fn: Callable, schema: str, batch_size: int = ENCODE_BATCH
) -> DataFrame:
    """Apply ``fn`` to pandas batches of at most ``batch_size`` rows inside each task."""

    def run(frames: Iterator) -> Iterator:
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                yield fn(frame.iloc[start : start + batch_size].reset_index(drop=True))

    return df.mapInPandas(run, schema)


def assign_batches(
    df: DataFrame,
    batch_size: int,
    id_col: str = "id",
    seed: int = SEED,
    epochs: int | Sequence[int] = 1,
    shuffle: bool = True,
    by: Sequence[str] = (),
    length: str | None = None,
) -> DataFrame:
    """Add ``epoch``, ``row_index`` and ``batch_id``; the last batch of an epoch may be short.

    Shuffled order is by ``md5(id:seed:epoch)``, otherwise by the id itself. ``id_col``
    must be unique. With ``by`` every group, such as a split, has batches of its own. With
    ``length``, a column of whole numbers, rows of like lengths share batches, which then need
    little padding: the order is by length, nulls first, and shuffled inside each length, so batches
    rise in length and a trainer should take them in another order than that of their numbers.
    Rows are
    numbered inside buckets that follow the order, and a small
    table of bucket sizes gives every bucket its start, so no task sees all rows.
    """
    epoch_list = [epochs] if isinstance(epochs, int) else list(epochs)
    rows = df.withColumn("epoch", F.explode(F.array(*[F.lit(int(e)) for e in epoch_list])))
    if length is not None and not shuffle:
        raise ValueError("batches by length are shuffled inside each length")
    if shuffle:
        name = F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed)), F.col("epoch"))
        rows = rows.withColumn("_order", F.md5(name))
        bucket = F.substring("_order", 1, _BUCKET_DIGITS)
        if length is not None:
            # The length comes first, so that the offsets of buckets put short rows first.
            bucket = F.struct(
                F.col(length).cast("bigint").alias("n"),
                F.substring("_order", 1, _LENGTH_DIGITS).alias("part"),
            )
    else:
        rows = rows.withColumn("_order", F.col(id_col))
        bucket = _range_bucket(F.col(id_col), _range_cuts(df, id_col))
    rows = rows.withColumn("_bucket", bucket)
    group = ["epoch"]
    if by:
        # One name per group, never null.
        rows = rows.withColumn("_group", F.to_json(F.struct(*by)))
        group.append("_group")

    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        rows.groupBy(*group, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
        )
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy("_order", id_col)
    numbered = rows.withColumn("_k", F.row_number().over(inside) - F.lit(1))
    # The numbered rows are partitioned and sorted by the join key already, so this join
    # moves the offsets only, at most 65,536 per epoch whatever the row count.
    joined = numbered.join(starts, [*group, "_bucket"])
    index = F.col("_start") + F.col("_k")
    return joined.select(
        *df.columns,
        "epoch",
        index.cast("bigint").alias("row_index"),
        F.floor(index / F.lit(batch_size)).cast("bigint").alias("batch_id"),
    )


def _range_cuts(df: DataFrame, id_col: str) -> list:
    """About a thousand ids that cut the id range into even parts, in rising order.

    The cuts only balance the work; the row numbers are exact for any cuts.
    """
    shares = [i / _RANGE_BUCKETS for i in range(1, _RANGE_BUCKETS)]
    row = df.agg(F.percentile_approx(id_col, shares).alias("cuts")).first()
    return sorted(set(row.cuts or []))


def _range_bucket(value: Column, cuts: list) -> Column:
    """How many of the rising ``cuts`` are at most ``value``; none are for a null.

    Halving finds the group of cuts that the value falls into, and only those of the group are
    compared one by one.
    """
    if not cuts:
        return F.lit(0)
    groups = [cuts[i : i + _RANGE_GROUP] for i in range(0, len(cuts), _RANGE_GROUP)]

    def group_of(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        below = value < F.lit(groups[middle + 1][0])
        return F.when(below, group_of(low, middle)).otherwise(group_of(middle + 1, high))

    group = group_of(0, len(groups) - 1)
    near = F.element_at(F.array(*[F.array(*map(F.lit, g)) for g in groups]), group + F.lit(1))
    found = group * F.lit(_RANGE_GROUP) + F.size(F.filter(near, lambda c: c <= value))
    return F.when(value.isNull(), F.lit(0)).otherwise(found)
