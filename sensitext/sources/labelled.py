"""Labelled CSV files and literal texts."""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensitext.constants import PANDAS_NA, SEED
from sensitext.operators.prep import check_columns, hash_split


def read_labelled_csv(
    spark: SparkSession, path: str, na_values: Iterable[str] = PANDAS_NA
) -> DataFrame:
    """A header CSV with ``text`` and ``label``; cells in ``na_values`` become null.

    Both columns are read as strings, so that a label such as ``1.0`` survives for
    :func:`sensitext.operators.prep.coerce_label`. Quoted cells may hold line ends and
    doubled quotes. Columns are found by name, in any order. Since a cell may span lines, a
    file is read by one task: keep a large data set as a folder of many files.
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
    )
    df = check_columns(reader.csv(path))
    missing = list(na_values)
    return df.select(
        *[F.when(~F.col(c).isin(missing), F.col(c)).alias(c) for c in ("text", "label")]
    )


def load_splits(
    spark: SparkSession, data_dir: str, na_values: Iterable[str] = PANDAS_NA
) -> DataFrame:
    """``train.csv`` and ``val.csv`` of a folder as one frame ``split, text, label``."""
    parts = []
    for split, file in (("train", "train.csv"), ("validation", "val.csv")):
        part = read_labelled_csv(spark, os.path.join(data_dir, file), na_values)
        parts.append(part.select(F.lit(split).alias("split"), "text", "label"))
    return parts[0].unionByName(parts[1])


def write_splits(
    spark: SparkSession,
    input_path: str,
    output_dir: str,
    train_fraction: float = 0.8,
    seed: int = SEED,
) -> None:
    """Split one labelled CSV by the hash of its texts and write ``train.csv`` and ``val.csv``.

    Both are folders of part files that :func:`load_splits` reads.
    """
    rows = hash_split(read_labelled_csv(spark, input_path), None, train_fraction, seed)
    for split, file in (("train", "train.csv"), ("validation", "val.csv")):
        part = rows.where(F.col("split") == split).select("text", "label")
        # White space at either end belongs to the text.
        writer = part.write.option("header", True).option("escape", '"')
        for side in ("Leading", "Trailing"):
            writer = writer.option(f"ignore{side}WhiteSpace", False)
        writer.csv(os.path.join(output_dir, file))


def texts(spark: SparkSession, values: Sequence[str | None]) -> DataFrame:
    """A literal list of texts, with its order in ``i``."""
    return spark.createDataFrame(list(enumerate(values)), "i int, text string")
