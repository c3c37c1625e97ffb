"""Parquet tables as inputs."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_table(
    spark: SparkSession,
    data_dir: str,
    name: str,
    *columns: str | Column,
    schema: str | None = None,
    spread: bool = False,
) -> DataFrame:
    """One Parquet table, narrowed to ``columns``; a given ``schema`` spares reading footers.

    ``spread`` is for text-heavy work: a table stored as so few splits that half of the
    cores would idle is dealt out evenly first. Any other table is left as it is.
    """
    path = os.path.join(data_dir, f"{name}.parquet")
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if columns:
        df = df.select(*columns)
    cores = spark.sparkContext.defaultParallelism
    if spread and 2 * df.rdd.getNumPartitions() <= cores:
        df = df.repartition(cores)
    return df


def labelled_from_tables(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", key: str = "doc_id"
) -> DataFrame:
    """Join any text table with a label table; every other column of ``docs`` is kept.

    No broadcast hint: labels grow with the texts, so the choice is left to the measured
    sizes at run time. ``docs`` may be encoded already, which makes the joined rows narrow.
    """
    narrow = labels.select(key, F.col(label_col).cast("int").alias("label"))
    return docs.join(narrow, key, "inner")
