"""Writers for predictions and training history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

HISTORY_SCHEMA = (
    "run string, epoch int, step int, train_loss double, eval_loss double, val_acc double"
)


def write_predictions(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists"
) -> None:
    """Prediction records as Parquet, or as one JSON document per line."""
    if fmt == "parquet":
        df.write.mode(mode).parquet(path)
    elif fmt == "json":
        record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        df.select(record.alias("value")).write.mode(mode).text(path)
    else:
        raise ValueError(f"unknown format {fmt!r}: use 'parquet' or 'json'")


def append_history(spark: SparkSession, rows: list[tuple] | DataFrame, path: str) -> None:
    """Add training records to a history table."""
    df = rows if isinstance(rows, DataFrame) else spark.createDataFrame(rows, HISTORY_SCHEMA)
    df.select("run", "epoch", "step", "train_loss", "eval_loss", "val_acc").write.mode(
        "append"
    ).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY_SCHEMA).parquet(path)
