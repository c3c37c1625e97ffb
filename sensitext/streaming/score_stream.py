"""Scoring of a text stream with the same stages as a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sensitext.constants import THRESHOLD
from sensitext.operators.predict import detect


def read_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New Parquet files of a folder as a stream with a fixed schema.

    A glob is taken too; a table that may be one file or a folder is best named by one.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def score_stream(
    stream: DataFrame,
    model,
    sink: str,
    checkpoint: str,
    keep: Sequence[str] = (),
    threshold: float = THRESHOLD,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score each arriving row and append ``keep, label, confidence, is_sensitive`` to ``sink``.

    The work keeps no state. The file sink and its checkpoint make each row arrive once,
    also after a restart; by default the query stops when all present input is done.
    """
    scored = detect(stream, model, keep, threshold)
    return (
        scored.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
