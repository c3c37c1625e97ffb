"""Model folders: fitted stages, vocabulary and settings kept together."""

from __future__ import annotations

import json
import os

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from sensitext.operators.distill import LinearStudent
from sensitext.operators.encoding import vocab_dict
from sensitext.operators.train import Detector


def save_model(detector: Detector, path: str) -> None:
    """Write a detector; what an earlier one left in the folder is replaced."""
    spark = SparkSession.active()
    is_student = isinstance(detector.model, LinearStudent)
    if is_student:
        detector.model.save(spark, os.path.join(path, "student"))
    else:
        detector.model.write().overwrite().save(os.path.join(path, "stages"))
    spark.createDataFrame(list(detector.vocab.items()), "token string, id int").write.mode(
        "overwrite"
    ).parquet(os.path.join(path, "vocab"))
    settings = {
        "kind": "student" if is_student else "stages",
        "max_length": detector.max_length,
        "id2label": {str(i): name for i, name in detector.id2label.items()},
    }
    spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(os.path.join(path, "settings"))


def load_model(path: str) -> Detector:
    """Read a detector; a folder without one is an error that says what is missing."""
    spark = SparkSession.active()
    try:
        settings = json.loads(spark.read.text(os.path.join(path, "settings")).first().value)
        vocab = vocab_dict(spark.read.parquet(os.path.join(path, "vocab")))
    except AnalysisException as error:
        raise FileNotFoundError(f"{path} is no model folder: {error.getMessage()}") from error
    if settings["kind"] == "student":
        model = LinearStudent.load(spark, os.path.join(path, "student"))
    else:
        model = PipelineModel.load(os.path.join(path, "stages"))
    return Detector(
        model,
        vocab,
        settings["max_length"],
        {int(i): name for i, name in settings["id2label"].items()},
    )
