"""The teacher: a supervised classifier over encoded token ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, HashingTF, IDF, NGram, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensitext.constants import ID2LABEL, MAX_LENGTH, TEACHER_WEIGHT_DECAY, VOCAB_SIZE
from sensitext.functions.losses import ce_loss
from sensitext.functions.scoring import argmax
from sensitext.operators.distill import LinearStudent
from sensitext.operators.encoding import build_vocab, encode, vocab_dict
from sensitext.operators.grams import gram_dictionary
from sensitext.operators.metrics import metric_columns
from sensitext.operators.predict import detect, predict
from sensitext.session import stored_once
from sensitext.sources.labelled import texts
from sensitext.sources.settings import TokenizerSettings

_STAGE_COLUMNS = ("_tokens", "_bigrams", "_grams", "_seen", "features", "probability", "prediction")


@dataclass
class Detector:
    """A fitted model with the vocabulary and settings it was trained with."""

    model: PipelineModel | LinearStudent
    vocab: dict[str, int]
    max_length: int = MAX_LENGTH
    id2label: dict[int, str] = field(default_factory=lambda: dict(ID2LABEL))

    def encode(self, df: DataFrame) -> DataFrame:
        """Model inputs of ``text``; rows that have ``input_ids`` are encoded already."""
        if "input_ids" in df.columns:
            return df
        return encode(df, self.vocab, self.max_length, keep_raw=True)

    def score_encoded(self, encoded: DataFrame) -> DataFrame:
        """Add ``logits`` to rows that have ``input_ids``."""
        if isinstance(self.model, LinearStudent):
            return self.model.score_encoded(encoded)
        raw = self.model.transform(encoded)
        return raw.withColumn("logits", vector_to_array("rawPrediction")).drop(
            "rawPrediction", *_STAGE_COLUMNS
        )

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``logits`` to rows that have ``text`` or ``input_ids``."""
        rows = df if "label" not in df.columns else df.withColumnRenamed("label", "_label")
        scored = self.score_encoded(self.encode(rows)).select(*rows.columns, "logits")
        return scored.withColumnRenamed("_label", "label")

    def predict(self, text: str) -> dict:
        """One text: ``label``, ``confidence`` and ``is_sensitive``."""
        return self.batch_predict([text])[0]

    def batch_predict(self, values: Sequence[str]) -> list[dict]:
        """A short list of texts, answered in its order; tables go through ``detect``."""
        frame = detect(texts(SparkSession.active(), values), self, keep=("i",))
        return [
            {"label": r.label, "confidence": r.confidence, "is_sensitive": r.is_sensitive}
            for r in frame.orderBy("i").collect()
        ]

    def classify(self, df: DataFrame) -> DataFrame:
        """Prediction records for a table of texts."""
        return predict(df, self)


def fit_teacher(
    train: DataFrame,
    vocab: DataFrame | dict[str, int] | None = None,
    max_length: int = MAX_LENGTH,
    weight_decay: float = TEACHER_WEIGHT_DECAY,
    max_iter: int = 30,
    n_features: int = 1 << 16,
    bigrams: bool = False,
    vocab_size: int = VOCAB_SIZE,
    balanced: bool = True,
    sparsity: float = 0.9,
    min_rows: int = 3,
    dictionary: bool = False,
    id2label: Mapping[int, str] = ID2LABEL,
    settings: TokenizerSettings | None = None,
) -> Detector:
    """Fit a detector on rows of ``label`` and ``text``, or ``input_ids`` made with ``vocab``.

    L-BFGS takes the place of small-batch steps: each iteration is one pass over the
    executors with a tree-shaped sum of gradients, so there is no learning rate and no
    warm-up; ``weight_decay`` is the penalty and ``sparsity`` the share of it that is L1, which
    sets the weights of most ids to zero. Features are the token ids a text holds
    and, on request, their bigrams, weighted by IDF; those in fewer than ``min_rows`` rows count
    nothing. They are hashed into ``n_features`` places; with ``dictionary`` the most frequent
    ``n_features`` of them have a place each and the others none, so that no two share a weight.
    With ``balanced`` both classes weigh the
    same in the loss, whatever their number of rows. The detector names its classes by
    ``id2label`` and, with ``settings``, reads no more ids than their ``model_max_length``.
    """
    max_length = settings.longest(max_length) if settings else max_length
    is_encoded = "input_ids" in train.columns
    if is_encoded and vocab is None:
        raise ValueError("encoded rows need the vocabulary they were made with")
    ids = vocab_dict(build_vocab(train, vocab_size) if vocab is None else vocab)
    if is_encoded:
        encoded = train.select("input_ids", F.col("label").alias("labels"))
    else:
        encoded = encode(train.select("text", "label"), ids, max_length)
    as_tokens = "transform(input_ids, x -> cast(x AS string)) AS _tokens"
    # Read once per iteration, so written once as narrow id arrays.
    with stored_once(encoded.select("input_ids", "labels"), "teacher-input") as stored:
        if dictionary:
            known = gram_dictionary(
                stored.selectExpr(as_tokens), "_tokens", 2 if bigrams else 1, min_rows, n_features
            )
            if not known:
                raise ValueError(f"no feature stands in {min_rows} rows")
            counts = CountVectorizerModel.from_vocabulary(known, "_grams", "_seen", binary=True)
        else:
            counts = HashingTF(
                numFeatures=n_features, binary=True, inputCol="_grams", outputCol="_seen"
            )
        grams = "concat(_tokens, _bigrams)" if bigrams else "_tokens"
        stages = [
            SQLTransformer(statement=f"SELECT *, {as_tokens} FROM __THIS__"),
            *([NGram(n=2, inputCol="_tokens", outputCol="_bigrams")] if bigrams else []),
            SQLTransformer(statement=f"SELECT *, {grams} AS _grams FROM __THIS__"),
            counts,
            IDF(minDocFreq=min_rows, inputCol="_seen", outputCol="features"),
            LogisticRegression(
                featuresCol="features",
                labelCol="labels",
                regParam=weight_decay,
                elasticNetParam=sparsity,
                maxIter=max_iter,
                standardization=False,
                **({"weightCol": "_weight"} if balanced else {}),
            ),
        ]
        if balanced:
            stored = weighted(stored)
        return Detector(Pipeline(stages=stages).fit(stored), ids, max_length, dict(id2label))


def weighted(rows: DataFrame) -> DataFrame:
    """Add ``_weight``, by which the classes that occur have equal sums."""
    counts = {r.labels: r.n for r in rows.groupBy("labels").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    weight = F.lit(1.0)
    for label, n in counts.items():
        weight = F.when(F.col("labels") == label, total / (len(counts) * n)).otherwise(weight)
    return rows.withColumn("_weight", weight)


def evaluate(model: Detector, df: DataFrame, by: str | None = "split") -> DataFrame:
    """The four metrics and the mean cross-entropy per split, in one pass."""
    scored = model.score(df).withColumn("pred", argmax("logits"))
    loss = F.avg(ce_loss("logits", "label")).alias("eval_loss")
    return scored.groupBy(*([by] if by else [])).agg(*metric_columns(), loss)
