"""A corpus pipeline of five stages; each reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensitext.llm.common import ROW_KEY, by_key, keyed
from sensitext.llm.decontaminate import find_leaks
from sensitext.llm.ngram_join import row_components
from sensitext.llm.packing import pack
from sensitext.llm.pii import redacted
from sensitext.llm.quality_net import THRESHOLD, fit_quality, score_quality
from sensitext.session import scratch_path

# Training sequences of packed tokens cannot be stated in SQL.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    net = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_quality(docs.withColumn("_all", F.struct(*docs.columns)), net, "_all")
    return scored.where(F.col("score") >= THRESHOLD).select("_all.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows are compared and judged one by one, also those without an id or with that of another.
    """
    rows = keyed(docs)
    groups = row_components(by_key(rows), n=5, percent=80)
    heads = groups.where("component_id = doc_id").select(F.col("doc_id").alias(ROW_KEY))
    return rows.join(heads, ROW_KEY, "left_semi").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; rows with the id of one that has an item stay."""
    rows = keyed(docs)
    leaks = find_leaks(by_key(rows), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaking = leaks.select(F.col("doc_id").alias(ROW_KEY)).distinct()
    return rows.join(leaking, ROW_KEY, "left_anti").select(*docs.columns)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars`` follows the text."""
    clean = docs.withColumn("text", redacted("text"))
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in training sequences."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontaminated),
    ("pii", without_pii),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; every result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
