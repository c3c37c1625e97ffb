"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensitext.llm.common import documents
from sensitext.llm.decontaminate import find_leaks
from sensitext.llm.licences import licence_scan
from sensitext.llm.ngram_join import ngram_components
from sensitext.llm.main_text import main_text
from sensitext.llm.packing import pack
from sensitext.llm.pii import pii_report
from sensitext.llm.quality_net import THRESHOLD, fit_quality, held_out, score_quality
from sensitext.llm.quality_rules import quality_rules
from sensitext.llm.repeats import remove_repeats
from sensitext.llm.sharding import write_shards
from sensitext.llm.spelling import spelling_variants
from sensitext.llm.sql import ORACLE
from sensitext.llm.training_order import read_order, write_training_order
from sensitext.llm.vector_codes import vector_codes
from sensitext.session import scratch_path


def op1_quality_rules(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir))


def op2_ngram_jaccard(spark, sf_dir):
    return ngram_components(documents(spark, sf_dir), n=4, percent=85)


def op3_pii(spark, sf_dir):
    return pii_report(documents(spark, sf_dir))


def op4_decontaminate(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_leaks(documents(spark, sf_dir), benchmark)


def op5_training_order(spark, sf_dir):
    folder = scratch_path(spark, "training-order")
    write_training_order(documents(spark, sf_dir), folder)
    return read_order(spark, folder).drop("ids")


def op6_suffix_dedup(spark, sf_dir):
    return remove_repeats(documents(spark, sf_dir))


def op7_best_fit_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir))


def op8_licences(spark, sf_dir):
    return licence_scan(documents(spark, sf_dir))


def op9_quality_net(spark, sf_dir):
    docs = documents(spark, sf_dir)
    net = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, net, "doc_id").select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op10_sharding(spark, sf_dir):
    folder = scratch_path(spark, "shards")
    written = write_shards(documents(spark, sf_dir), folder)
    return written.select("doc_id", "bytes", "shard", "page")


def op11_spelling_variants(spark, sf_dir):
    return spelling_variants(documents(spark, sf_dir))


def op12_vector_codes(spark, sf_dir):
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_main_text(spark, sf_dir):
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_ngram_jaccard,
        op3_pii,
        op4_decontaminate,
        op5_training_order,
        op6_suffix_dedup,
        op7_best_fit_packing,
        op8_licences,
        op9_quality_net,
        op10_sharding,
        op11_spelling_variants,
        op12_vector_codes,
        op13_main_text,
    )
}
__all__ = ["ORACLE", "QUERIES"]
