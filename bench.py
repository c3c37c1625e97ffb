"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_RUNS how often a
query runs after its warm-up; the median counts. Queries that train a model run once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sensitext.operators.distill import fit_student, soft_labels  # noqa: E402
from sensitext.operators.encoding import encode  # noqa: E402
from sensitext.operators.predict import predict, score_distinct  # noqa: E402
from sensitext.operators.train import evaluate  # noqa: E402
from sensitext.plans.inputs import documents  # noqa: E402
from sensitext.plans.model_queries import student, teacher  # noqa: E402
from sensitext.plans.registry import QUERIES  # noqa: E402
from sensitext.session import build_session  # noqa: E402

HEADLINE = [
    "labelled_join",
    "hash_split",
    "assign_batches",
    "label_distribution",
    "basic_tokens",
    "build_vocab",
    "wordpiece",
    "encode",
    "length_profile",
    "predict",
    "score_distinct",
    "compute_metrics",
    "best_by_loss",
    "kd_loss",
    "hidden_loss",
    "kd_gradient",
    "quantize_int8",
    "parity_report",
    "stream_score",
]
TRAINED = ["teacher_predict", "student_predict"]
EPOCHS = 5


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median_of(action, runs: int) -> float:
    timed(action)
    return statistics.median(timed(action) for _ in range(runs))


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    partitions = None if cpus == "*" else int(cpus)
    spark = build_session(f"local[{cpus}]", "sensitext-bench", partitions)
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {
        name: median_of(lambda: run(QUERIES[name](spark, data_dir)), runs) for name in HEADLINE
    }
    seconds |= {name: timed(lambda: run(QUERIES[name](spark, data_dir))) for name in TRAINED}

    # The models of the queries, so that their quality is that of the queries' rows.
    docs = documents(spark, data_dir)
    n = docs.count()
    detector, rows = teacher(spark, data_dir)
    vocab = detector.vocab
    soft = soft_labels(rows.select("doc_id", "label", "split", "input_ids"), detector.score_encoded)
    epoch = timed(lambda: fit_student(soft, epochs=EPOCHS)) / EPOCHS
    small, _, _ = student(spark, data_dir)
    held_out = rows.where(F.col("split") == "validation")
    quality, small_quality = (evaluate(m, held_out).first().asDict() for m in (detector, small))
    rates = {
        "encode": n / median_of(lambda: run(encode(docs, vocab)), runs),
        "predict": n / median_of(lambda: run(predict(docs, detector, ("doc_id",))), runs),
        "score_distinct": n
        / median_of(lambda: run(score_distinct(docs, detector, keep=("doc_id",))), runs),
    }

    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": os.path.basename(os.path.normpath(data_dir)).removeprefix("sf"),
                "cpus": cpus,
                "texts_per_sec": {k: round(v, 1) for k, v in rates.items()},
                "seconds_per_student_epoch": round(epoch, 3),
                "teacher_validation": quality,
                "student_validation": small_quality,
            },
            ensure_ascii=False,
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
