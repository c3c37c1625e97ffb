"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def build_session(
    master: str | None = None,
    app_name: str = "sensitext",
    shuffle_partitions: int | None = None,
    driver_memory: str = "8g",
    checkpoint_dir: str | None = None,
) -> SparkSession:
    """Session with the settings every operator here assumes.

    On a cluster leave ``master`` and ``shuffle_partitions`` to spark-submit; adaptive
    execution then coalesces small shuffle partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
    )
    if master is not None:
        builder = (
            builder.master(master)
            .config("spark.driver.memory", driver_memory)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint_dir is not None:
        builder = builder.config(CHECKPOINT_KEY, checkpoint_dir)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates, as the session names it.

    Only a local session without the setting gets a temporary folder of its own; a
    cluster session without it is an error, since executors must all see the folder.
    """
    root = spark.sparkContext.getConf().get(CHECKPOINT_KEY) or spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="sensitext-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return os.path.join(checkpoint_root(spark), "sensitext", f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back, which cuts the lineage.

    Used where a costly column is read many times; losing an executor then costs a
    re-read and no recomputation. The written table stays until its owner removes it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored_once(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like :func:`materialise` for the time of a block; the table is removed at its end."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
