"""Quoted CSV read by many tasks, though a cell may span lines and blocks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sensitext.constants import PANDAS_NA
from sensitext.operators.prep import check_columns

_CSV = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files as text: ``file, block, record, raw``; empty lines are none.

    A line end separates records where the quotes before it in its file are even. Spark deals
    a file out in blocks of lines; each task counts quotes without knowing how its block began,
    and a table of one row per block (its parity, and whether a record starts in it for
    either beginning) then fixes the beginning of every block. Lines that go on a record of an
    earlier block join that block's last record. ``block`` and ``record`` give the order.

    Where the first line of a file ends with ``\\r\\n``, that is its line end and read as ``\\n``.

    Quotes must be paired, as RFC 4180 asks; a file that ends inside a quoted cell stops the job.
    A window holds one block (``spark.sql.files.maxPartitionBytes``), a record must fit a task.
    """
    n_quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    # The ids order the lines of a block; blocks are ordered by their place in the file.
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
            F.col("value").alias("line"),
        )
        .withColumns({"quotes": n_quotes, "cr": F.endswith("line", F.lit("\r"))})
    )
    in_block = Window.partitionBy("file", "block").orderBy("place")
    up_to_here = in_block.rowsBetween(Window.unboundedPreceding, 0)
    odd = (F.sum("quotes").over(up_to_here) - F.col("quotes")) % 2
    counted = lines.withColumn("odd", odd.cast("int"))

    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    blocks = counted.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"),
        F.bool_or(F.col("odd") == 1).alias("has_odd"),
        F.min_by("cr", "place").alias("cr"),
    )
    begun = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int")
    unpaired = F.sum("quotes").over(Window.partitionBy("file")) % 2 == 1
    stop = F.raise_error(F.concat(F.lit("unpaired quote in "), F.col("file"))).cast("int")
    # The first line of a block starts a record unless the block begins inside a cell.
    starts = (F.col("begun") == 0) | F.col("has_odd")
    blocks = (
        blocks.select(
            "file",
            "block",
            "has_odd",
            F.first("cr").over(in_file).alias("crlf"),
            F.when(unpaired, stop).otherwise(begun).alias("begun"),
        )
        .withColumn("starts", starts)
        .withColumn("owner", F.last(F.when(F.col("starts"), F.col("block")), True).over(before))
        .select("file", "block", "crlf", "begun", "owner")
    )
    # Even quotes before a line: it starts a record. A block's lines before that have number 0.
    is_start = (F.col("odd") == F.col("begun")).cast("int")
    numbered = counted.join(blocks, ["file", "block"]).withColumn(
        "record", F.sum(is_start).over(up_to_here)
    )
    pieces = numbered.groupBy("file", "block", "crlf", "owner", "record").agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]
            ),
            "\n",
        ).alias("piece")
    )
    # Only the first and last piece of a block can meet others, but which one is last is not
    # known before all are read, so an open one is told by its quotes.
    piece_quotes = F.length("piece") - F.length(F.replace("piece", F.lit('"'), F.lit("")))
    is_open = (F.col("record") == 0) | (piece_quotes % 2 == 1)
    # At most one piece of a block stays open at its end, so the owner alone names its record.
    names = ("file", "crlf", "block", "record")
    whole = pieces.where(~is_open).select(*names, F.col("piece").alias("raw"))
    joined = (
        pieces.where(is_open)
        .select(
            "file",
            "crlf",
            F.when(F.col("record") == 0, F.col("owner")).otherwise(F.col("block")).alias("home"),
            F.col("block").alias("at"),
            F.col("record"),
            "piece",
        )
        .groupBy("file", "crlf", F.col("home").alias("block"))
        .agg(
            F.max("record").alias("record"),
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]),
                "\n",
            ).alias("raw"),
        )
        .select(*names, "raw")
    )
    plain = F.regexp_replace("raw", r"\r(\n|\z)", "$1")
    return (
        whole.unionByName(joined)
        .select("file", "block", "record", F.when(F.col("crlf"), plain).otherwise(F.col("raw")).alias("raw"))
        .where("raw != ''")
    )


def read_labelled_blocks(
    spark: SparkSession, path: str, na_values: Iterable[str] = PANDAS_NA
) -> DataFrame:
    """``text`` and ``label`` of header CSV files, large ones read by many tasks.

    The rows are those of :func:`sensitext.sources.labelled.read_labelled_csv`, in no order;
    it suits many small files, this one a few large ones.
    """
    reader = spark.read.option("header", True).option("inferSchema", False)
    header = check_columns(reader.options(**_CSV).csv(path)).columns
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in header)
    # The header is the first record of a file; its columns have the order of the first file's.
    body = csv_records(spark, path).where("NOT (block = 0 AND record = 1)")
    cells = body.select(F.from_csv("raw", schema, _CSV).alias("row"))
    missing = list(na_values)
    return cells.select(
        *[
            F.when(~F.col(f"row.{c}").isin(missing), F.col(f"row.{c}")).alias(c)
            for c in ("text", "label")
        ]
    )
