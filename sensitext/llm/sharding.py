"""Sharding by extendible hashing, with DataFrame operations only.

A document's key is the bit string of its id's digest. Shards are prefixes of it: all
documents start in one bucket, and only buckets over the byte limit split on another
bit. Sizes are summed once at a depth where buckets are expected to be small, and added up
to get those of the shorter prefixes; only documents in buckets that are still too
large go on to deeper bits. Where digests run out (rows with equal ids) or one document
alone is too large, the bucket becomes a chain of overflow pages, filled in order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensitext.session import materialise

BITS = 60
LIMIT_BYTES = 8 << 20
SPARE_BITS = 3
ROW_BYTES = 64  # ids and other short columns
# Chains: characters of a text that deal it out, and parts of the rows with one text.
START_CHARS = 16
SALTS = 256


def key_bits(id_col: str = "doc_id") -> Column:
    """First ``BITS`` bits of the id's MD5 digest, as text; a null id counts as empty."""
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.lpad(F.conv(F.substring(digest, 1, BITS // 4), 16, 2), BITS, "0")


def _leaves(cells: DataFrame, limit: int, least: int, depth: int) -> DataFrame:
    """For prefixes of ``depth`` bits: the shortest prefix from ``least`` on that fits, or null."""
    depths = F.explode(F.sequence(F.lit(least), F.lit(depth)))
    levels = cells.select("cell", "size", depths.alias("d")).withColumn(
        "prefix", F.substring("cell", F.lit(1), F.col("d"))
    )
    sizes = levels.groupBy("prefix").agg(F.sum("size").alias("size"))
    fit = sizes.where(F.col("size") <= limit).select("prefix")
    return (
        levels.join(fit, "prefix")
        .groupBy("cell")
        .agg(F.min_by("prefix", "d").alias("leaf"))
    )


def directory(docs: DataFrame, limit: int = LIMIT_BYTES) -> list[tuple[int, DataFrame]]:
    """``(depth, cells)`` of each round: prefixes of ``depth`` bits and the bucket they lie in."""
    rows = materialise(docs.select(row_bytes().alias("bytes"), key_bits().alias("bits")), "shard-rows")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, SPARE_BITS + max(0, math.ceil(math.log2(max(1, total / limit)))))
    least, left, rounds = 0, rows, []
    while True:
        cells = left.groupBy(F.substring("bits", 1, depth).alias("cell")).agg(
            F.sum("bytes").alias("size")
        )
        cells = materialise(cells, "shard-cells")
        leaves = materialise(_leaves(cells, limit, least, depth), "shard-leaves")
        rounds.append((depth, leaves))
        open_cells = cells.join(leaves, "cell", "left_anti").select("cell")
        if depth == BITS or not open_cells.limit(1).count():
            return rounds
        left = left.join(open_cells, F.substring("bits", 1, depth) == F.col("cell"), "left_semi")
        least, depth = depth + 1, min(BITS, depth + 2 * SPARE_BITS)


def row_bytes() -> Column:
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("bigint")


def assign_shards(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """The rows of ``docs`` with ``bytes``, ``shard`` and ``page``.

    ``shard`` is ``b`` and the bits of the bucket, ``page`` is 0 except in chains. Each (shard,
    page) holds at most ``limit`` bytes, or one larger row. A null text counts as empty;
    columns called like the three new ones are replaced.
    """
    rows = docs.drop("bytes", "shard", "page").withColumns(
        {"bytes": row_bytes(), "_bits": key_bits(), "_leaf": F.lit(None).cast("string")}
    )
    for depth, leaves in directory(docs, limit):
        found = leaves.select(F.col("cell").alias("_cell"), F.col("leaf").alias("_found"))
        rows = (
            rows.join(found, F.substring("_bits", 1, depth) == F.col("_cell"), "left")
            .withColumn("_leaf", F.coalesce("_leaf", "_found"))
            .drop("_cell", "_found")
        )
    placed = rows.where("_leaf IS NOT NULL").withColumns(
        {"shard": F.concat(F.lit("b"), "_leaf"), "page": F.lit(0)}
    )
    if depth == BITS:
        placed = placed.unionByName(_chains(rows.where("_leaf IS NULL"), limit))
    return placed.drop("_bits", "_leaf")


def _chains(rows: DataFrame, limit: int) -> DataFrame:
    """Overflow pages of rows that agree in all bits, in order of size, id and text.

    The running sum is cut at every half of the limit, so a page of rows that are no longer
    than a half stays within it; longer rows get pages of their own, numbered below 0.

    One id, or none, may name a large part of all rows, so no window holds a chain. A
    row's place among those of its size adds up from counts: of smaller ids and beginnings of
    texts, of smaller texts with its beginning, of equal rows with a smaller salt, and last of
    those before it within its salt. The rows are written once, so that salts stay what they are.
    """
    salted = rows.withColumns(
        {
            "_wide": F.col("bytes") > limit // 2,
            "_start": F.substring("text", 1, START_CHARS),
            "_digest": F.sha2(F.col("text"), 256),
            "_salt": F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"),
        }
    )
    stored = materialise(salted, "shard-chains")
    size, begin = ["_bits", "_wide", "bytes"], ["doc_id", "_start"]
    copies = [*size, *begin, "_digest"]

    def before(part: list[str], *order: str | Column) -> Column:
        """Rows counted in ``n`` that come earlier in the part."""
        earlier = Window.partitionBy(*part).orderBy(*order)
        return F.coalesce(
            F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )

    cells = stored.groupBy(*copies, "_salt").agg(F.count("*").alias("n"))
    texts = stored.groupBy(*copies).agg(F.count("*").alias("n"), F.min("text").alias("text"))
    starts = texts.groupBy(*size, *begin).agg(F.sum("n").alias("n"))
    sizes = starts.groupBy(*size).agg(F.sum("n").alias("n"))

    # One row per size, then per beginning, text and salt, each with its offset in the one before.
    by_size = Window.partitionBy("_bits", "_wide").orderBy("bytes")
    earlier = by_size.rowsBetween(Window.unboundedPreceding, -1)
    of_sizes = sizes.select(
        *size,
        before(["_bits", "_wide"], "bytes").alias("_rows"),
        F.coalesce(F.sum(F.col("n") * F.col("bytes")).over(earlier), F.lit(0)).alias("_sum"),
    )
    of_starts = starts.select(*size, *begin, before(size, *begin).alias("_p1"))
    of_texts = texts.select(*copies, before([*size, *begin], "text").alias("_p2"))
    of_cells = cells.select(*copies, "_salt", before(copies, "_salt").alias("_p3"))
    own = F.row_number().over(Window.partitionBy(*copies, "_salt").orderBy("_salt")) - 1
    counted = _beside(_beside(stored.withColumn("_p4", own), of_cells, [*copies, "_salt"]), of_texts, copies)
    counted = _beside(_beside(counted, of_starts, [*size, *begin]), of_sizes, size)
    place = F.col("_p1") + F.col("_p2") + F.col("_p3") + F.col("_p4")
    page = F.when(F.col("_wide"), -(F.col("_rows") + place + 1)).otherwise(
        1 + F.floor((F.col("_sum") + place * F.col("bytes")) / (limit // 2))
    )
    return counted.select(
        *[F.col(c) for c in rows.columns],
        F.concat(F.lit("b"), "_bits").alias("shard"),
        page.cast("int").alias("page"),
    )


def _beside(rows: DataFrame, offsets: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the offsets of their keys, of which any may be null."""
    named = offsets.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [rows[k].eqNullSafe(named[f"_of_{k}"]) for k in keys]
    return rows.join(named, same, "left").drop(*[f"_of_{k}" for k in keys])


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES) -> DataFrame:
    """Writes every shard page to a folder of its own and returns the written rows."""
    placed = assign_shards(docs, limit)
    placed.repartition("shard", "page").write.partitionBy("shard", "page").parquet(path)
    return docs.sparkSession.read.schema(placed.schema).parquet(path)
