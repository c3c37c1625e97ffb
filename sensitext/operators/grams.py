"""Frequent n-grams of token arrays, counted exactly, and a dictionary of them.

A gram is frequent only if both grams one token shorter in it are. So each length is one pass over
the rows, and a window is counted only if its two shorter grams may be frequent, which a Bloom
filter of bounded size tells; what passes it by chance is counted and falls out by its count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensitext.functions.binding import bind
from sensitext.operators.prefilter import digest, digest_membership
from sensitext.session import materialise


def grams_of(tokens: Column | str, n: int) -> Column:
    """The distinct runs of ``n`` tokens, joined by spaces; null tokens are left out.

    None where there are fewer tokens, null where there is no array. A token with a space is an error,
    as its gram could be that of two.
    """
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    stop = F.raise_error(F.lit("a token holds a space")).cast("array<string>")
    # The tokens put together hold a space if one of them does.
    checked = F.when(F.contains(F.array_join(tokens, ""), F.lit(" ")), stop).otherwise(tokens)
    found = F.array_compact(checked)
    if n == 1:
        return F.array_distinct(found)

    def runs(t: Column) -> Column:
        count = F.greatest(F.size(t) - (n - 1), F.lit(0))
        joined = F.slice(t, 1, count)
        for k in range(2, n + 1):
            joined = F.zip_with(joined, F.slice(t, k, count), lambda a, b: F.concat(a, F.lit(" "), b))
        return joined

    return F.array_distinct(bind(found, runs))


def frequent_grams(
    rows: DataFrame, tokens_col: str, n: int = 2, min_rows: int = 3
) -> DataFrame:
    """Runs of one to ``n`` tokens that stand in ``min_rows`` rows at least: ``gram, size, n_rows``.

    A row counts once for each gram (``grams_of``). All lengths but the last are written once, as
    the next one is filtered by them.
    """
    found, shorter = None, None
    for size in range(1, n + 1):
        grams = rows.select(F.explode(grams_of(tokens_col, size)).alias("gram"))
        if shorter is not None:
            is_frequent = digest_membership(shorter, "gram")
            ends = [F.substring_index("gram", " ", k * (size - 1)) for k in (1, -1)]
            # Inlined, the digests are columns of their own; a filter would compute them for each probe.
            digests = F.struct(*[digest(e).alias(f"_end{i}") for i, e in enumerate(ends)])
            hashed = grams.select("gram", F.inline(F.array(digests)))
            grams = hashed.where(is_frequent(F.col("_end0")) & is_frequent(F.col("_end1"))).select("gram")
        counted = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n_rows"))
        counted = counted.where(F.col("n_rows") >= min_rows)
        if size < n:
            counted = shorter = materialise(counted, f"grams-{size}")
        level = counted.select("gram", F.lit(size).alias("size"), "n_rows")
        found = level if found is None else found.unionByName(level)
    return found


def gram_dictionary(
    rows: DataFrame, tokens_col: str, n: int, min_rows: int, size: int
) -> list[str]:
    """The ``size`` most frequent grams at most; among equal ones short grams first, then by gram."""
    order = [F.desc("n_rows"), F.asc("size"), F.asc("gram")]
    top = frequent_grams(rows, tokens_col, n, min_rows).orderBy(*order).limit(size)
    return [r.gram for r in top.select("gram").collect()]
