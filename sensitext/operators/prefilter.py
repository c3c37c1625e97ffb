"""A Bloom filter over join keys, to drop rows before costly work below a join.

The filter is built from bitmaps of Spark's own (``bitmap_construct_agg``): each task sets the bits of
its keys and Spark merges them, so what reaches the driver is the filter alone. It travels as the one
row of a table beside the plan, which is a scalar subquery of it, and is looked up by plain
expressions: as a literal it would stand in the plan once for each use, and in every text that Spark
makes of the plan. A row without a partner passes now and then and meets the join; a row with one is
never dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Bits of one bitmap of Spark's.
_BITMAP = 1 << 15
# The filter's own size is bounded: 16 MB. Beyond that many keys more rows pass, none is lost.
MIN_BITS, MAX_BITS = 1 << 16, 1 << 27
BITS_PER_KEY, PROBES = 12, 4


def filter_bits(n_keys: int) -> int:
    """A power of two with room for ``BITS_PER_KEY`` bits a key, within bounds."""
    bits = MIN_BITS
    while bits < min(n_keys * BITS_PER_KEY, MAX_BITS):
        bits *= 2
    return bits


def digest(key: Column) -> Column:
    """The one hash of a key that all its places come from."""
    return F.xxhash64(key)


def _places(hashed: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(hashed, F.lit(i)), F.lit(bits)) for i in range(PROBES)]


def bloom_filter(keys: DataFrame, key: str, kind: str, bits: int) -> bytes:
    """Filter over the keys that are not null, taken as of type ``kind``."""
    value = F.col(key).cast(kind)
    places = keys.where(value.isNotNull()).select(F.explode(F.array(*_places(digest(value), bits))).alias("p"))
    maps = places.groupBy(F.floor(F.col("p") / _BITMAP).alias("at")).agg(
        F.bitmap_construct_agg(F.col("p") % _BITMAP).alias("map")
    )
    out = bytearray(bits // 8)
    for row in maps.collect():
        out[row["at"] * _BITMAP // 8 : (row["at"] + 1) * _BITMAP // 8] = row["map"]
    return bytes(out)


def membership(keys: DataFrame, key: str, kind: str | None = None) -> Callable[[Column], Column]:
    """A test of columns of type ``kind``, the key's own unless given: may a value stand in ``keys``?

    A null never stands there.
    """
    may = digest_membership(keys, key, kind)
    return lambda value: value.isNotNull() & may(digest(value))


def digest_membership(keys: DataFrame, key: str, kind: str | None = None) -> Callable[[Column], Column]:
    """The test of ``membership`` for columns of digests, which a caller may have computed once.

    Two small jobs run at once: a count of the keys, and the filter.
    """
    kind = kind or keys.schema[key].dataType.simpleString()
    narrow = keys.select(key)
    bits = filter_bits(narrow.count())
    words = np.frombuffer(bloom_filter(narrow, key, kind, bits), "<i8")
    row = pa.table({"words": pa.ListArray.from_arrays([0, len(words)], pa.array(words))})
    whole = keys.sparkSession.createDataFrame(row).scalar()

    def is_set(place: Column) -> Column:
        word = F.get(whole, F.shiftright(place, 6).cast("int"))
        return F.bit_get(word, (place % 64).cast("int")) == 1

    return lambda hashed: reduce(and_, map(is_set, _places(hashed, bits)))


def may_match(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` may stand in ``keys``, and all that do; null keys never do."""
    # A null is no key of an equal join.
    return df.where(membership(keys, key, df.schema[key].dataType.simpleString())(F.col(key)))
