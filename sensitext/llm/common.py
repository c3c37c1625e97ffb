"""Helpers of this subpackage: reading, keyed rows, byte views and word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensitext.session import materialise

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CHUNK_BYTES = 4 << 20
ROW_KEY = "_row_key"

# ASCII white space, which ends a word.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
_PLAIN[ord("A") : ord("Z") + 1] = True

# A byte as it counts in its word's hash.
_VALUE = np.where(_SPACE, 0, _LOWER).astype(np.uint64)
_PLAIN_VALUE = np.where(_PLAIN, _VALUE, 0).astype(np.uint64)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of documents with its fixed columns."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def unique_ids(docs: DataFrame) -> bool:
    """Whether ``doc_id`` names every row: no id is missing or stands in two rows."""
    counts = docs.groupBy("doc_id").count()
    return not counts.where("count > 1 OR doc_id IS NULL").limit(1).count()


def row_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own for every row in ``ROW_KEY``.

    Numbers rise with ``doc_id`` (missing ids last) and then with ``text``. They are written once
    to the shared folder, so all that reads them sees the same; rows of one id are spread by text
    and by their place in the input, so a hot id is no hot task.
    """
    place = "_place"
    ordered = (
        docs.withColumn(place, F.monotonically_increasing_id())
        .orderBy(F.asc_nulls_last("doc_id"), "text", place)
        .drop(place)
    )
    return materialise(ordered.withColumn(ROW_KEY, F.monotonically_increasing_id()), "row-keys")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``ROW_KEY``: the ids where they name every row, else :func:`row_keys`."""
    return docs.withColumn(ROW_KEY, F.col("doc_id")) if unique_ids(docs) else row_keys(docs)


def by_key(rows: DataFrame) -> DataFrame:
    """``doc_id, text`` of keyed rows, with the key in the place of the id."""
    return rows.select(F.col(ROW_KEY).alias("doc_id"), "text")


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts; sizes the buckets of the operators."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the bounds of its rows; null counts as empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    return raw, bounds - bounds[0]


def spans_of(bounds: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold at most ``limit`` bytes, or one longer row."""
    first, last = 0, len(bounds) - 1
    while first < last:
        to = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        to = min(max(to, first + 1), last)
        yield first, to
        first = to


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(
    raw: np.ndarray, bounds: np.ndarray, plain: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of every word of each row, with the word's byte range.

    Returns ``(hash, start, word_bounds)``: words of row ``i`` are
    ``word_bounds[i]:word_bounds[i + 1]``. Words end at ASCII white space, ``A-Z`` count as
    lower case. With ``plain`` only ASCII letters, digits and bytes over 127 make words. Every
    eight bytes of a word are mixed with their place before they are added up, so no
    pattern of letters makes two words meet.
    """
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = _PLAIN[raw] if plain else ~_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < n]
    begins[edges] |= inside[edges]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, np.zeros(len(bounds), np.int64)
    # Bytes up to the next word belong to this one; those between words count nothing.
    head = starts[0]
    spread = np.diff(starts, append=n)
    place = np.arange(n - head, dtype=np.int32) - np.repeat((starts - head).astype(np.int32), spread)
    values = (_PLAIN_VALUE if plain else _VALUE)[raw[head:]]
    values <<= ((place & 7) << 3).astype(np.uint64)
    eights = np.flatnonzero(((place & 7) == 0) & inside[head:])
    nth = (place[eights] >> 3).astype(np.uint64)
    mixed = mix(np.add.reduceat(values, eights) + (nth + np.uint64(1)) * _BASE)
    sizes = np.add.reduceat(inside[head:], starts - head, dtype=np.uint64)
    hashes = mix(np.add.reduceat(mixed, np.flatnonzero(nth == 0)) + sizes * _M2)
    return hashes, starts, np.searchsorted(starts, bounds)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words; a shorter sequence counts as one run."""
    if not len(words):
        return words
    size = min(n, len(words))
    seeds = mix(np.arange(1, size + 1, dtype=np.uint64) * _BASE + np.uint64(size)) | np.uint64(1)
    count = len(words) - size + 1
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total = mix(total + words[i : i + count] * seeds[i])
    return total
