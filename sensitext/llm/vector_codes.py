"""Vector codes: equal parts of a vector, each coded by its codebook's nearest entry.

Codebooks come from Lloyd's rounds in whole numbers. The search for the nearest entry is that of
ball k-means: the parts that an entry holds form a ball around it, and only entries no farther
from it than twice the ball's radius are its neighbours. A part closer to its entry than half the
way to the nearest neighbour lies in the stable core and keeps its entry without a comparison. The
others lie in rings: a part is compared with the neighbours that are at most twice as far from its
entry as the part itself, in the order of their distance. All of it is exact, ties included: two
entries are equally near only if the neighbour is within that bound.

Spark counts and adds up; the driver holds the codebooks alone, ``PARTS * ENTRIES`` short vectors.
Balls are those of a batch of rows, which lie inside the balls of all rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sensitext.session import materialise

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
# Whole numbers up to this size have exact sums of squares in 64 bits.
LARGEST = 1 << 26
BATCH_ROWS = 8192


def usable(vector: str) -> F.Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))),
    )
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False))


def whole_parts(column: pa.Array, width: int, parts: int, scale: int) -> np.ndarray:
    """``rows x parts x width of a part`` of ``floor(scale * x)``."""
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    if len(values) != len(column) * width:
        raise ValueError(f"vectors must all have {width} components")
    numbers = np.floor(values * scale)
    if len(numbers) and np.abs(numbers).max() > LARGEST:
        raise ValueError(f"components must lie within {LARGEST // scale} of zero")
    return numbers.astype(np.int64).reshape(len(column), parts, width // parts)


def square(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=-1)


class Balls:
    """A codebook of one part position, ready to restrict the search for nearest entries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gaps = square(entries[:, None] - entries[None])
        np.fill_diagonal(gaps, -1)
        # The entry itself comes first and is left out; equal gaps keep the lower index first.
        self.neighbours = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
        np.fill_diagonal(gaps, 0)
        self.gaps = np.take_along_axis(gaps, self.neighbours, axis=1)
        self.compared = 0

    def nearest(self, points: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each point and its squared distance, lower index on ties.

        ``start`` is any entry for each point; the better it is, the less is compared.
        """
        best, least = start.copy(), square(points - self.entries[start])
        if not len(points) or not self.gaps.shape[1]:
            return best, least
        radius = np.zeros(len(self.entries), np.int64)
        np.maximum.at(radius, start, least)
        # Neighbours of a ball; beyond them no member can have a nearer entry.
        reach = (self.gaps <= 4 * radius[:, None]).sum(axis=1)
        own = least.copy()
        active = np.flatnonzero(self.gaps[start, 0] <= 4 * own)
        for ring in range(int(reach.max(initial=0))):
            at = start[active]
            inside = (ring < reach[at]) & (self.gaps[at, ring] <= 4 * own[active])
            active, at = active[inside], at[inside]
            if not len(active):
                break
            self.compared += len(active)
            other = self.neighbours[at, ring]
            far = square(points[active] - self.entries[other])
            won = (far < least[active]) | ((far == least[active]) & (other < best[active]))
            best[active[won]], least[active[won]] = other[won], far[won]
        return best, least


def assign(vectors: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Entries of all parts under the last of ``books``, and their squared distances.

    Each round of codebooks starts from the entries of the one before.
    """
    rows, parts, _ = vectors.shape
    codes = np.zeros((rows, parts), np.int64)
    errors = np.zeros((rows, parts), np.int64)
    for p in range(parts):
        for book in books:
            codes[:, p], errors[:, p] = Balls(book[p]).nearest(vectors[:, p], codes[:, p])
    return codes, errors


def first_books(kept: DataFrame, vector: str, key: str, parts: int, entries: int, scale: int):
    """``parts x entries x width``: the parts of the vectors with the smallest keys, or None."""
    rows = kept.orderBy(F.asc_nulls_last(key), vector).limit(entries).select(vector).collect()
    if not rows:
        return None
    width = len(rows[0][0])
    if not width or width % parts:
        raise ValueError(f"{width} components cannot be cut into {parts} equal parts")
    column = pa.array([r[0] for r in rows], pa.list_(pa.float64()))
    return whole_parts(column, width, parts, scale).transpose(1, 0, 2).copy()


def next_books(kept: DataFrame, vector: str, books: list[np.ndarray], scale: int) -> np.ndarray:
    """One round: means, rounded down, of the parts that each entry holds; others stay.

    Every task adds up its own parts; the sums, ``parts x entries`` of them, are merged by Spark.
    """
    parts, entries, width = books[-1].shape
    shared = kept.sparkSession.sparkContext.broadcast(books)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        for batch in sliced(batches):
            vectors = whole_parts(batch.column(0), parts * width, parts, scale)
            codes, _ = assign(vectors, books)
            for p in range(parts):
                counts[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(sums[p], codes[:, p], vectors[:, p])
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(p, pa.int32()),
                pa.array(e, pa.int32()),
                pa.array(counts[p, e]),
                pa.array(list(sums[p, e]), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    cells = kept.select(vector).mapInArrow(
        partial, "part int, entry int, n bigint, sums array<bigint>"
    )
    totals = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    merged = cells.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals)
    book = books[-1].copy()
    for row in merged.collect():
        book[row.part, row.entry] = [row[f"s{i}"] // row.n for i in range(width)]
    shared.destroy()
    return book


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def learn_books(
    vectors: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> list[np.ndarray]:
    """The codebooks before and after each round; none where no vector is usable."""
    kept = vectors.where(usable(vector))
    first = first_books(kept, vector, key, parts, entries, scale)
    books = [] if first is None else [first]
    for _ in range(rounds if books else 0):
        books.append(next_books(kept, vector, books, scale))
    return books


def encode_vectors(
    vectors: DataFrame, books: list[np.ndarray], vector: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """``vec_id, label, code, error`` of each usable vector: entries as bytes, distances added up."""
    parts, _, width = books[-1].shape
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            numbers = whole_parts(batch.column(2), parts * width, parts, scale)
            codes, errors = assign(numbers, shared.value)
            raw = [row.tobytes() for row in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(raw, pa.binary()),
                    pa.array(errors.sum(axis=1)),
                ],
                names=["vec_id", "label", "code", "error"],
            )

    kind = vectors.schema["label"].dataType.simpleString()
    return (
        vectors.where(usable(vector))
        .select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", vector)
        .mapInArrow(run, f"vec_id bigint, label {kind}, code binary, error bigint")
    )


def books_sha256(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of each usable vector.

    Vectors that are null, or hold null or non-finite components, are left out; those of another
    width than the first, or too large for exact sums, are an error. Rows are coded one by
    one, so repeated rows repeat; of equal ids the smaller vector comes first in the codebooks
    and a missing id comes last. Fewer usable vectors than entries make smaller codebooks, none give
    no rows. Null labels form one group. Other columns are ignored.
    """
    spark = vectors.sparkSession
    books = learn_books(vectors)
    if not books:
        return spark.createDataFrame(
            [],
            "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string",
        )
    coded = materialise(encode_vectors(vectors, books), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books_sha256(books[-1])).alias("codebooks_sha256"),
    )
