"""Best-fit packing of token pieces into sequences by bin completion.

Only lengths matter to the packing, and there are at most ``limit`` of them. So Spark counts
the pieces of each length, the driver packs that histogram (its size does not depend on the
rows), and Spark deals the pieces of a length out to the places that length got.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sensitext.llm.tokens import tokenizer_path, word_tokenizer
from sensitext.session import materialise

LIMIT, END = 4096, 1
# Steps of the search at most; each takes some microseconds of the driver.
STEPS = 300_000
CELL_ROWS = 100_000

# A packing: (lengths with their number in one sequence, longest first; sequences like that).
Fill = tuple[tuple[int, int], ...]
Packing = list[tuple[Fill, int]]


def best_fit(counts: dict[int, int], limit: int) -> Packing:
    """Best-fit decreasing over a histogram; like bins are kept together."""
    bins: dict[int, dict[tuple, int]] = {}
    rooms: list[int] = []

    def put(room: int, fill: tuple, n: int) -> None:
        if room not in bins:
            bins[room] = {}
            insort(rooms, room)
        bins[room][fill] = bins[room].get(fill, 0) + n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                # New bins take as many of this length as fit, as best fit would do.
                per = min(limit // length, left)
                put(limit - per * length, ((length, per),), left // per)
                left %= per
                continue
            room = rooms[k]
            fill, n = bins[room].popitem()
            per = min(room // length, left)
            used = min(n, left // per)
            if n > used:
                bins[room][fill] = n - used
            if not bins[room]:
                del bins[room]
                rooms.pop(k)
            put(room - per * length, (*fill, (length, per)), used)
            left -= used * per
    return [(fill, n) for fills in bins.values() for fill, n in fills.items()]


def lower_bound(counts: dict[int, int], limit: int) -> int:
    """Sequences that no packing can do without: by sum, and by pieces over one half."""
    total = sum(k * n for k, n in counts.items())
    best = -(-total // limit)
    for cut in range(1, limit // 2 + 1, max(1, limit // 64)):
        large = sum(n for k, n in counts.items() if k > limit - cut)
        half = sum(n for k, n in counts.items() if limit // 2 < k <= limit - cut)
        room = half * limit - sum(k * n for k, n in counts.items() if limit // 2 < k <= limit - cut)
        small = sum(k * n for k, n in counts.items() if cut <= k <= limit // 2)
        best = max(best, large + half + max(0, -(-(small - room) // limit)))
    return best


class _Search:
    """Depth-first search over fillings, on one array of counts that every step back restores.

    What is held grows with the depth of the search alone: the fillings chosen so far and, for each,
    the place of its enumeration.
    """

    def __init__(self, counts: dict[int, int], limit: int, steps: int):
        self.limit, self.steps = limit, steps
        self.left = [0] * (limit + 1)
        # Bit k says whether a piece of length k is left.
        self.there = 0
        for length, n in counts.items():
            self.add(length, n)

    def add(self, length: int, n: int) -> None:
        self.left[length] += n
        if not self.left[length]:
            self.there &= ~(1 << length)
        elif self.left[length] == n:
            self.there |= 1 << length

    def longest(self, at_most: int) -> int:
        """The longest length up to ``at_most`` with a piece left, or 0."""
        return max(0, (self.there & ((2 << at_most) - 1)).bit_length() - 1)

    def any_between(self, low: int, high: int) -> bool:
        """Whether a piece of ``low`` to ``high`` tokens is left."""
        return low <= high and bool((self.there >> low) & ((2 << (high - low)) - 1))

    def dominated(self, chosen: list[int], spare: int) -> bool:
        """Whether a piece that is left could stand for one, two or all pieces of a filling.

        The piece then leaves those it stands for to another sequence, which has room for them.
        """
        distinct = sorted(set(chosen))
        if any(self.any_between(x + 1, x + spare) for x in distinct):
            return True
        twice = {x for x in distinct if chosen.count(x) > 1}
        sums = {x + y for i, x in enumerate(distinct) for y in distinct[i + (x not in twice) :]}
        if len(chosen) > 2:
            sums.add(sum(chosen))
        return any(self.any_between(x, x + spare) for x in sums)

    def fillings(self, room: int) -> Iterator[tuple[list[int], int]]:
        """Fillings of ``room`` that nothing dominates, with their spare room.

        They come longest pieces first. While one is looked at, its pieces are out of the counts;
        they are back when the next is asked for.
        """
        chosen: list[int] = []
        nexts = [room]
        if not self.longest(room):
            yield [], room
            return
        while nexts:
            length = self.longest(min(nexts[-1], room)) if self.steps > 0 else 0
            if not length:
                nexts.pop()
                if chosen:
                    room += chosen[-1]
                    self.add(chosen.pop(), 1)
                continue
            self.steps -= 1
            nexts[-1] = length - 1
            chosen.append(length)
            self.add(length, -1)
            room -= length
            # Only fillings that no piece fits beside are not dominated by a larger one.
            if self.longest(room):
                nexts.append(length)
                continue
            if not self.dominated(chosen, room):
                yield chosen, room
            nexts.append(0)

    def branches(self, most_waste: Callable[[], int]) -> Iterator[tuple[Fill, int, int]]:
        """Fillings around the longest piece left, each for all sequences it can make, and for one."""
        top = self.longest(self.limit)
        self.add(top, -1)
        for chosen, spare in self.fillings(self.limit - top):
            if spare > most_waste():
                continue
            need = Counter([top, *chosen])
            # The pieces of one such sequence are out of the counts at this point.
            most = 1 + min(self.left[length] // n for length, n in need.items())
            if spare:
                most = min(most, most_waste() // spare)
            fill = tuple(sorted(need.items(), reverse=True))
            kept = chosen.copy()
            for length in (top, *kept):
                self.add(length, 1)
            for times in sorted({most, 1} - {0}, reverse=True):
                yield fill, times, spare
            for length in (top, *kept):
                self.add(length, -1)
        self.add(top, 1)


def bin_completion(counts: dict[int, int], limit: int, steps: int = STEPS) -> Packing:
    """Branch and bound over undominated fillings around the longest piece left.

    The best-fit packing is the first incumbent. A branch that wastes more than a packing with
    one sequence fewer may waste is cut; a filling is used for as many sequences as the
    counts allow, and on the way back for one. At the lower bound, or after ``steps`` steps (a piece
    put into a filling, or a filling taken), the incumbent stands; :func:`lower_bound` tells how far it can be from the
    best packing.
    """
    counts = {k: n for k, n in counts.items() if n}
    incumbent = best_fit(counts, limit)
    total = sum(k * n for k, n in counts.items())
    least = lower_bound(counts, limit)
    best = sum(n for _, n in incumbent)
    search = _Search(counts, limit, steps)
    trail: list[tuple[Fill, int, int]] = []
    used = waste = 0

    def most_waste() -> int:
        return (best - 1) * limit - total - waste

    def take(branch: tuple[Fill, int, int], sign: int) -> None:
        nonlocal used, waste
        fill, times, spare = branch
        for length, n in fill:
            search.add(length, -sign * n * times)
        used += sign * times
        waste += sign * spare * times

    frames = [search.branches(most_waste)] if counts and best > least else []
    while frames and best > least and search.steps > 0:
        search.steps -= 1
        branch = next(frames[-1], None)
        if branch is None:
            frames.pop()
            if trail:
                take(trail.pop(), -1)
            continue
        take(branch, 1)
        trail.append(branch)
        if search.longest(limit):
            frames.append(search.branches(most_waste))
            continue
        if used < best:
            best, incumbent = used, [(fill, times) for fill, times, _ in trail]
        take(trail.pop(), -1)
    return incumbent


def places(packing: Packing) -> np.ndarray:
    """Rows ``length, first rank, pieces per sequence, first sequence, offset``."""
    taken: Counter = Counter()
    rows, sequence = [], 0
    for fill, times in packing:
        offset = 0
        for length, per in fill:
            rows.append((length, taken[length], per, sequence, offset))
            taken[length] += per * times
            offset += length * per
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def token_pieces(docs: DataFrame, path: str, limit: int = LIMIT, end: int = END) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: ids of each text and ``end``, cut at ``limit``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path, "<u4")
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for doc, text in zip(ids, batch.column(1)):
                packed = tokenizer.encode(text.as_py() or "") + tail
                for k, at in enumerate(range(0, len(packed), 4 * limit)):
                    part = packed[at : at + 4 * limit]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            columns = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds)], names
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def pack(
    docs: DataFrame, path: str | None = None, limit: int = LIMIT, end: int = END, steps: int = STEPS
) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``.

    A null text counts as empty and gives one piece with ``end`` alone. Ids may be null or
    repeat: every row gives its own pieces. No rows give no pieces.
    """
    spark = docs.sparkSession
    pieces = materialise(token_pieces(docs, path or tokenizer_path(), limit, end), "pieces")
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    table = places(bin_completion(counts, limit, steps))
    shared = spark.sparkContext.broadcast((table[:, 0] << 44 | table[:, 1], table))

    # Ranks within a length, counted in cells so that one common length is not one group.
    cells = max(1, -(-sum(counts.values()) // CELL_ROWS))
    cell = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(cells))
    split = pieces.withColumn("cell", cell)
    per_length = Window.partitionBy("length").orderBy("cell")
    before = (
        split.groupBy("length", "cell")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(per_length) - F.col("n"))
        .drop("n")
    )
    in_cell = Window.partitionBy("length", "cell").orderBy("doc_id", "piece")
    ranked = split.withColumn("nth", F.row_number().over(in_cell) - 1).join(
        before, ["length", "cell"]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows = shared.value
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in (3, 5))
            if not len(length):
                continue
            row = rows[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            nth = rank - row[:, 1]
            columns = [
                *batch.columns[:5],
                pa.array(row[:, 3] + nth // row[:, 2]),
                pa.array(row[:, 4] + nth % row[:, 2] * length),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, [*batch.schema.names[:5], "sequence_id", "offset"]
            )

    rank = (F.col("before") + F.col("nth")).cast("bigint").alias("rank")
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", rank).mapInArrow(
        place,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint",
    )
