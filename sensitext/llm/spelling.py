"""Spelling variants: words one edit apart, each led to its most frequent form.

Near words are found by dynamic programming over sorted lists. Two words one edit apart share the
first half of the shorter one or, if the edit lies there, the rest of it. So every word goes to the
lists of its halves, and a list holds what is left of its words, sorted. Each word scans its
list from its own place on: the band of the edit matrix, three cells a row, is kept for every depth,
rows up to the prefix that two neighbours of the list share (their LCP) are used again, and once a
row has no cell below two, all words with that prefix are skipped at a stroke. Scans of many words
go forward in step as NumPy arrays, one row of the matrix at a time.

A list longer than ``MOST_WORDS`` is parted by the halves of what is left, again and again, until a
single letter is left; so no task holds a list that grows with the vocabulary.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sensitext.session import materialise

MIN_CHARS, MIN_COUNT, RATIO, TYPO = 6, 5, 5, 199
MOST_WORDS = 1 << 16
# Words that a task counts before it sends them on, and cells of the arrays of one scan.
MEMO_WORDS, CELLS = 400_000, 1 << 22

# Bytes of Latin-1: letters, with A-Z in lower case; all others part words.
_LETTERS = bytearray(b" " * 256)
for _c in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)):
    _LETTERS[_c] = _c
for _c in range(ord("A"), ord("Z") + 1):
    _LETTERS[_c] = _c + 32
_LETTERS = bytes(_LETTERS)


def runs(text: str) -> list[bytes]:
    """Runs of letters as Latin-1 bytes, one byte a code point."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def count_runs(total: Counter, doc_id: str, text: str, min_chars: int, typo: int) -> None:
    """Add the words of a text; a run whose hash ``typo`` divides loses a letter first."""
    words = [w for w in runs(text) if len(w) >= min_chars]
    total.update(words)
    seed = zlib.crc32(f"{doc_id}:".encode())
    for word in set(words):
        spelled = word if word.isascii() else word.decode("latin-1").encode()
        h = zlib.crc32(spelled, seed)
        if h % typo == 0:
            cut, n = h % len(word), words.count(word)
            total[word] -= n
            total[word[:cut] + word[cut + 1 :]] += n


def word_counts(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    typo: int = TYPO,
) -> DataFrame:
    """``word, n``: words of at least ``min_chars`` letters that occur ``min_count`` times."""

    def rows(total: Counter) -> pa.RecordBatch:
        kept = {w: n for w, n in total.items() if n and len(w) >= min_chars}
        words = [w.decode("latin-1") for w in kept]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(list(kept.values()), pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if text.is_valid:
                    count_runs(total, doc_id, text.as_py(), min_chars, typo)
                    if len(total) > MEMO_WORDS:
                        yield rows(total)
                        total.clear()
        yield rows(total)

    narrow = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    return (
        narrow.mapInArrow(run, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= min_count)
    )


# --- lists ---------------------------------------------------------------------------


# What stands before a half in the name of its list; words hold no control characters.
_FIRST, _SECOND = "\x01", "\x02"


def _halves(rows: DataFrame) -> DataFrame:
    """Each row in the list of the first half of its ``rest`` and in that of the other half.

    ``size`` is the number of letters of ``rest`` in the shorter words of a list; the others have
    one more. In the second list, what is left is read backwards from the shared part.
    """
    half = F.floor(F.col("size") / 2).cast("int")
    length = F.length("rest")
    other = F.col("size") - half
    first = F.struct(
        F.concat("list", F.lit(_FIRST), F.substring("rest", F.lit(1), half)).alias("list"),
        other.alias("size"),
        F.substring("rest", half + 1, length).alias("rest"),
    )
    second = F.struct(
        F.concat("list", F.lit(_SECOND), F.substring("rest", length - other + 1, other)).alias("list"),
        half.alias("size"),
        F.reverse(F.substring("rest", F.lit(1), length - other)).alias("rest"),
    )
    sides = F.explode(F.array(first, second)).alias("s")
    return rows.select("word", "n", sides).select("word", "n", "s.*")


def word_lists(
    words: DataFrame, min_chars: int = MIN_CHARS, most_words: int = MOST_WORDS
) -> DataFrame:
    """``word, n, list, size, rest``: every word in all lists where a near word can stand.

    A word is one of the shorter words of a list, or one of the longer by a letter.
    """
    length = F.length("word")
    sizes = F.explode(F.array(length, length - 1)).alias("size")
    start = words.select("word", "n", sizes, F.col("word").alias("rest"))
    start = start.where(F.col("size") >= max(2, min_chars))
    lists = _halves(start.withColumn("list", F.col("size").cast("string")))
    whole = []
    while True:
        lists = materialise(lists, "word-lists")
        counts = lists.groupBy("list", "size").agg(F.count("*").alias("rows"))
        long = counts.where((F.col("rows") > most_words) & (F.col("size") > 1)).select("list")
        if not long.limit(1).count():
            break
        whole.append(lists.join(long, "list", "left_anti"))
        lists = _halves(lists.join(long, "list", "left_semi"))
    for part in whole:
        lists = lists.unionByName(part)
    return lists


# --- the scan ------------------------------------------------------------------------

_BANDS = list(product(range(3), repeat=3))
_OUT = 2


def _band_steps() -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """Rows of the banded matrix as numbers.

    A row after ``d`` letters holds the distances to the first ``d - 1``, ``d`` and ``d + 1``
    letters of the query, where all above one count as two. Gives the next row for each row and
    set of equal letters, whether a row has a cell below two, the cells, and the rows of the empty
    prefix and of a prefix of the query.
    """
    number = {band: i for i, band in enumerate(_BANDS)}
    steps = np.zeros((len(_BANDS), 8), np.uint8)
    for band, i in number.items():
        for same in range(8):
            left = min(band[0] + (not same & 1), band[1] + 1)
            middle = min(band[1] + (not same & 2), band[2] + 1, left + 1)
            right = min(band[2] + (not same & 4), middle + 1)
            steps[i, same] = number[tuple(min(c, _OUT) for c in (left, middle, right))]
    cells = np.array(_BANDS, np.uint8)
    return steps, cells.min(axis=1) < _OUT, cells, number[(2, 0, 1)], number[(1, 0, 1)]


_STEPS, _ALIVE, _CELLS, _EMPTY, _EQUAL = _band_steps()


def scan(rests: list[str], lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places whose strings are one edit apart, the earlier place first.

    ``lists`` numbers the list of each string; strings of a list are in order and differ.
    """
    count = len(rests)
    lengths = np.fromiter(map(len, rests), np.int64, count)
    width = int(lengths.max(initial=0))
    # A column before the letters and two behind them, equal to no letter.
    letters = np.zeros((count, width + 3), np.uint32)
    flat = np.frombuffer("".join(rests).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(count), lengths)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    letters[row, column + 1] = flat + 1
    del flat, row, column

    new_list = np.ones(count, bool)
    new_list[1:] = lists[1:] != lists[:-1]
    equal = np.ones(count, np.int64)
    shared = np.zeros(count, np.int64)
    for d in range(1, width + 1):
        equal[1:] &= (letters[1:, d] == letters[:-1, d]) & (letters[1:, d] > 0)
        shared[1:] += equal[1:]
    shared[new_list] = -1
    # The next place, for every depth, that shares fewer letters with the one before it.
    places = np.arange(count)
    after = np.empty((width + 1, count), np.int32)
    for d in range(width + 1):
        shorter = np.where(shared < d, places, count)
        after[d, -1:] = count
        after[d, :-1] = np.minimum.accumulate(shorter[::-1])[::-1][1:]
    shared = np.append(shared, -1)

    bands = np.full((count, width + 1), _EQUAL, np.uint8)
    bands[:, 0] = _EMPTY
    queries = np.arange(count)
    at = queries + 1
    going = shared[at] >= 0
    queries, at = queries[going], at[going]
    # Words that follow share their letters with the query itself; rows up to there hold.
    depth = shared[at]
    firsts, seconds = [], []
    while len(queries):
        letter = letters[at, depth + 1]
        same = (
            (letters[queries, depth] == letter)
            + 2 * (letters[queries, depth + 1] == letter)
            + 4 * (letters[queries, depth + 2] == letter)
        )
        band = _STEPS[bands[queries, depth], same]
        depth = depth + 1
        bands[queries, depth] = band
        alive = _ALIVE[band]
        ended = depth == lengths[at]
        whole = alive & ended
        if whole.any():
            cell = lengths[queries[whole]] - depth[whole] + 1
            within = (cell >= 0) & (cell <= 2)
            near = within & (_CELLS[band[whole], np.clip(cell, 0, 2)] == 1)
            firsts.append(queries[whole][near])
            seconds.append(at[whole][near])
        moved = ended | ~alive
        if moved.any():
            at = at.copy()
            at[moved] = np.where(
                alive[moved], at[moved] + 1, after[np.minimum(depth[moved], width), at[moved]]
            )
            depth = np.where(moved, shared[at], depth)
            going = depth >= 0
            queries, at, depth = queries[going], at[going], depth[going]
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *firsts]), np.concatenate([empty, *seconds])


def _whole_lists(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[pa.Table]:
    """Rows of whole lists together, about ``cells`` cells of their scan at a time."""
    held: list[pa.RecordBatch] = []
    name, rows, width = None, 0, 0
    for batch in batches:
        lists = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        sizes = batch.column(1).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(np.diff(lists, prepend=-1)).tolist()
        for begin, end in zip(begins, [*begins[1:], batch.num_rows]):
            new = batch.column(0)[begin].as_py()
            if held and new != name and rows * (max(width, int(sizes[begin])) + 4) > cells:
                yield pa.Table.from_batches(held)
                held, rows, width = [], 0, 0
            held.append(batch.slice(begin, end - begin))
            name, rows, width = new, rows + end - begin, max(width, int(sizes[begin]))
    if held:
        yield pa.Table.from_batches(held)


def near_words(lists: DataFrame, cells: int = CELLS) -> DataFrame:
    """``word, near, near_n``: words one edit apart, from either side; a pair may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_lists(batches, cells):
            numbers = table.column("list").combine_chunks().dictionary_encode()
            if isinstance(numbers, pa.ChunkedArray):
                numbers = numbers.combine_chunks()
            a, b = scan(
                table.column("rest").to_pylist(), numbers.indices.to_numpy(zero_copy_only=False)
            )
            own, other = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
            words, counts = (table.column(c).combine_chunks() for c in ("word", "n"))
            yield pa.RecordBatch.from_arrays(
                [words.take(own), words.take(other), counts.take(other)],
                names=["word", "near", "near_n"],
            )

    ordered = (
        lists.select("list", "size", "rest", "word", "n")
        .repartition("list")
        .sortWithinPartitions("size", "list", "rest")
    )
    return ordered.mapInArrow(run, "word string, near string, near_n bigint")


# --- forms ---------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the forms of ``word, form`` lead at last.

    Each form is several times as frequent as its word, so a chain is short and has no circle;
    every round doubles the steps that are taken.
    """
    ends = materialise(forms.select("word", F.col("form").alias("root")), "word-roots")
    while True:
        on = ends.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = ends.join(on, "root", "left")
        step = joined.select(
            "word",
            F.coalesce("_next", "root").alias("root"),
            F.col("_next").isNotNull().alias("_moved"),
        )
        step = materialise(step, "word-roots")
        ends = step.drop("_moved")
        if not step.where("_moved").limit(1).count():
            return ends


def spelling_forms(
    words: DataFrame,
    min_chars: int = MIN_CHARS,
    ratio: int = RATIO,
    most_words: int = MOST_WORDS,
    cells: int = CELLS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct words of at least ``min_chars`` letters.

    A word's form is its near word with the largest count (of equal ones the first in code-point
    order), if it occurs at least ``ratio`` times as often as the word.
    """
    words = materialise(words.select("word", "n"), "words")
    pairs = near_words(word_lists(words, min_chars, most_words), cells)
    # A word has few near words: as many as there are places and letters for an edit.
    per_word = (
        pairs.repartition("word")
        .dropDuplicates(["word", "near"])
        .groupBy("word")
        .agg(
            F.count("*").alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("top"),
        )
    )
    known = words.join(per_word, "word", "left")
    top_n = -F.col("top.less")
    formed = top_n >= ratio * F.col("n")
    found = materialise(
        known.select(
            "word",
            F.when(formed, F.col("top.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(formed, top_n).cast("bigint").alias("form_n"),
        ),
        "word-forms",
    )
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Words of all texts with their forms: see :func:`word_counts` and :func:`spelling_forms`.

    Null and empty texts have no words; a missing id counts as an empty one. Every row counts, so
    repeated rows count again. Other columns are ignored; without words there are no rows.
    """
    return spelling_forms(word_counts(docs))
