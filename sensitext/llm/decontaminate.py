"""Benchmark decontamination: BM25 over test items, block-max WAND, overlap check.

Test items are cut into units of at most ``UNIT`` words and indexed; an entry's impact is its
BM25 weight as a share of the unit's own score, so 1 means that a passage holds every
word of the unit. Every training passage (``PASSAGE`` words, half overlapping, so each
unit fits into one) is a query. A passage is dropped at once if, for every unit, the sum
over the unit's rarer terms plus all that its commoner terms could add stays too low; for
the others block-max WAND retrieves all units at or above the threshold. A retrieved item counts as leaked if runs of words of its question and of
its answer stand around the passage.

Document frequencies, the number of units and their mean length are counted once over all
units. The index is built block by block over the test items (``BLOCK_BYTES`` of text each), and a
scan of the documents asks ``BLOCKS_PER_SCAN`` blocks about the words it has hashed once; so what a
task holds is bounded however long the benchmark is, and the blocks have no part in the scores.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sensitext.llm.common import byte_view, gram_hashes, spans_of, word_hashes
from sensitext.session import materialise

UNIT, PASSAGE = 48, 96
K1, B = 1.2, 0.75
SCORE, OVERLAP = 0.6, 0.5
RUN = 5
LIST_BLOCK = 16
BLOCK_BYTES = 8 << 20
BLOCKS_PER_SCAN = 8
FILTER_BITS = 22
# Share of a unit's score that its commonest terms, left out of the first bound, may have.
REST = 0.2

RESULT = (
    "doc_id bigint, item_id bigint, score double, question_overlap double, "
    "answer_overlap double, passages int, first_word bigint"
)


def words_of(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(raw, np.array([0, len(raw)]), plain=True)[0]


def question_and_answer(text: str) -> tuple[str, str]:
    """The last line is the answer; in a single line, the last sentence."""
    lines = [x for x in text.split("\n") if len(words_of(x))]
    if len(lines) > 1:
        return "\n".join(lines[:-1]), lines[-1]
    parts = [x for x in re.split(r"(?<=[.?!])\s+", text) if len(words_of(x))]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


@dataclass
class Index:
    """Units of some items, by term: unit numbers in order, impacts, and block maxima."""

    terms: np.ndarray
    best: np.ndarray
    known: np.ndarray
    lists: list[list[int]]
    impacts: list[list[float]]
    blocks: list[dict[int, float]]
    item: list[int]
    ids: list[int | None]
    runs: dict[int, tuple[int, int, np.ndarray, int, np.ndarray]]
    rest: np.ndarray
    rare_cut: np.ndarray
    rare_unit: np.ndarray
    rare_share: np.ndarray

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """Term number of each word, the number of terms where it is none."""
        out = np.full(len(words), len(self.terms), np.int32)
        maybe = np.flatnonzero(self.known[words >> np.uint64(64 - FILTER_BITS)])
        at = np.searchsorted(self.terms, words[maybe])
        at[at == len(self.terms)] = 0
        hit = self.terms[at] == words[maybe]
        out[maybe[hit]] = at[hit]
        return out


def units_of(words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct words of each unit of an item, with their numbers."""
    parts = -(-len(words) // UNIT)
    return [np.unique(p, return_counts=True) for p in np.array_split(words, parts)] if parts else []


@dataclass
class Statistics:
    """Units and words of all items, and in how many units each of some terms stands."""

    units: int
    words: int
    terms: np.ndarray
    df: np.ndarray

    def frequencies(self, terms: np.ndarray) -> np.ndarray:
        return self.df[np.searchsorted(self.terms, terms)]


def build_index(items: list[tuple[int | None, str]], counted: Statistics) -> Index | None:
    """Index of ``(id, text)`` items; an item is its place in the list, ids may repeat."""
    units, owner, runs = [], [], {}
    for item, (_, text) in enumerate(items):
        words = words_of(text)
        if not len(words):
            continue
        own = units_of(words)
        units += own
        owner += [item] * len(own)
        question, answer = map(words_of, question_and_answer(text))
        q, a = min(RUN, len(question)), min(RUN, len(answer))
        runs[item] = (
            len(words), q, np.unique(gram_hashes(question, q)), a, np.unique(gram_hashes(answer, a))
        )
    if not units:
        return None
    terms = np.unique(np.concatenate([t for t, _ in units]))
    df = counted.frequencies(terms)
    idf = np.log(1 + (counted.units - df + 0.5) / (df + 0.5))
    sizes = np.array([c.sum() for _, c in units])
    mean = counted.words / counted.units
    lists: list[list[int]] = [[] for _ in terms]
    impacts: list[list[float]] = [[] for _ in terms]
    blocks: list[dict[int, float]] = [{} for _ in terms]
    # Units of like length stand together, which keeps the block maxima tight.
    order = np.argsort(sizes, kind="stable")
    rest = np.zeros(len(units))
    rare: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for number, u in enumerate(order):
        at = np.searchsorted(terms, units[u][0])
        tf = units[u][1]
        norm = K1 * (1 - B + B * sizes[u] / mean)
        share = idf[at] * tf * (K1 + 1) / (tf + norm)
        share /= share.sum()
        common = np.argsort(-df[at], kind="stable")
        left_out = np.cumsum(share[common]) <= REST
        rest[number] = share[common][left_out].sum()
        kept = common[~left_out]
        rare.append((at[kept], np.full(len(kept), number), share[kept]))
        for t, s in zip(at.tolist(), share.tolist()):
            lists[t].append(number)
            impacts[t].append(s)
            block = number // LIST_BLOCK
            blocks[t][block] = max(s, blocks[t].get(block, 0.0))
    known = np.zeros(1 << FILTER_BITS, bool)
    known[terms >> np.uint64(64 - FILTER_BITS)] = True
    best = np.array([max(i) for i in impacts] + [0.0])
    term, unit, share = (np.concatenate(c) for c in zip(*rare))
    by_term = np.argsort(term, kind="stable")
    cut = np.searchsorted(term[by_term], np.arange(len(terms) + 2))
    owners = [owner[u] for u in order]
    return Index(
        terms, best, known, lists, impacts, blocks, owners, [i for i, _ in items], runs, rest, cut,
        unit[by_term], share[by_term],
    )


def promising(index: Index, term: np.ndarray, passage: np.ndarray, least: float) -> np.ndarray:
    """Passages that may reach ``least`` for some unit, given ``(term, passage)`` pairs."""
    many = index.rare_cut[term + 1] - index.rare_cut[term]
    passage = np.repeat(passage, many)
    entry = np.arange(len(passage)) + np.repeat(index.rare_cut[term] - np.cumsum(many) + many, many)
    units = len(index.rest)
    key = passage * units + index.rare_unit[entry]
    order = np.argsort(key)
    key, share = key[order], index.rare_share[entry][order]
    if not len(key):
        return key
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    total = np.add.reduceat(share, first) + index.rest[key[first] % units]
    return np.unique(key[first][total >= least - 1e-6] // units)


def block_max_wand(index: Index, terms: list[int], least: float) -> list[tuple[int, float]]:
    """All units that score at least ``least`` for the set of terms."""
    least -= 1e-9
    best = index.best
    # One cursor per term: current unit, term, place in its list.
    cursors = [[index.lists[t][0], t, 0] for t in terms]
    found = []

    def advance(cursor: list[int], unit: int) -> bool:
        entries = index.lists[cursor[1]]
        cursor[2] = bisect_left(entries, unit, cursor[2])
        if cursor[2] == len(entries):
            return False
        cursor[0] = entries[cursor[2]]
        return True

    while cursors:
        cursors.sort()
        bound, pivot = 0.0, -1
        for k, c in enumerate(cursors):
            bound += best[c[1]]
            if bound >= least:
                pivot = k
                break
        if pivot < 0:
            break
        unit = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == unit:
            pivot += 1
        block = unit // LIST_BLOCK
        if sum(index.blocks[c[1]].get(block, 0.0) for c in cursors[: pivot + 1]) < least:
            # No unit of this block can do it, short of one that a later cursor starts.
            target = (block + 1) * LIST_BLOCK
            if pivot + 1 < len(cursors):
                target = min(target, cursors[pivot + 1][0])
            cursors = [c for k, c in enumerate(cursors) if k > pivot or advance(c, target)]
        elif cursors[0][0] == unit:
            score = sum(index.impacts[c[1]][c[2]] for c in cursors[: pivot + 1])
            if score >= least:
                found.append((unit, score))
            cursors = [c for k, c in enumerate(cursors) if k > pivot or advance(c, unit + 1)]
        else:
            cursors = [c for c in cursors if c[0] >= unit or advance(c, unit)]
    return found


def leaks(index: Index, words: np.ndarray, at: np.ndarray, score: float, overlap: float):
    """``(row, item, score, question, answer, passages, first word)`` of the texts ``words[at]``."""
    if not len(words):
        return
    term = index.lookup(words)
    step = PASSAGE // 2
    sizes = np.diff(at)
    # The last passage is full where it can be.
    count = np.where(sizes > PASSAGE, -(-(sizes - PASSAGE) // step) + 1, np.minimum(sizes, 1))
    row = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = at[row] + nth * step
    end = np.minimum(begin + PASSAGE, at[row + 1])
    # A word lies in the passage that begins in its half, and in the one before.
    heads = np.cumsum(count) - count
    where = np.flatnonzero(term < len(index.terms))
    home = np.searchsorted(at, where, side="right") - 1
    half = (where - at[home]) // step
    halves = (half, half - 1)
    inside = [(h >= 0) & (h < count[home]) for h in halves]
    terms = np.concatenate([term[where[i]] for i in inside])
    passages = np.concatenate([(heads[home] + h)[i] for h, i in zip(halves, inside)])
    found: dict[tuple[int, int], list] = {}
    for k in promising(index, terms, passages, score):
        query = np.unique(term[begin[k] : end[k]])
        query = query[query < len(index.terms)]
        for unit, value in block_max_wand(index, query.tolist(), score):
            item = index.item[unit]
            size, q, question, a, answer = index.runs[item]
            lo, hi = max(at[row[k]], begin[k] - size), min(at[row[k] + 1], end[k] + size)
            near = words[lo:hi]
            in_question = np.isin(question, gram_hashes(near, q)).mean() if q else 1.0
            in_answer = np.isin(answer, gram_hashes(near, a)).mean() if a else 1.0
            if min(in_question, in_answer) < overlap:
                continue
            old = found.setdefault((row[k], item), [0.0, 0.0, 0.0, 0, begin[k] - at[row[k]]])
            old[:3] = max(old[0], value), max(old[1], in_question), max(old[2], in_answer)
            old[3] += 1
    for (r, item), values in found.items():
        yield (r, index.ids[item], *values)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    score: float = SCORE,
    overlap: float = OVERLAP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document and test item that it holds.

    ``score`` is the share of a unit's BM25 score that a passage has to reach, ``overlap`` the
    share of its runs of ``RUN`` words that must be there, in question and answer each. Null and
    empty texts and items match nothing. Every distinct pair of ``item_id`` and text is an item of
    its own, items without an id included; documents that share an id are searched one by
    one, rows without an id too. Without documents or items there are no rows.
    """
    items = benchmark.where("text IS NOT NULL")
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    of_block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")
    items = materialise(items.withColumn("block", of_block), "test-items")
    counted = _counted(items)
    out = docs.sparkSession.createDataFrame([], RESULT)
    for first in range(0, blocks, BLOCKS_PER_SCAN):
        indexes = [_block_index(items, counted, k) for k in range(first, min(blocks, first + BLOCKS_PER_SCAN))]
        out = out.union(_search(docs, [i for i in indexes if i is not None], score, overlap))
    return out


def _counted(items: DataFrame) -> DataFrame:
    """``block, term, df, units, words``: frequencies over all items of the terms of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                units = units_of(words_of(text.as_py()))
                terms, df = np.unique(
                    np.concatenate([t for t, _ in units] or [np.zeros(0, np.uint64)]), return_counts=True
                )
                size = sum(int(c.sum()) for _, c in units)
                # The row without a term counts the units and their words.
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block] * (len(terms) + 1), pa.int32()),
                        pa.array([None, *terms.view(np.int64).tolist()], pa.int64()),
                        pa.array([len(units), *df.tolist()], pa.int64()),
                        pa.array([size] + [0] * len(terms), pa.int64()),
                    ],
                    names=["block", "term", "n", "words"],
                )

    parts = items.select("block", "text").mapInArrow(
        run, "block int, term bigint, n bigint, words bigint"
    )
    cells = parts.groupBy("block", "term").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    # A term has a row for each block at most.
    everywhere = Window.partitionBy("term")
    totals = [F.sum(c).over(everywhere).alias(c) for c in ("n", "words")]
    return materialise(cells.select("block", "term", *totals), "test-frequencies")


def _block_index(items: DataFrame, counted: DataFrame, block: int) -> Index | None:
    """Index of one block on the driver: ``BLOCK_BYTES`` of text and the frequencies of its terms."""
    rows = items.where(F.col("block") == block).orderBy("item_id", "text").collect()
    if not rows:
        return None
    table = counted.where(F.col("block") == block).toArrow()
    n = table.column("n").to_numpy()
    none = np.asarray(table.column("term").is_null())
    units = int(n[none].sum())
    if not units:
        return None
    terms = np.asarray(table.column("term").fill_null(0)).view(np.uint64)[~none]
    order = np.argsort(terms)
    words = int(table.column("words").to_numpy()[none].sum())
    counts = Statistics(units, words, terms[order], n[~none][order])
    return build_index([(r.item_id, r.text) for r in rows], counts)


def _search(docs: DataFrame, indexes: list[Index], score: float, overlap: float) -> DataFrame:
    """Leaks of the items of some indexes, in one scan of the documents."""
    shared = docs.sparkSession.sparkContext.broadcast(indexes)
    names = [x.split()[0] for x in RESULT.split(", ")]
    kinds = [pa.int64()] * 2 + [pa.float64()] * 3 + [pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            raw, bounds = byte_view(batch.column(1))
            rows = []
            for lo, hi in spans_of(bounds):
                words, _, at = word_hashes(
                    raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo], plain=True
                )
                rows += [
                    (ids[lo + r[0]], r[1], *map(float, r[2:5]), r[5], int(r[6]))
                    for index in shared.value
                    for r in leaks(index, words, at, score, overlap)
                ]
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds)], names
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, RESULT)
