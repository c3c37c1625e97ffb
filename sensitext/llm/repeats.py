"""Removal of byte strings that an earlier document has, by suffix sorting.

1. Every window of ``window`` bytes names an anchor (see :mod:`anchors`). Stretches of windows
   with one anchor are records; packed, they are dealt by anchor.
2. Records of an anchor with equal bytes form a class: whole copies of stretches are
   answered here by the smallest id of the class, so a passage shared by very many
   documents goes on as one string. Of classes that may share windows with another class
   (equal halves around the anchor), the records of the smallest document go on.
3. Their bytes are cut to what some other class of the anchor has too, equal strings are
   joined, and the suffixes of all strings are sorted by linear grouping
   (:mod:`suffix_array`); windows that are neighbours in that order and equal are repeats,
   and the smallest id among them decides.
4. Per document, removed stretches are merged and cut out.

Equality is decided on bytes in step 3 and by 64-bit hashes of stretches, within one
anchor's bucket, in step 2.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sensitext.llm.anchors import ANCHOR, anchor_runs, run_hashes, word_view
from sensitext.llm.common import (
    ROW_KEY,
    by_key,
    byte_view,
    mix,
    row_keys,
    spans_of,
    text_bytes,
    unique_ids,
)
from sensitext.llm.suffix_array import suffix_array
from sensitext.session import materialise

WINDOW = 50
BUCKET_BYTES = 8 << 20
CHUNK_BYTES = 2 << 20
SCAN_BYTES = 1 << 18
GROUP_RECORDS = 2048
SORT_BYTES = 1 << 17
STRING_BYTES = 1 << 20

# A record that goes on: whole copies have group -1.
_FOUND = np.dtype(
    [
        ("doc", "<i8"), ("group", "<i8"), ("start", "<u4"), ("step", "<u4"), ("count", "<u4"),
        ("length", "<u2"), ("place", "<u2"), ("late", "?"),
    ]
)
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _deal(window: int, buckets: int):
    """Rows ``bucket, part``: the records of a chunk of documents, by anchor."""
    half = (window - ANCHOR) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            all_raw, all_bounds = byte_view(batch.column(1))
            for lo, hi in spans_of(all_bounds, CHUNK_BYTES):
                raw = all_raw[all_bounds[lo] : all_bounds[hi]]
                bounds = all_bounds[lo : hi + 1] - all_bounds[lo]
                found = [
                    (row + a, anchor, place + bounds[a], first + bounds[a], last + bounds[a])
                    for a, b in spans_of(bounds, SCAN_BYTES)
                    for row, anchor, place, first, last in [
                        anchor_runs(raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], window)
                    ]
                ]
                row, anchor, place, first, last = map(np.concatenate, zip(*found))
                if not len(row):
                    continue
                view, length = word_view(raw), last - first + window
                content = run_hashes(view, first, length)
                heads, step, count = progressions(row, anchor, content, first)
                row, anchor, content, place, first, length = (
                    x[heads] for x in (row, anchor, content, place, first, length)
                )
                # Any window of a stretch holds the anchor and a half more on one side.
                sides = np.full(len(row), ANCHOR + half)
                on_left, on_right = place - half >= first, first + length >= place + ANCHOR + half
                left = run_hashes(view, np.where(on_left, place - half, 0), sides)
                right = run_hashes(view, place, sides)
                base = ids[lo:hi].min()
                fields = {
                    "doc": _small(ids[lo + row] - base),
                    "anchor": anchor.astype(np.uint32),
                    "bytes": content,
                    "start": (first - bounds[row]).astype(np.uint32),
                    "step": _small(step),
                    "count": _small(count),
                    "length": length.astype(np.uint16 if 2 * window > 255 else np.uint8),
                    "place": (place - first).astype(np.uint16 if window > 255 else np.uint8),
                    "left": np.where(on_left, left.astype(np.uint16) | 1, 0).astype(np.uint16),
                    "right": np.where(on_right, right.astype(np.uint16) | 1, 0).astype(np.uint16),
                }
                to = ((anchor >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                order = np.argsort(to.astype(np.uint32), kind="stable")
                cuts = np.searchsorted(to[order], np.arange(buckets + 1, dtype=np.uint64))
                fields = {name: values[order] for name, values in fields.items()}
                sizes = [v.dtype.itemsize for v in fields.values()]
                key = xxhash.xxh3_64_intdigest(ids[lo:hi].tobytes()) >> 1
                names, parts = [], []
                for k in np.flatnonzero(cuts[1:] > cuts[:-1]):
                    cut = slice(cuts[k], cuts[k + 1])
                    head = np.array([key, base, cuts[k + 1] - cuts[k], *sizes], np.int64)
                    names.append(int(k))
                    parts.append(head.tobytes() + b"".join(v[cut].tobytes() for v in fields.values()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int32()), pa.array(parts, pa.binary())], ["bucket", "part"]
                )

    return run


def progressions(
    row: np.ndarray, anchor: np.ndarray, content: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal stretches of a row at equal distances count as one.

    Returns the first of each such run, the distance, and their number. A text that
    repeats a short phrase would else give a record per phrase, all with one anchor.
    """
    order = np.lexsort((first, content, anchor, row))
    key = [x[order] for x in (row, anchor, content)]
    same = np.concatenate(([False], np.logical_and.reduce([k[1:] == k[:-1] for k in key])))
    gap = np.where(same, np.diff(first[order], prepend=0), 0)
    turn = ~same
    turn[1:] |= same[:-1] & (gap[1:] != gap[:-1])
    at = np.flatnonzero(turn)
    count = np.diff(at, append=len(order))
    step = np.where(count > 1, gap[np.minimum(at + 1, len(order) - 1)], 0)
    return order[at], step, count


def _small(values: np.ndarray) -> np.ndarray:
    top = int(values.max(initial=0))
    return values.astype(np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _opened(part: bytes) -> tuple[int, list[np.ndarray]]:
    key, base, n, *sizes = map(int, np.frombuffer(part, np.int64, 13))
    at, fields = 104, []
    for size in sizes:
        fields.append(np.frombuffer(part, f"u{size}", n, at))
        at += size * n
    fields[0] = fields[0].astype(np.int64) + base
    return key, fields


def _classes(table: pa.Table, group_records: int) -> pa.Table:
    """Copies and open records of a bucket, packed by the chunk they came from."""
    bucket = table.column("bucket")[0].as_py()
    keys, parts = zip(*map(_opened, table.column("part").to_pylist()))
    chunk = np.repeat(np.arange(len(keys)), [len(p[0]) for p in parts])
    doc, anchor, content, start, step, count, length, place, left, right = map(np.concatenate, zip(*parts))
    order = np.lexsort((doc, content, anchor))
    doc, anchor, content = doc[order], anchor[order], content[order]
    left, right = left[order], right[order]
    new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
    new_class = new_anchor | np.concatenate(([True], content[1:] != content[:-1]))
    group, cls = np.cumsum(new_anchor) - 1, np.cumsum(new_class) - 1
    heads = np.flatnonzero(new_class)
    least = doc[heads]
    copy = doc > least[cls]

    def meets(check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes whose half stands in a class of the anchor with another first document.

        The second array marks those among them where that document may be a smaller one.
        """
        some = np.flatnonzero(check)
        key = group[heads[some]].astype(np.int64) << 16 | check[some]
        by = np.argsort(key, kind="stable")
        key, first = key[by], least[some[by]]
        runs = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else by
        met, late = np.zeros(len(check), bool), np.zeros(len(check), bool)
        if len(runs):
            size = np.diff(runs, append=len(key))
            low, high = np.minimum.reduceat(first, runs), np.maximum.reduceat(first, runs)
            met[some[by]] = np.repeat(low < high, size)
            late[some[by]] = np.repeat(low, size) < first
        return met, late

    (on_left, late_left), (on_right, late_right) = meets(left[heads]), meets(right[heads])
    late = (late_left | late_right)[cls]
    open_ = ~copy & (on_left | on_right)[cls]
    name = mix((np.uint64(bucket) << np.uint64(32)) | anchor.astype(np.uint64))
    many = np.bincount(group, open_)[group] > group_records
    # A very large group is split by halves; equal windows meet in one of the two.
    picks = [
        (copy, np.full(len(doc), -1)),
        (open_ & ~many, (name >> np.uint64(1)).astype(np.int64)),
    ]
    for side, (check, met) in enumerate(((left, on_left), (right, on_right))):
        half = mix(name + np.uint64(1 + side) + (check.astype(np.uint64) << np.uint64(8)))
        picks.append((open_ & many & met[cls], (half >> np.uint64(1)).astype(np.int64)))
    found, origin = [], []
    for pick, groups in picks:
        some = np.flatnonzero(pick)
        out = np.empty(len(some), _FOUND)
        out["doc"], out["group"] = doc[some], groups[some]
        for field, values in (
            ("start", start), ("step", step), ("count", count), ("length", length), ("place", place)
        ):
            out[field] = values[order[some]]
        out["late"] = late[some]
        found.append(out)
        origin.append(chunk[order[some]])
    found, origin = np.concatenate(found), np.concatenate(origin)
    by = np.argsort(origin, kind="stable")
    cuts = np.searchsorted(origin[by], np.arange(len(keys) + 1))
    some = np.flatnonzero(cuts[1:] > cuts[:-1])
    return pa.table(
        {
            "chunk": pa.array([keys[k] for k in some], pa.int64()),
            "part": pa.array([found[by[cuts[k] : cuts[k + 1]]].tobytes() for k in some], pa.binary()),
        }
    )


def _per_document(table: pa.Table) -> pa.Table:
    """``doc_id, copies, records`` of the documents of a chunk, packed."""
    rows = np.frombuffer(b"".join(table.column("part").to_pylist()), _FOUND)
    rows = rows[np.lexsort((rows["start"], rows["doc"]))]
    ids, first = np.unique(rows["doc"], return_index=True)
    copies, records = [], []
    for lo, hi in zip(first, np.append(first[1:], len(rows))):
        own = rows[lo:hi]
        whole = own["group"] < 0
        at = occurrences(own[whole])
        copies.append(merged(at, at + np.repeat(own["length"][whole], own["count"][whole])).tobytes())
        records.append(own[~whole].tobytes())
    return pa.table({"doc_id": ids, "copies": copies, "records": records})


def occurrences(records: np.ndarray) -> np.ndarray:
    """Starts of all stretches that the records stand for."""
    start, step, count = (records[c].astype(np.int64) for c in ("start", "step", "count"))
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(start, count) + nth * np.repeat(step, count)


def merged(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Stretches as rows ``start, end``; those that touch or overlap become one."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    heads = np.flatnonzero(new)
    return np.stack((starts[heads], reach[np.append(heads[1:], len(starts)) - 1]), 1).astype(np.int64)


def cut_out(raw: np.ndarray, cuts: np.ndarray) -> tuple[int, int, int, str]:
    """Bytes, bytes removed, stretches removed, and digest of what is left."""
    keep = np.ones(len(raw), bool)
    for start, end in cuts:
        keep[start:end] = False
    left = raw[keep]
    return len(raw), len(raw) - len(left), len(cuts), sha256(left.tobytes()).hexdigest()


_OPEN = (
    "array<struct<group: bigint, start: bigint, step: bigint, count: bigint, place: int, "
    "content: binary>>"
)


def _first_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of documents that no open record can shorten; the others keep text and copies."""
    names = ("group", "start", "step", "count", "place", "content")
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
    record = pa.struct(list(zip(names, kinds)))
    for batch in batches:
        raw, bounds = byte_view(batch.column(1))
        out = []
        for k, doc in enumerate(batch.column(0).to_pylist()):
            text = raw[bounds[k] : bounds[k + 1]]
            copies = batch.column(2)[k].as_py() or b""
            records = np.frombuffer(batch.column(3)[k].as_py() or b"", _FOUND)
            body = text.tobytes() if len(records) else b""
            contents = [
                dict(zip(names, (g, s, step, count, p, body[s : s + n])))
                for _, g, s, step, count, n, p, _ in records.tolist()
            ]
            if records["late"].any():
                out.append((doc, len(text), None, None, None, body, copies, contents))
            else:
                cuts = np.frombuffer(copies, np.int64).reshape(-1, 2)
                out.append((doc, *cut_out(text, cuts), None, None, contents))
        types = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary(), pa.list_(record)]
        fields = [*(x.split()[0] for x in RESULT.split(", ")), "body", "copies", "records"]
        columns = zip(*out) if out else [()] * 8
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types)], fields
        )


def shared_strings(
    group: np.ndarray, place: np.ndarray, contents: list[bytes], window: int
) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end, in each content, of what another content of its group has too.

    Contents are laid over each other at their anchors; begin equals end where no whole window is
    shared. The stretch may be too long, never too short.
    """
    n, side = len(contents), window - ANCHOR
    size = np.array([len(c) for c in contents])
    flat = np.frombuffer(b"".join(contents), np.uint8)
    at = np.cumsum(size) - size + place
    reach = []
    for step, room in ((-1, place), (1, size - place)):
        width = side if step < 0 else side + ANCHOR
        where = at[:, None] + (np.arange(width) * step + (step < 0) * -1)
        inside = np.arange(width) < room[:, None]
        context = np.where(inside, flat[np.clip(where, 0, len(flat) - 1)], 0).astype(np.uint8)
        key = np.concatenate((group.astype(">i8").view(np.uint8).reshape(n, 8), context), 1)
        order = np.argsort(np.ascontiguousarray(key).view(f"S{8 + width}").ravel(), kind="stable")
        same = context[order][1:] == context[order][:-1]
        common = np.where(same.all(1), width, same.argmin(1))
        common[group[order][1:] != group[order][:-1]] = 0
        best = np.zeros(n, np.int64)
        best[order] = np.maximum(np.append(common, 0), np.append(0, common))
        reach.append(np.minimum(best, room))
    none = reach[0] + reach[1] < window
    return np.where(none, 0, place - reach[0]), np.where(none, 0, place + reach[1])


def repeated_windows(strings: list[bytes], docs: np.ndarray, window: int) -> list[np.ndarray]:
    """For each string: the smallest document among all strings with that window, per window."""
    sizes = np.array([len(s) for s in strings])
    text = b"".join(strings)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(strings)), sizes)
    order = np.array(suffix_array(text), np.int64)
    order = order[order + window <= (starts + sizes)[owner[order]]]
    rows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), window)
    new = np.concatenate(([True], (rows[order[1:]] != rows[order[:-1]]).any(1)))
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(docs[owner[order]], heads)
    answer = np.zeros(len(text), np.int64)
    answer[order] = np.repeat(least, np.diff(heads, append=len(order)))
    return [answer[s : s + n - window + 1] for s, n in zip(starts, sizes)]


def _sorted_groups(window: int):
    """``doc_id, start, end``: removed stretches found among the records of some groups."""

    def run(table: pa.Table) -> pa.Table:
        doc, group, start, step, count, place = (
            table.column(c).to_numpy().astype(np.int64)
            for c in ("doc_id", "group", "start", "step", "count", "place")
        )
        contents = table.column("content").to_pylist()
        begin, end = shared_strings(group, place, contents, window)
        some = np.flatnonzero(end > begin)
        some = some[np.argsort(group[some], kind="stable")]
        out = []
        strings: dict[tuple[int, bytes], int] = {}
        least: list[int] = []
        members: list[tuple[int, int]] = []
        held = 0

        def flush() -> None:
            if not members:
                return
            answers = repeated_windows([s for _, s in strings], np.array(least), window)
            for k, s in members:
                gone = np.flatnonzero(answers[s] < doc[k])
                if len(gone):
                    first = start[k] + begin[k] + gone
                    cuts = merged(first, first + window)
                    shift = (np.arange(count[k]) * step[k])[:, None, None]
                    out.append((doc[k], (cuts + shift).reshape(-1, 2)))

        for nth, k in enumerate(some):
            if held > SORT_BYTES and group[k] != group[some[nth - 1]]:
                flush()
                strings, least, members, held = {}, [], [], 0
            key = (int(group[k]), contents[k][begin[k] : end[k]])
            s = strings.setdefault(key, len(strings))
            if s == len(least):
                least.append(doc[k])
                held += len(key[1])
            least[s] = min(least[s], doc[k])
            members.append((k, s))
        flush()
        cuts = np.concatenate([c for _, c in out]) if out else np.zeros((0, 2), np.int64)
        ids = np.repeat([d for d, _ in out], [len(c) for _, c in out]).astype(np.int64)
        return pa.table({"doc_id": ids, "start": cuts[:, 0], "end": cuts[:, 1]})

    return run


def _last_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, body, copies, more in zip(*(c.to_pylist() for c in batch.columns)):
            cuts = np.frombuffer(copies, np.int64).reshape(-1, 2)
            found = np.array([(x["start"], x["end"]) for x in more or []], np.int64).reshape(-1, 2)
            cuts = np.concatenate((cuts, found))
            cuts = merged(cuts[:, 0], cuts[:, 1])
            out.append((doc, *cut_out(np.frombuffer(body, np.uint8), cuts)))
        kinds = [pa.int64()] * 4 + [pa.string()]
        columns = zip(*out) if out else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, kinds)],
            [x.split()[0] for x in RESULT.split(", ")],
        )


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    bucket_bytes: int = BUCKET_BYTES,
    string_bytes: int = STRING_BYTES,
    group_records: int = GROUP_RECORDS,
) -> DataFrame:
    """What is left of each document without strings that an earlier document has.

    A byte goes if a string of ``window`` bytes over it also starts in a document with a
    smaller id, judged on the input. Null texts are empty. Every row is a document of its own;
    rows that share an id follow each other by text, and those without an id come last.
    """
    options = window, bucket_bytes, string_bytes, group_records
    if unique_ids(docs):
        return _rows_left(docs.select("doc_id", "text"), *options)
    rows = row_keys(docs.select("doc_id", "text"))
    left = _rows_left(by_key(rows), *options).withColumnRenamed("doc_id", ROW_KEY)
    names = [x.split()[0] for x in RESULT.split(", ")]
    return left.join(rows.select(ROW_KEY, "doc_id"), ROW_KEY).select(*names)


def _rows_left(
    docs: DataFrame, window: int, bucket_bytes: int, string_bytes: int, group_records: int
) -> DataFrame:
    """:func:`remove_repeats` of rows that ``doc_id`` names."""
    buckets = max(8, -(-text_bytes(docs) // bucket_bytes))
    found = materialise(
        docs.mapInArrow(_deal(window, buckets), "bucket int, part binary")
        .groupBy("bucket")
        .applyInArrow(lambda t: _classes(t, group_records), "chunk bigint, part binary")
        .groupBy("chunk")
        .applyInArrow(_per_document, "doc_id bigint, copies binary, records binary"),
        "repeat-records",
    )
    # Joined by sorting at every size: a broadcast would be bound to small inputs.
    first = materialise(
        docs.join(found.hint("merge"), "doc_id", "left")
        .select("doc_id", "text", "copies", "records")
        .mapInArrow(_first_cut, f"{RESULT}, body binary, copies binary, records {_OPEN}"),
        "repeat-first",
    )
    waiting = first.where("body IS NOT NULL")
    records = first.select("doc_id", F.explode("records").alias("r")).select("doc_id", "r.*")
    size = records.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    parts = max(1, -(-size // string_bytes))
    stretches = (
        records.withColumn("part", F.pmod(F.xxhash64("group"), F.lit(parts)))
        .groupBy("part")
        .applyInArrow(_sorted_groups(window), "doc_id bigint, start bigint, end bigint")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("start", "end")).alias("more"))
    )
    rest = (
        waiting.select("doc_id", "body", "copies")
        .join(stretches.hint("merge"), "doc_id", "left")
        .mapInArrow(_last_cut, RESULT)
    )
    done = first.where("body IS NULL").select(*rest.columns)
    return done.union(rest)
