"""Exact Jaccard join on word n-grams with set-relation skipping.

1. Every document becomes the set of its n-gram hashes. Hashes are dealt to buckets by
   their leading bits, packed; a bucket tells how many of a document's grams occur in
   another document. A document whose shared grams are fewer than the threshold asks
   for can link with nothing and is done.
2. Documents that are left are grouped by equal sets; one of each group goes on.
3. Sets that share a gram within their prefixes (rarest grams first) form clusters, found
   as stars around the smallest id of each list, so no list is expanded into pairs.
4. Inside a cluster :func:`solve` answers every set. Lists are ordered by what follows an
   entry's position, so the rest of a list is skipped once positions are too deep; a set
   close to an answered one gets its overlaps from that answer by adding and
   subtracting the lists of the grams in which both differ. Large clusters are cut into
   blocks and every pair of blocks is solved on its own.

Hashes have 64 bits; texts are equal to the join if all their gram hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sensitext.llm.common import (
    ROW_KEY,
    by_key,
    byte_view,
    gram_hashes,
    row_keys,
    spans_of,
    text_bytes,
    unique_ids,
    word_hashes,
)
from sensitext.llm.components import components
from sensitext.session import materialise

BUCKET_BYTES = 24 << 20
CHUNK_BYTES = 8 << 20
BLOCK_SETS = 2048
BLOCK_GRAMS = 2_000_000
# A set this close to an answered one (differing grams per gram) takes over its answer.
FOLLOW = 8


def gram_sets(raw: np.ndarray, bounds: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct gram hashes of every row."""
    words, _, at = word_hashes(raw, bounds)
    out = []
    for lo, hi in zip(at[:-1], at[1:]):
        grams = np.sort(gram_hashes(words[lo:hi], n))
        if len(grams) > 1:
            grams = grams[np.concatenate(([True], grams[1:] != grams[:-1]))]
        out.append(grams)
    return out


def _deal(n: int, buckets: int):
    """Rows ``bucket, part``: the grams of a chunk of documents, by their leading bits.

    In a bucket a document is its chunk's key and its place there; ids and set sizes of the chunk
    go under a bucket number below 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            raw, bounds = byte_view(batch.column(1))
            for lo, hi in spans_of(bounds, CHUNK_BYTES):
                sets = gram_sets(raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo], n)
                sizes = np.array([len(s) for s in sets])
                body = ids[lo:hi].tobytes() + sizes.astype(np.int64).tobytes()
                key = np.int64(xxhash.xxh3_64_intdigest(body) >> 1)
                names = [-1 - int(key) % buckets]
                parts = [np.array([key, hi - lo, 8, 8], np.int64).tobytes() + body]
                grams = np.concatenate(sets)
                row = np.repeat(np.arange(len(sets)), sizes)
                to = ((grams >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                order = np.argsort(to.astype(np.uint32), kind="stable")
                to, row, low = to[order].astype(np.int64), row[order], grams[order].astype(np.uint32)
                cuts = np.searchsorted(to, np.arange(buckets + 1))
                for k in np.flatnonzero(cuts[1:] > cuts[:-1]):
                    rows, counts = np.unique(row[cuts[k] : cuts[k + 1]], return_counts=True)
                    wide = [2 if hi - lo < 1 << 16 else 4, 1 if counts.max() < 256 else 4]
                    names.append(int(k))
                    parts.append(
                        np.array([key, len(rows), *wide], np.int64).tobytes()
                        + rows.astype(f"u{wide[0]}").tobytes()
                        + counts.astype(f"u{wide[1]}").tobytes()
                        + low[cuts[k] : cuts[k + 1]].tobytes()
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int32()), pa.array(parts, pa.binary())], ["bucket", "part"]
                )

    return run


def _opened(part: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Key, places, counts and grams of a part."""
    key, n, first, second = map(int, np.frombuffer(part, np.int64, 4))
    places = np.frombuffer(part, f"u{first}", n, 32)
    counts = np.frombuffer(part, f"u{second}", n, 32 + first * n)
    at = 32 + (first + second) * n
    return key, places, counts, np.frombuffer(part, np.uint8, -1, at).view(np.uint32)


def _shared(table: pa.Table) -> pa.Table:
    """Of each chunk in a bucket: how many grams of its documents stand in another document."""
    if table.column("bucket")[0].as_py() < 0:
        parts = table.column("part").to_pylist()
        keys = [int(np.frombuffer(p, np.int64, 1)[0]) for p in parts]
        return pa.table({"chunk": keys, "sizes": [True] * len(parts), "part": parts})
    keys, places, counts, grams = zip(*map(_opened, table.column("part").to_pylist()))
    ends = np.cumsum([0, *map(len, places)])
    grams = np.concatenate(grams)
    pair = np.repeat(np.arange(ends[-1], dtype=np.int32), np.concatenate(counts))
    order = np.argsort(grams)
    grams = grams[order]
    same = grams[1:] == grams[:-1]
    again = np.concatenate((same, [False])) | np.concatenate(([False], same))
    shared = np.bincount(pair[order][again], minlength=ends[-1])
    parts = []
    for key, where, lo, hi in zip(keys, places, ends[:-1], ends[1:]):
        some = np.flatnonzero(shared[lo:hi])
        head = np.array([key, len(some), 4, 4], np.int64).tobytes()
        found = where[some].astype(np.uint32), shared[lo:hi][some].astype(np.uint32)
        parts.append(head + found[0].tobytes() + found[1].tobytes())
    return pa.table(
        {"chunk": pa.array(keys, pa.int64()), "sizes": [False] * len(parts), "part": parts}
    )


def _totals(table: pa.Table) -> pa.Table:
    """``doc_id, n, shared`` of the documents of a chunk."""
    shared, ids, sizes = np.zeros(0, np.int64), None, None
    for is_sizes, part in zip(table.column("sizes").to_pylist(), table.column("part").to_pylist()):
        _, places, counts, _ = _opened(part)
        if is_sizes:
            ids, sizes = places.astype(np.int64), counts.astype(np.int64)
        elif len(places):
            if places[-1] >= len(shared):
                shared = np.concatenate((shared, np.zeros(int(places[-1]) + 1 - len(shared), np.int64)))
            shared[places] += counts
    full = np.zeros(len(ids), np.int64)
    full[: len(shared)] = shared
    return pa.table({"doc_id": ids, "n": sizes, "shared": full})


def _sets(n: int):
    """Rows ``doc_id, n, digest, grams``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = byte_view(batch.column(1))
            for lo, hi in spans_of(bounds):
                sets = gram_sets(raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo], n)
                ends = np.cumsum([0, *(len(s) for s in sets)])
                grams = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(np.diff(ends)),
                        pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets]),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(grams)),
                    ],
                    ["doc_id", "n", "digest", "grams"],
                )

    return run


def solve(
    n: np.ndarray,
    sets: list[np.ndarray],
    weight: np.ndarray,
    percent: int,
    side: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Links of every set with the others, answered with skipping.

    ``sets`` hold the grams that other sets may share, rarest first; ``n`` the full sizes,
    ``weight`` how many documents a set stands for. With ``side`` given, only sets of
    different sides are compared. Returns the smallest index
    each set is connected to, and the documents it links with.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    ends = np.concatenate(([0], np.cumsum(sizes)))
    _, gram = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), sizes)
    # What a set still has from a position on; grams that nobody shares come first.
    left = sizes[owner] - (np.arange(len(owner)) - ends[owner])
    order = np.lexsort((-left, gram))
    lists, depth = owner[order], -left[order]
    cut = np.searchsorted(gram[order], np.arange(gram.max() + 2 if len(gram) else 1))
    mark = np.zeros(len(cut), bool)
    place = np.full(m, -1)
    root = np.arange(m)
    links = np.zeros(m, np.int64)
    done = np.zeros(m, bool)

    def settle(x: int, near: np.ndarray, overlap: np.ndarray) -> None:
        done[x] = True
        hit = (100 + percent) * overlap >= percent * (n[x] + n[near])
        hit &= near != x
        if side is not None:
            hit &= side[near] != side[x]
        found = near[hit]
        if len(found):
            links[x] = weight[found].sum()
            old = np.unique(root[np.append(found, x)])
            if len(old) > 1:
                root[np.isin(root, old)] = old[0]

    for x in np.argsort(-sizes, kind="stable"):
        if done[x]:
            continue
        mine = gram[ends[x] : ends[x + 1]]
        far = max(1, n[x] // FOLLOW)
        least = max(1, -(-percent * (n[x] - far) // 100) - far)
        probe = max(0, len(mine) - least + 1)
        seen = []
        for t in mine[:probe]:
            lo, hi = cut[t], cut[t + 1]
            seen.append(lists[lo : lo + np.searchsorted(depth[lo:hi], -least, side="right")])
        near = np.unique(np.concatenate([*seen, [x]]).astype(np.int64))
        mark[mine] = True
        spread = sizes[near]
        flat = np.repeat(ends[near] - np.concatenate(([0], np.cumsum(spread)[:-1])), spread)
        hits = mark[gram[flat + np.arange(len(flat))]]
        overlap = np.bincount(np.repeat(np.arange(len(near)), spread)[hits], minlength=len(near))
        settle(x, near, overlap)
        place[near] = np.arange(len(near))
        apart = n[x] + n[near] - 2 * overlap
        for k in np.flatnonzero((apart <= far) & ~done[near]):
            f = near[k]
            its = gram[ends[f] : ends[f + 1]]
            fresh = its[~mark[its]]
            mark[its] = False
            gone = mine[mark[mine]]
            mark[its] = True
            mark[fresh] = False
            mark[mine] = True
            derived = overlap.copy()
            for change, sign in ((gone, -1), (fresh, 1)):
                for t in change:
                    where = place[lists[cut[t] : cut[t + 1]]]
                    derived[where[where >= 0]] += sign
            settle(f, near, derived)
        place[near] = -1
        mark[mine] = False
    return root, links


def _solved(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("class_id", ignore_index=True)
        ids = rows["class_id"].to_numpy()
        root, links = solve(
            rows["n"].to_numpy(),
            [np.asarray(s, np.int64) for s in rows["grams"]],
            rows["copies"].to_numpy(),
            percent,
            rows["side"].to_numpy() if rows["i"][0] != rows["j"][0] else None,
        )
        return pd.DataFrame({"class_id": ids, "root": ids[root], "links": links})

    return run


def ngram_components(
    docs: DataFrame,
    n: int = 5,
    percent: int = 80,
    bucket_bytes: int = BUCKET_BYTES,
    block_sets: int = BLOCK_SETS,
    block_grams: int = BLOCK_GRAMS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every document.

    Two documents link if ``100 * common >= percent * all`` of their distinct word
    n-grams; fewer than ``n`` words count as one gram. ``component_id`` is the smallest id
    reached by links, ``n_links`` the documents linked directly. Null and blank texts have
    no grams and no links. Every row is a document of its own, also where its id is missing or
    stands in other rows; a component in which no row has an id has no ``component_id``.
    """
    options = n, percent, bucket_bytes, block_sets, block_grams
    if unique_ids(docs):
        return row_components(docs, *options)
    rows = row_keys(docs.select("doc_id", "text"))
    found = row_components(by_key(rows), *options).withColumnRenamed("doc_id", ROW_KEY)
    # The smallest key of a component belongs to its smallest id.
    heads = rows.select(F.col(ROW_KEY).alias("component_id"), F.col("doc_id").alias("head"))
    return (
        found.join(rows.select(ROW_KEY, "doc_id"), ROW_KEY)
        .join(heads, "component_id")
        .select("doc_id", "n_shingles", F.col("head").alias("component_id"), "n_links")
    )


def row_components(
    docs: DataFrame,
    n: int = 5,
    percent: int = 80,
    bucket_bytes: int = BUCKET_BYTES,
    block_sets: int = BLOCK_SETS,
    block_grams: int = BLOCK_GRAMS,
) -> DataFrame:
    """:func:`ngram_components` of rows that ``doc_id`` is known to name."""
    docs = docs.select("doc_id", "text")
    buckets = max(8, -(-text_bytes(docs) // bucket_bytes))
    counts = materialise(
        docs.mapInArrow(_deal(n, buckets), "bucket int, part binary")
        .groupBy("bucket")
        .applyInArrow(_shared, "chunk bigint, sizes boolean, part binary")
        .groupBy("chunk")
        .applyInArrow(_totals, "doc_id bigint, n bigint, shared bigint"),
        "gram-counts",
    )
    # Joined by sorting at every size: a broadcast would be bound to small inputs.
    alive = counts.where(f"n > 0 AND 100 * shared >= {percent} * n").select("doc_id").hint("merge")
    sets = materialise(
        docs.join(alive, "doc_id", "left_semi").mapInArrow(
            _sets(n), "doc_id bigint, n bigint, digest string, grams array<bigint>"
        ),
        "gram-sets",
    )
    classes = materialise(
        sets.groupBy("digest").agg(
            F.min("doc_id").alias("class_id"), F.first("n").alias("n"), F.count("*").alias("copies")
        ),
        "gram-classes",
    )
    ids = classes.select(F.col("class_id").alias("doc_id")).hint("merge")
    one = sets.select("doc_id", "grams").join(ids, "doc_id", "left_semi")
    grams = one.select(F.col("doc_id").alias("class_id"), F.explode("grams").alias("gram"))
    common = grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    rare_first = F.sort_array(F.collect_list(F.struct("df", "gram")))["gram"]
    least = F.ceil(F.col("n") * percent / 100).cast("int")
    ordered = materialise(
        grams.join(common.hint("merge"), "gram")
        .groupBy("class_id")
        .agg(rare_first.alias("grams"))
        .join(classes.select("class_id", "n", "copies"), "class_id")
        .where(F.size("grams") >= least),
        "gram-ordered",
    )
    prefix = F.slice("grams", F.lit(1), F.size("grams") - least + 1)
    entries = ordered.select("class_id", F.explode(prefix).alias("gram"))
    heads = entries.groupBy("gram").agg(F.min("class_id").alias("head"))
    stars = components(entries.join(heads, "gram").select("class_id", "head"), "class_id", "head")
    sized = stars.join(
        ordered.select(F.col("class_id").alias("id"), F.size("grams").alias("size")), "id"
    )
    extent = sized.groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / block_sets), F.ceil(F.sum("size") / block_grams))
        .cast("int").alias("blocks"),
    )
    where = sized.join(extent, "root").select(F.col("id").alias("class_id"), "root", "blocks")
    placed = materialise(ordered.join(where.hint("merge"), "class_id"), "gram-clusters")
    small = placed.where("blocks = 1")
    total = small.agg(F.count("*"), F.sum(F.size("grams"))).first()
    bins = max(1, -(-total[0] // block_sets), -(-(total[1] or 0) // block_grams))
    single = small.select(
        F.pmod(F.xxhash64("root"), F.lit(bins)).alias("group"),
        F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"),
        "class_id", "n", "copies", "grams",
    )
    block = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    large = (
        placed.where("blocks > 1")
        .withColumn("side", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.col("root").alias("group"),
            (F.least("side", "other") + 1).alias("i"), (F.greatest("side", "other") + 1).alias("j"),
            "side", "class_id", "n", "copies", "grams",
        )
    )
    solved = materialise(
        single.union(large)
        .groupBy("group", "i", "j")
        .applyInPandas(_solved(percent), "class_id bigint, root bigint, links bigint"),
        "gram-links",
    )
    linked = solved.groupBy("class_id").agg(F.sum("links").alias("links"))
    roots = components(solved.select("class_id", "root"), "class_id", "root")
    answer = (
        classes.join(linked, "class_id", "left")
        .join(roots, classes.class_id == roots.id, "left")
        .select(
            "digest",
            F.coalesce("root", "class_id").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    members = sets.select("doc_id", "digest").join(answer, "digest").drop("digest")
    return (
        docs.select("doc_id")
        .join(counts.select("doc_id", "n"), "doc_id", "left")
        .join(members, "doc_id", "left")
        .select(
            "doc_id",
            F.coalesce("n", F.lit(0)).alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )
