"""Training-order materialisation of token sequences in fixed-stride binary shards.

Texts become sequences of at most ``seq_len`` tokens. A keyed Feistel permutation with
cycle-walking sends the number of a sequence to its global slot, so the order is random,
repeatable from the key, and needs no sort of random keys. Rows are range-partitioned by
slot; a task writes whole shards of ``shard_slots`` slots, in which slot ``s`` stands
``s % shard_slots`` strides from the start. A reader that stopped at slot ``s`` goes on
there by arithmetic alone.

A record is the header ``doc_id`` (8 bytes), ``piece`` (4), ``length`` (4), then
``seq_len`` token ids of 2 bytes, all little-endian; places after ``length`` hold 0. A document
without an id has -1 for it and its lengths negated, as any number may be an id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sensitext.llm.common import mix
from sensitext.llm.tokens import tokenizer_path, word_tokenizer
from sensitext.session import scratch_path

SEQ_LEN, SHARD_SLOTS, END = 1024, 4096, 1
ROUNDS = 6
HEADER = 16
_STRIDE = np.uint64(0x9E3779B97F4A7C15)


def feistel(values: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """A permutation of ``0 .. n - 1``, applied to an array of its members.

    The network permutes the next even number of bits; results outside the range go through
    it again until they fall inside.
    """
    half = max(1, -(-max(n - 1, 1).bit_length() // 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) * _STRIDE + np.uint64(key % (1 << 64)))
    out = np.asarray(values, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[todo] = left << shift | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def token_sequences(docs: DataFrame, path: str, seq_len: int, end: int) -> DataFrame:
    """``part, nth, doc_id, piece, length, ids``: the sequences of each task, numbered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path, "<u2")
        tail = np.array([end], "<u2").tobytes()
        part, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packed = tokenizer.encode(text.as_py() or "") + tail
                for k, at in enumerate(range(0, len(packed), 2 * seq_len)):
                    ids = packed[at : at + 2 * seq_len]
                    rows.append((part, nth, doc, k, len(ids) // 2, ids))
                    nth += 1
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            columns = zip(*rows) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds)],
                ["part", "nth", "doc_id", "piece", "length", "ids"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "part int, nth bigint, doc_id bigint, piece int, length int, ids binary"
    )


def write_training_order(
    docs: DataFrame,
    folder: str,
    key: int = 42,
    seq_len: int = SEQ_LEN,
    shard_slots: int = SHARD_SLOTS,
    path: str | None = None,
    end: int = END,
) -> int:
    """Writes the shards of all documents to ``folder`` and returns the number of slots.

    Rows of the folder are ``shard, first_slot, slots, stride, payload``. A null text counts as
    empty and gives one sequence with ``end`` alone; a null id reads back as null; ids may
    repeat. No documents give no shards.
    """
    spark = docs.sparkSession
    # Written once, so that the numbers stay what they are if a task runs again.
    stored = scratch_path(spark, "sequences")
    drafts = token_sequences(docs, path or tokenizer_path(), seq_len, end)
    drafts.write.option("compression", "zstd").parquet(stored)
    sequences = spark.read.schema(drafts.schema).parquet(stored)
    # One row per task of the first pass.
    sizes = dict(sequences.groupBy("part").agg(F.count("*")).collect())
    total = sum(sizes.values())
    before = np.zeros(max(sizes, default=0) + 2, np.int64)
    before[[p + 1 for p in sizes]] = list(sizes.values())
    shared = spark.sparkContext.broadcast(np.cumsum(before))

    def to_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, nth = (np.asarray(batch.column(c)) for c in (0, 1))
            slots = feistel(shared.value[part] + nth, total, key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots), *batch.columns[2:]], ["slot", *batch.schema.names[2:]]
            )

    stride = HEADER + 2 * seq_len

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in slot order, and a shard's rows come to one task."""
        shard, body, held = -1, bytearray(), 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int64()), pa.array([shard * shard_slots], pa.int64()),
                    pa.array([held], pa.int32()), pa.array([stride], pa.int32()),
                    pa.array([bytes(body)], pa.binary()),
                ],
                ["shard", "first_slot", "slots", "stride", "payload"],
            )

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for slot, doc, piece, length, ids in zip(*columns):
                if slot // shard_slots != shard:
                    if held:
                        yield flush()
                    shard, body, held = slot // shard_slots, bytearray(), 0
                doc, length = (-1, -length) if doc is None else (doc, length)
                head = np.array([doc], "<i8").tobytes() + np.array([piece, length], "<i4").tobytes()
                body += head + ids + bytes(stride - HEADER - len(ids))
                held += 1
        if held:
            yield flush()

    parts = max(1, -(-total // shard_slots))
    (
        sequences.mapInArrow(
            to_slots, "slot bigint, doc_id bigint, piece int, length int, ids binary"
        )
        .repartitionByRange(parts, F.floor(F.col("slot") / shard_slots))
        .sortWithinPartitions("slot")
        .mapInArrow(
            shards, "shard bigint, first_slot bigint, slots int, stride int, payload binary"
        )
        .write.option("compression", "zstd")
        .parquet(folder)
    )
    return total


def read_order(spark, folder: str, first_slot: int = 0) -> DataFrame:
    """``slot, shard, offset, doc_id, piece, length, ids_crc32, ids`` from ``first_slot`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                payload, stride = row["payload"], row["stride"]
                skip = max(0, first_slot - row["first_slot"])
                out = []
                for k in range(skip, row["slots"]):
                    at = k * stride
                    doc = int.from_bytes(payload[at : at + 8], "little", signed=True)
                    piece = int.from_bytes(payload[at + 8 : at + 12], "little")
                    length = int.from_bytes(payload[at + 12 : at + 16], "little", signed=True)
                    # Every sequence has a token, so no length is 0.
                    doc, length = (None, -length) if length < 0 else (doc, length)
                    ids = payload[at + HEADER : at + HEADER + 2 * length]
                    slot = row["first_slot"] + k
                    out.append((slot, row["shard"], at, doc, piece, length, zlib.crc32(ids), ids))
                kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64(), pa.binary()]
                names = ["slot", "shard", "offset", "doc_id", "piece", "length", "ids_crc32", "ids"]
                columns = zip(*out) if out else [()] * 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, kinds)], names
                )

    rows = spark.read.schema(
        "shard bigint, first_slot bigint, slots int, stride int, payload binary"
    ).parquet(folder)
    return rows.where(F.col("first_slot") + F.col("slots") > first_slot).mapInArrow(
        run,
        "slot bigint, shard bigint, offset bigint, doc_id bigint, piece int, length int, "
        "ids_crc32 bigint, ids binary",
    )
